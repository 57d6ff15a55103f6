"""Spelling variants grouped through a variable-length gram index.

Words are counted with DataFrame functions. A gram dictionary is built from the words
themselves: all short grams, and longer ones only where the gram they extend is frequent, so a
gram is as long as it has to be to be selective. A word is decomposed into the longest
dictionary gram at each position (grams inside an earlier one are left out). For every word a
bound tells how many of its grams one edit can affect at most; what is left must be shared, so
merging the lists of a few of the rarest grams finds every word at distance one. The exact
distance decides.

Why the merge is complete: let two words differ by one edit, and let T be the larger of their
"grams minus affected grams". At least T grams stand in both. In any order common to all words,
the first k of those are among the first (affected + k) grams of each word, for every k up
to T. Words therefore meet under a combination of k = 3 of these grams, or of 2 or 1 where T
is smaller; words whose bound leaves nothing meet by plain grams of the shortest length, whose
bound always leaves some.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.llm.common import stored, text_of

LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Shortest and longest gram, and the words a gram must be in before it is extended.
MIN_GRAM, MAX_GRAM, FREQUENT = 2, 3, 500
#: The most frequent grams that are kept; their counts are broadcast (some 5 MB at most).
DICTIONARY = 50_000
#: Grams that two words must share at once, where their bounds allow it.
TOGETHER = 3


# --- words ----------------------------------------------------------------------------------

def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5,
                min_count: int = 3, typo_every: int = 97) -> DataFrame:
    """(word, n) of the words of at least ``min_length`` code points and ``min_count`` places.

    A word is a maximal run of ASCII and Latin-1 letters, A-Z lower-cased. Where the CRC-32 of
    "id:word" is a multiple of ``typo_every``, the code point at CRC modulo length is deleted
    first (0: never); a NULL id is the empty string there. Shorter runs cannot become long
    enough and are not extracted.
    """
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(text_of(text_col), F.lit(f"[{LETTERS}]{{{min_length},}}"),
                                                      F.lit(0))).alias("run"))
    word = F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", UPPER, LOWER))
    words = runs.select("id", word.alias("word"))
    if typo_every:
        crc = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        words = words.select("word", crc.alias("h"))
        at = (F.col("h") % F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        words = (words.select(F.when(F.col("h") % typo_every == 0, cut).otherwise(F.col("word")).alias("word"))
                 .filter(F.length("word") >= min_length))
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


# --- gram index -----------------------------------------------------------------------------

def marked(word: str) -> str:
    return f"^{word}$"


def gram_dictionary(words: DataFrame, *, min_gram: int = MIN_GRAM, max_gram: int = MAX_GRAM,
                    frequent: int = FREQUENT, limit: int = DICTIONARY) -> dict[str, int]:
    """Gram -> number of places in ``words`` (word): the shortest grams, and a longer one only
    if the gram it extends has more than ``frequent`` places; the ``limit`` most frequent."""
    marked_words = words.select(F.concat(F.lit("^"), "word", F.lit("$")).alias("s"))
    places = marked_words.select("s", F.explode(F.sequence(F.lit(1), F.length("s") - (min_gram - 1))).alias("p"))
    # near the end of a word the longer substrings repeat the shorter one: those are dropped
    sizes = F.array(*[F.lit(size) for size in range(min_gram, max_gram + 1)])
    grams = places.select(
        F.explode(F.transform(F.filter(sizes, lambda z: z <= F.length("s") - F.col("p") + 1),
                              lambda z: F.substring("s", F.col("p"), z))).alias("gram"))
    counts = stored(grams.groupBy("gram").agg(F.count("*").alias("n")))
    parents = counts.select(F.col("gram").alias("parent"), F.col("n").alias("parent_n")).filter(
        F.col("parent_n") > frequent)
    longer = (counts.filter(F.length("gram") > min_gram)
              .withColumn("parent", F.substring("gram", F.lit(1), F.length("gram") - 1))
              .join(parents, "parent").select("gram", "n"))
    kept = counts.filter(F.length("gram") == min_gram).unionByName(longer)
    return {r.gram: r.n for r in kept.orderBy(F.desc("n"), "gram").limit(limit).collect()}


class GramIndex:
    """Decomposition and bounds of one gram dictionary (any dictionary gives right results)."""

    def __init__(self, dictionary: dict[str, int], min_gram: int = MIN_GRAM):
        self.grams, self.least = dictionary, min_gram
        self.most = max([min_gram, *map(len, dictionary)])
        self.reach: dict[str, int] = {}       # start of a gram -> length of the longest such gram
        self.tails: set[str] = set()          # grams without their first character
        for gram in dictionary:
            self.tails.add(gram[1:])
            for size in range(1, len(gram)):
                self.reach[gram[:size]] = max(self.reach.get(gram[:size], 0), len(gram))

    def decompose(self, s: str) -> list[tuple[int, int]]:
        """(start, end) of the grams of a marked word."""
        out, done = [], 0
        for p in range(len(s) - self.least + 1):
            end = p + self.least
            for size in range(min(self.most, len(s) - p), self.least, -1):
                if s[p:p + size] in self.grams:
                    end = p + size
                    break
            if end > done:
                out.append((p, end))
                done = end
        return out

    def affected(self, s: str, grams: list[tuple[int, int]]) -> int:
        """The most grams of ``s`` that one edit inside the marks can destroy, change or hide.

        For an edit at i, grams that end by i stay unless they or an earlier gram could go on
        past i with other characters there; grams that start after i stay unless a gram
        from before or at the edit could now reach over them.
        """
        worst = 0
        for i in range(1, len(s)):
            first, over = i, 0
            for p in range(max(0, i - self.most + 1), i):
                longest = max(self.reach.get(s[p:i], 0), self.least)
                if longest > i - p:
                    first, over = min(first, p), max(over, p + longest)
            left = 0
            for _, end in grams:
                if end > i:
                    break
                left += 1
            while left and grams[left - 1][0] >= first:
                left -= 1
            right = [end for p, end in grams[left:] if p > i]
            new = max(over, i + self._after(s, i))                       # insertion before i
            kept = sum(end + 1 > new for end in [end for p, end in grams[left:] if p == i] + right)
            if i < len(s) - 1:
                new = max(over, i + self._after(s, i + 1))               # replacement, deletion
                kept = min(kept, sum(end > new for end in right), sum(end - 1 > over for end in right))
            worst = max(worst, len(grams) - left - kept)
        return worst

    def _after(self, s: str, at: int) -> int:
        """The longest gram that any one character followed by s[at:] could start."""
        for size in range(min(self.most - 1, len(s) - at), 0, -1):
            if s[at:at + size] in self.tails:
                return max(size + 1, self.least)
        return self.least

    def rarest(self, s: str, grams: list[tuple[int, int]]) -> list[tuple[int, int]]:
        return sorted(grams, key=lambda g: (self.grams.get(s[g[0]:g[1]], 0), s[g[0]:g[1]], g[0]))


def merge_keys(word: str, index: GramIndex, base: GramIndex, together: int = TOGETHER
               ) -> list[tuple[tuple[str, ...], int]]:
    """(key, place of the key's first gram) of every list that ``word`` is merged from."""
    s = marked(word)
    out = []
    for which in (index, base):
        grams = which.decompose(s)
        lost = which.affected(s, grams)
        shared, order = len(grams) - lost, which.rarest(s, grams)
        name = "v" if which is index else "b"
        for k in range(together, 0, -1):
            if k == together or shared <= k:
                for some in combinations(sorted(order[:lost + k]), k):
                    out.append(((name, *[s[p:end] for p, end in some]), some[0][0]))
        if shared > 0:
            return out                # the plain grams are needed only where no bound is left
    return [*out, (("one",), 0)]      # one-letter words: as many as there are letters


def near_pairs(words: DataFrame, dictionary: dict[str, int], *, min_gram: int = MIN_GRAM) -> DataFrame:
    """(a, b), a < b, of all words of ``words`` (word, distinct) that differ by exactly one
    inserted, deleted or replaced code point."""
    bundle = words.sparkSession.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, base = GramIndex(bundle.value, min_gram), GramIndex({}, min_gram)
        base.grams = bundle.value          # only its order; it has no longer grams
        for batch in batches:
            column = batch.column("word").to_pylist()
            for at in range(0, len(column), 2000):
                keys, rows, places = [], [], []
                for word in column[at:at + 2000]:
                    for key, place in merge_keys(word, index, base):
                        keys.append(hashlib.blake2b("\x00".join(key).encode("utf-8"), digest_size=8).digest())
                        rows.append(word)
                        places.append(place)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(b"".join(keys), np.int64)), pa.array(rows, pa.string()),
                     pa.array(places, pa.int32())], names=["key", "word", "place"])

    lists = words.select("word").mapInArrow(run, "key long, word string, place int")
    lists = lists.withColumn("size", F.length("word"))
    a, b = (lists.select("key", *[F.col(c).alias(f"{c}_{side}") for c in ("word", "place", "size")])
            for side in ("a", "b"))
    close = ((F.col("word_a") < F.col("word_b"))
             & (F.abs(F.col("size_a") - F.col("size_b")) <= 1) & (F.abs(F.col("place_a") - F.col("place_b")) <= 1)
             & (F.levenshtein("word_a", "word_b", 1) == 1))
    return a.join(b, "key").filter(close).select(F.col("word_a").alias("a"), F.col("word_b").alias("b")).distinct()


# --- forms ----------------------------------------------------------------------------------

def variants(counts: DataFrame, *, ratio: int = 2, dictionary: dict[str, int] | None = None) -> DataFrame:
    """One row per word of ``counts`` (word, n): word, form, root, n, n_near, form_n.

    ``form`` is the near word of largest n (ties: the smallest in code-point order) if that n
    is at least ``ratio`` times the word's, else NULL; ``root`` follows the forms to the last
    (the word itself without one); ``n_near`` counts the near words. No rows for no words.
    Counts at least double along a chain of forms, so pointer jumping ends after a few rounds.
    """
    counts = stored(counts)
    if dictionary is None:
        dictionary = gram_dictionary(counts)
    pairs = stored(near_pairs(counts, dictionary))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other")))
    rated = both.join(counts.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = rated.groupBy("word").agg(F.count("*").alias("n_near"),
                                     F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    formed = stored(counts.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best.other")).alias("form"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), -F.col("best.less")).alias("form_n")))
    step = formed.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        jump = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(step.join(jump, "root", "left")
                       .select("word", F.coalesce("next", "root").alias("root"),
                               F.col("next").isNotNull().alias("moved")))
        step = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return (formed.join(step, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def spelling_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                      ratio: int = 2, **params) -> DataFrame:
    """``variants`` of the ``word_counts`` of ``docs``. NULL texts have no words; repeated rows
    count each time; other columns are not read; an empty table gives no rows."""
    return variants(word_counts(docs, id_col=id_col, text_col=text_col, **params), ratio=ratio)
