"""Phrase collocations from depth-truncated suffix subtrees, partitioned vertically.

Every word position starts a suffix of its piece, of which the first three words matter. The
suffixes are partitioned by word prefixes: a prefix (a word, or two words where one word is
too frequent, or three) has a known number of suffixes, and prefixes in hash order are grouped
until a group's memory budget is full. Each group's suffixes meet in one place, are sorted
there into a suffix subtree cut at depth three, and the counts of its nodes, which are phrase
frequencies, are sums of leaf totals. No group depends on another, and none is larger than the
budget and one prefix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.llm.common import PrefixHash, mix64, raw_bytes, slices, small_batches, stored, text_of, words

#: Suffixes of one group that a task holds in memory. A small corpus is cut into some 256 groups
#: all the same, so that they spread over the cluster; on a very large one the budget grows so
#: that there are at most MAX_GROUPS: their borders (8 bytes each) and the long prefixes (at
#: most twice as many) are broadcast.
GROUP_SUFFIXES = 1 << 20
GROUPS, MAX_GROUPS = 256, 1 << 20
#: Suffixes that a task holds before it adds up equal ones and hands them on.
PORTION = 1 << 20
#: Partial rankings of a language; only each one's best rows meet.
SALTS = 64
_U = np.uint64


def _flags(chars: bytes) -> np.ndarray:
    lut = np.zeros(256, bool)
    lut[list(chars)] = True
    return lut


SPLIT = _flags(b".,;:!?\n\x0b\x0c\r")
BREAK = SPLIT | _flags(b" \t")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# --- words of a column ----------------------------------------------------------------------

class Words:
    """The words of some texts: key of (language, word), place, and whether the next word
    follows in the same piece."""

    def __init__(self, texts: pa.Array, langs: list[str], collided: frozenset[int], bits: int = 64):
        data, off = raw_bytes(texts)
        self.data = _LOWER[data]
        doc, self.start, self.end = words(self.data, off, BREAK)
        cuts = np.concatenate([[0], np.cumsum(SPLIT[self.data])])[self.start]
        self.linked = np.zeros(len(doc), bool)
        self.linked[:-1] = (doc[1:] == doc[:-1]) & (cuts[1:] == cuts[:-1])
        names = sorted(set(langs))
        number = {name: i for i, name in enumerate(names)}
        salts = np.array([int.from_bytes(hashlib.blake2b(x.encode("utf-8"), digest_size=8).digest(), "little")
                          for x in names], _U)
        self.names = names
        self.lang = np.fromiter((number[x] for x in langs), np.int64, len(langs))[doc] if len(doc) else doc
        if len(doc):
            self.key = word_hash(self.data, self.start, self.end, salts[self.lang], bits)
        else:
            self.key = np.empty(0, _U)
        if collided:
            for i in np.flatnonzero(np.isin(self.key, np.fromiter(collided, _U, len(collided)))).tolist():
                word = self.data[self.start[i]:self.end[i]].tobytes()
                self.key[i] = other_key(names[self.lang[i]], word)

    def strings(self, some: np.ndarray) -> pa.Array:
        start, size = self.start[some], self.end[some] - self.start[some]
        to = np.concatenate([[0], np.cumsum(size)])
        chars = self.data[np.arange(to[-1]) + np.repeat(start - to[:-1], size)]
        return pa.LargeStringArray.from_buffers(len(some), pa.py_buffer(to.astype(np.int64)), pa.py_buffer(chars))


def word_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, salt: np.ndarray, bits: int = 64) -> np.ndarray:
    """Keys of ``bits`` bits; 0 stands for "no word" and is not used."""
    return np.maximum(mix64(PrefixHash(data).of(start, end) ^ salt) >> _U(64 - bits), _U(1))


def other_key(lang: str, word: bytes) -> int:
    """The key of a word whose hash another word of its language has too."""
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8") + b"\x00" + word, digest_size=8,
                                          person=b"other").digest(), "little") or 1


def _scan(docs: DataFrame, collided: frozenset[int], emit: Callable[[Iterator[Words]], Iterator[pa.RecordBatch]],
          schema: str, bits: int) -> DataFrame:
    """``emit`` over the words of every task's texts; ``docs`` is (text, lang)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[Words]:
            for batch in batches:
                langs = batch.column("lang").to_pylist()
                for at, texts in slices(batch.column("text")):
                    yield Words(texts, langs[at:at + len(texts)], collided, bits)
        return emit(parts())
    return docs.mapInArrow(run, schema)


def _sums(columns: list[np.ndarray], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first index of each run, total of n per run) after a sort by a mix of the columns.

    Rows are added up only if all columns agree, so a collision of the mix splits a run in
    two and never joins different rows.
    """
    with np.errstate(over="ignore"):
        mixed = columns[0]
        for c in columns[1:]:
            mixed = mix64(mixed) + c
    order = np.argsort(mixed)
    new = np.ones(len(order), bool)
    new[1:] = False
    for c in columns:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    at = np.flatnonzero(new)
    return order[at], np.add.reduceat(n[order], at) if len(at) else n[:0]


def _count_words(parts: Iterator[Words]) -> Iterator[pa.RecordBatch]:
    """(lang, key, word, n) of the distinct words of each slice; words are told apart by hash,
    length and first eight bytes."""
    for w in parts:
        if not len(w.key):
            continue
        padded = np.concatenate([w.data, np.zeros(8, np.uint8)])
        head = np.ndarray((len(w.data) + 1,), "<u8", padded.data, strides=(1,))[w.start]
        bits = (np.minimum(w.end - w.start, 8) * 8).astype(_U)
        head = np.where(bits == 64, head, head & ((_U(1) << np.minimum(bits, _U(63))) - _U(1)))
        some, n = _sums([w.key, head, (w.end - w.start).astype(_U), w.lang.astype(_U)], np.ones(len(w.key), np.int64))
        lang = pa.array(w.names, pa.string()).take(pa.array(w.lang[some]))
        yield pa.RecordBatch.from_arrays(
            [lang, pa.array(w.key[some].view(np.int64)), w.strings(some).cast(pa.string()), pa.array(n)],
            names=["lang", "key", "word", "n"])


# --- vertical partitioning ------------------------------------------------------------------

def _in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in the sorted table."""
    if len(table) == 0:
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(mix64(a) + b)


def _suffixes(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first three keys of the suffixes of at least two words (0: the piece has ended)."""
    at = np.flatnonzero(w.linked)
    more = w.linked[at + 1]
    return w.key[at], w.key[at + 1], np.where(more, w.key[np.minimum(at + 2, len(w.key) - 1)], _U(0))


def _count_prefixes(long_words: np.ndarray, long_pairs: np.ndarray | None):
    """(k1, k2, k3, r, n) of the suffixes below long prefixes, to depth 2 or, below long pairs, 3."""
    def below(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        k1, k2, k3 = _suffixes(w)
        pick = _in(k1, long_words)
        if long_pairs is None:
            return k1[pick], k2[pick], np.zeros(int(pick.sum()), _U)
        pick &= k3 != 0
        pick[pick] = _in(pair_key(k1[pick], k2[pick]), long_pairs)
        return k1[pick], k2[pick], k3[pick]

    def flush(held: list) -> pa.RecordBatch:
        k1, k2, k3 = (np.concatenate([h[i] for h in held]) for i in range(3))
        some, n = _sums([k1, k2, k3], np.ones(len(k1), np.int64))
        k1, k2, k3 = k1[some], k2[some], k3[some]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(x.view(np.int64)) for x in (k1, k2, k3, pair_key(k1, k2))), pa.array(n)],
            names=["k1", "k2", "k3", "r", "n"])

    def run(parts: Iterator[Words]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for w in parts:
            held.append(below(w))
            size += len(held[-1][0])
            if size >= PORTION:
                yield flush(held)
                held, size = [], 0
        if size:
            yield flush(held)
    return run


_PREFIX = "k1 long, k2 long, k3 long, r long, n long"


def _unsigned(rows: list, name: str) -> np.ndarray:
    return np.sort(np.fromiter((getattr(r, name) for r in rows), np.int64, len(rows)).view(_U))


def _borders(prefixes: DataFrame, budget: int) -> np.ndarray:
    """The last prefix of every group but the last: prefixes (r, n) in order of r, cut where
    the running total passes a multiple of the budget."""
    placed = stored(prefixes.repartitionByRange("r").sortWithinPartitions("r")
                    .withColumn("part", F.spark_partition_id()))
    sums = sorted(placed.groupBy("part").agg(F.sum("n").alias("n")).collect())     # one row per partition
    before, offsets = 0, []
    for r in sums:
        offsets.append((r.part, before))
        before += r.n
    if not offsets:
        return np.empty(0, np.int64)
    parts = prefixes.sparkSession.createDataFrame(offsets, "part int, before long")
    run = F.sum("n").over(Window.partitionBy("part").orderBy("r").rowsBetween(Window.unboundedPreceding, 0))
    total = F.col("run") + F.col("before")
    ends = (placed.withColumn("run", run).join(F.broadcast(parts), "part")
            .filter(F.floor((total - 1) / budget) > F.floor((total - F.col("n") - 1) / budget))
            .select("r").distinct())
    return np.sort(np.fromiter((r.r for r in ends.collect()), np.int64))


def _hand_out(plan):
    """(group, blob) of the suffixes, equal ones of a portion added up. ``plan``: a broadcast
    (long words, long pairs, borders)."""
    def flush(held: list) -> Iterator[pa.RecordBatch]:
        long_words, long_pairs, borders = plan.value
        k1, k2, k3 = (np.concatenate([h[i] for h in held]) for i in range(3))
        some, n = _sums([k1, k2, k3], np.ones(len(k1), np.int64))
        k1, k2, k3 = k1[some], k2[some], k3[some]
        route = k1.copy()
        heavy = np.flatnonzero(_in(k1, long_words))
        route[heavy] = pair_key(k1[heavy], k2[heavy])
        gone = np.zeros(len(k1), bool)                   # counted to full depth already
        gone[heavy] = _in(route[heavy], long_pairs)
        group = np.searchsorted(borders, route.view(np.int64))
        order = np.lexsort((k1, group))
        order = order[~gone[order]]
        group = group[order]
        edge = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, np.int64)
        blobs = [pack(k1[o], k2[o], k3[o], n[o]) for o in np.split(order, edge[1:])] if len(edge) else []
        for lo in range(0, len(blobs), 64):
            yield pa.RecordBatch.from_arrays(
                [pa.array(group[edge[lo:lo + 64]], pa.int32()), pa.array(blobs[lo:lo + 64], pa.binary())],
                names=["group", "blob"])

    def run(parts: Iterator[Words]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for w in parts:
            held.append(_suffixes(w))
            size += len(held[-1][0])
            if size >= PORTION:
                yield from flush(held)
                held, size = [], 0
        if size:
            yield from flush(held)
    return run


def pack(k1: np.ndarray, k2: np.ndarray, k3: np.ndarray, n: np.ndarray) -> bytes:
    """Columns of one group as bytes: distinct values, and numbers into them, of each key."""
    wide = bool(n.max() > 255)
    head = [len(k1), int(wide)]
    body = n.astype(np.int64 if wide else np.uint8).tobytes()
    for k in (k1, k2, k3):
        values, at = np.unique(k, return_inverse=True)
        kind = np.uint16 if len(values) <= 1 << 16 else np.uint32
        head.append(len(values))
        body += values.tobytes() + at.astype(kind).tobytes()
    return np.array(head, np.int64).tobytes() + body


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rows, wide, *sizes = np.frombuffer(blob, np.int64, 5).tolist()
    at = 40

    def take(kind, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(blob, kind, count, at)
        at += out.nbytes
        return out

    n = take(np.int64 if wide else np.uint8, rows).astype(np.int64)
    keys = []
    for size in sizes:
        values = take(_U, size)
        keys.append(values[take(np.uint16 if size <= 1 << 16 else np.uint32, rows)])
    return (*keys, n)


# --- subtrees -------------------------------------------------------------------------------

def subtree_counts(k1: np.ndarray, k2: np.ndarray, k3: np.ndarray, n: np.ndarray, least: int
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(k1, k2, k3, count) of the nodes at depth 2 (k3 = 0) and 3 with at least ``least``.

    The sorted suffixes are the leaves of the subtree in order; a node's count is the sum of
    the leaf totals between its borders.
    """
    order = np.lexsort((k3, k2, k1))
    k1, k2, k3, n = k1[order], k2[order], k3[order], n[order]
    pair = np.ones(len(k1), bool)
    pair[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
    leaf = pair.copy()
    leaf[1:] |= k3[1:] != k3[:-1]
    at3 = np.flatnonzero(leaf)
    total3 = np.add.reduceat(n, at3)
    at2 = np.flatnonzero(pair)
    total2 = np.add.reduceat(total3, np.searchsorted(at3, at2))
    deep = (total3 >= least) & (k3[at3] != 0)
    flat = total2 >= least
    return (np.r_[k1[at2[flat]], k1[at3[deep]]], np.r_[k2[at2[flat]], k2[at3[deep]]],
            np.r_[np.zeros(int(flat.sum()), _U), k3[at3[deep]]], np.r_[total2[flat], total3[deep]])


def _build(least: int):
    """One subtree per group, from a partition sorted by group."""
    def tree(held: list[bytes]) -> pa.RecordBatch:
        k1, k2, k3, n = (np.concatenate(x) for x in zip(*map(unpack, held)))
        *keys, count = subtree_counts(k1, k2, k3, n, least)
        return pa.RecordBatch.from_arrays([*(pa.array(k.view(np.int64)) for k in keys), pa.array(count)],
                                          names=["k1", "k2", "k3", "a"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            for group, blob in zip(batch.column("group").to_pylist(), batch.column("blob").to_pylist()):
                if held and group != now:
                    yield tree(held)
                    held = []
                held.append(blob)
                now = group
        if held:
            yield tree(held)
    return run


def phrase_counts(rows: DataFrame, least: int, group_suffixes: int = GROUP_SUFFIXES, bits: int = 64
                  ) -> tuple[DataFrame, DataFrame]:
    """(words, nodes): (lang, key, word, n) of every word, and (k1, k2, k3, a) of every phrase of two
    (k3 = 0) or three words with at least ``least`` places; ``rows`` is (text, lang).

    Keys are hashes. Words of one language whose hashes collide are found in the word counts
    and get keys of another hash, so no two words share one.
    """
    spark = rows.sparkSession
    small_batches(spark, 4096)
    counted = stored(_scan(rows, frozenset(), _count_words, "lang string, key long, word string, n long", bits)
                     .groupBy("lang", "key", "word").agg(F.sum("n").alias("n")))
    twice = [(r.lang, r.key) for r in counted.groupBy("lang", "key").agg(F.count("*").alias("c"))
             .filter("c > 1").select("lang", "key").collect()]        # hash collisions: about none
    collided = frozenset(key % (1 << 64) for _, key in twice)
    if collided:
        again = F.udf(lambda lang, word: (k := other_key(lang, word.encode("utf-8"))) - (k >> 63 << 64), "long")
        hit = F.col("key").isin(sorted({key for _, key in twice}))
        counted = stored(counted.withColumn("key", F.when(hit, again("lang", "word")).otherwise(F.col("key"))))

    n = counted.agg(F.sum("n")).first()[0] or 0
    budget = max(min(group_suffixes, n // GROUPS), n // MAX_GROUPS, 1)
    half = max(1, budget // 2)
    long_words = _unsigned(counted.filter(F.col("n") > half).select("key").collect(), "key")
    light = counted.filter(F.col("n") <= half).select(F.col("key").alias("r"), "n")
    long_pairs, known = np.empty(0, _U), None
    if len(long_words):
        pairs = stored(_scan(rows, collided, _count_prefixes(long_words, None), _PREFIX, bits)
                       .groupBy("k1", "k2", "k3", "r").agg(F.sum("n").alias("n")))
        long_pairs = np.unique(_unsigned(pairs.filter(F.col("n") > half).select("r").collect(), "r"))
        light = light.unionByName(pairs.filter(F.col("n") <= half).select("r", "n"))
        if len(long_pairs):
            listed = spark.createDataFrame([(int(x),) for x in long_pairs.view(np.int64)], "r long")
            triples = (_scan(rows, collided, _count_prefixes(long_words, long_pairs), _PREFIX, bits)
                       .groupBy("k1", "k2", "k3", "r").agg(F.sum("n").alias("n")))
            known = (pairs.join(F.broadcast(listed), "r", "left_semi").unionByName(triples)
                     .filter(F.col("n") >= least).select("k1", "k2", "k3", F.col("n").alias("a")))
    plan = spark.sparkContext.broadcast((long_words, long_pairs, _borders(light, budget)))
    dealt = _scan(rows, collided, _hand_out(plan), "group int, blob binary", bits)
    nodes = (dealt.repartition("group").sortWithinPartitions("group")
             .mapInArrow(_build(least), "k1 long, k2 long, k3 long, a long"))
    return counted, stored(nodes.unionByName(known) if known is not None else nodes)


# --- collocations ---------------------------------------------------------------------------

def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in exact decimals of 38 digits."""
    big = {c: f"cast({c} as decimal(19,0))" for c in (a, left, right)}
    return F.expr(f"(({big[a]} * {big[a]}) * cast(1000000 as decimal(7,0))) div ({big[left]} * {big[right]})")


def collocations(docs: DataFrame, *, lang_col: str = "lang", text_col: str = "text", least: int = 10,
                 inside_percent: int = 50, top: int = 2000, group_suffixes: int = GROUP_SUFFIXES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of two or three words.

    Texts (A-Z lower-cased; NULL is empty) are split into pieces at ``.,;:!?`` and line ends,
    pieces at spaces and tabs into words; a NULL language is "und" and joins a language of that name.
    Candidates have at least ``least`` places. Each cut of a phrase scores
    floor(1000000 a^2 / (l r)) with the frequencies of its two parts; the lowest cut counts,
    of equal ones the first. A phrase inside a longer candidate with at least
    ``inside_percent`` percent of its places is dropped. Ties of the ranking: a descending, then
    the phrase in byte order. ``n`` counts all words of the language. Rows that repeat count
    each time; other columns are not read; an empty table gives no rows.
    """
    rows = docs.select(text_of(text_col).alias("text"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    counted, nodes = phrase_counts(rows, least, group_suffixes)
    one = counted.filter(F.col("n") >= least)
    two = nodes.filter("k3 = 0").select("k1", "k2", "a")
    three = nodes.filter("k3 <> 0")

    def word(number: int, lang: bool = False) -> DataFrame:
        return one.select(F.col("key").alias(f"k{number}"), F.col("word").alias(f"w{number}"),
                          F.col("n").alias(f"f{number}"), *([F.col("lang")] if lang else []))

    inside = (three.select("k1", "k2", "a").unionByName(three.select(F.col("k2").alias("k1"), F.col("k3").alias("k2"), "a"))
              .groupBy("k1", "k2").agg(F.max("a").alias("longer")))
    pairs = (two.join(inside, ["k1", "k2"], "left")
             .filter(F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a")))
             .join(word(1, lang=True), "k1").join(word(2), "k2")
             .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"),
                     F.col("f2").alias("r"), _score("a", "f1", "f2").alias("score")))
    cuts = (three.join(two.select("k1", "k2", F.col("a").alias("f12")), ["k1", "k2"])
            .join(two.select(F.col("k1").alias("k2"), F.col("k2").alias("k3"), F.col("a").alias("f23")), ["k2", "k3"])
            .join(word(1, lang=True), "k1").join(word(2), "k2").join(word(3), "k3")
            .withColumn("s1", _score("a", "f1", "f23")).withColumn("s2", _score("a", "f12", "f3")))
    first = F.col("s1") <= F.col("s2")
    triples = cuts.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
                          F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"),
                          F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"),
                          F.least("s1", "s2").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    partial = Window.partitionBy("lang", "salt").orderBy(*order)
    best = (pairs.unionByName(triples).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
            .withColumn("rank", F.row_number().over(partial)).filter(F.col("rank") <= top).drop("salt"))
    ranked = (best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
              .filter(F.col("rank") <= top))
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
