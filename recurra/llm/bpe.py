"""Byte-pair encoding and decoding with forced-boundary splitting.

A merge can only join two neighbouring units if some vocabulary token contains them side by
side. Unit pairs that no token contains are therefore certain cuts: every pre-token is cut
there, the fragments are encoded independently, and their ids are concatenated. White space
and pre-token borders are cuts of the same kind. The vocabulary is the public "word" BPE
(lower case, white space dropped, end-of-word units); its file is a parameter, read on the
driver and sent to the tasks as plain lists.
"""

from __future__ import annotations

import heapq
import json
import sys
import unicodedata
import uuid
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.llm.common import slices, small_batches, text_of

#: A worker forgets its encoded chunks at the end of a task, and when they take more bytes (before
#: the next column), strings and ids as they are and so much for a chunk's place in the dictionary.
CACHE_BYTES = 64 << 20
PLACE_BYTES = 120
#: Fragments of up to this many units are merged as rows of a matrix, longer ones with a heap.
SCAN_UNITS = 48
NO_MERGE = np.iinfo(np.int32).max

_SPACE = regex.compile(r"\p{White_Space}+")


def byte_units() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def read_vocabulary(path: str) -> dict:
    """What encoding and decoding need of a tokenizer file, as plain picklable values."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    suffix = model["end_of_word_suffix"]
    split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    return {"vocab": model["vocab"], "merges": merges, "suffix": suffix, "split": split,
            "special": {t["content"]: t["id"] for t in spec["added_tokens"]}}


class PairRanks:
    """Vectorised lookup (left id, right id) -> merge rank: a probed hash table in two arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        bits = max(8, int(len(left) * 4).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NO_MERGE, np.int32)
        self.probes = 1
        key, rank = self._key(left, right), np.arange(len(left), dtype=np.int32)
        at = self._slot(key)
        while len(key):                      # each round places one key per free slot
            free = self.keys[at] < 0
            self.keys[at[free]] = key[free]
            mine = self.keys[at] == key
            self.ranks[at[mine]] = rank[mine]
            key, rank, at = key[~mine], rank[~mine], (at[~mine] + 1) & (len(self.keys) - 1)
            self.probes += bool(len(key))

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.int64) << 32 | right.astype(np.int64)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    @cached_property
    def one(self) -> dict[int, int]:
        """The same table for single lookups, by left id << 32 | right id; made when first used."""
        full = self.keys >= 0
        return dict(zip(self.keys[full].tolist(), self.ranks[full].tolist()))

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = self._key(left, right)
        at = self._slot(key)
        out = np.full(key.shape, NO_MERGE, np.int32)
        for _ in range(self.probes):
            out = np.where(self.keys[at] == key, self.ranks[at], out)
            at = (at + 1) & (len(self.keys) - 1)
        return np.where((left < 0) | (right < 0), NO_MERGE, out)


class WordBpe:
    """Encoder and decoder of one vocabulary (a task builds it once per worker)."""

    def __init__(self, spec: dict):
        vocab, suffix, units = spec["vocab"], spec["suffix"], byte_units()
        self.special = spec["special"]
        self.split = regex.compile(spec["split"].replace(r"\s", r"\p{White_Space}") + "|\n")
        self.special_re = (regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
                           if self.special else None)
        size = max([*vocab.values(), *self.special.values()], default=-1) + 1
        self.tokens = [""] * size
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.inner_id = np.array([vocab[u] for u in units], np.int32)
        self.final_id = np.array([vocab[u + suffix] for u in units], np.int32)
        ids = np.array([[vocab[a], vocab[b], vocab[a + b]] for a, b in spec["merges"]], np.int32).reshape(-1, 3)
        self.ranks, self.merged = PairRanks(ids[:, 0], ids[:, 1]), ids[:, 2]
        # byte pairs inside some token: inner ones, and ones whose right byte ends the word
        code = {u: b for b, u in enumerate(units)}
        self.inner = np.zeros((256, 256), bool)
        self.final = np.zeros((256, 256), bool)
        for token in vocab:
            ends = token.endswith(suffix)
            body = [code[u] for u in (token[:-len(suffix)] if ends else token)]
            for i in range(len(body) - 1):
                (self.final if ends and i == len(body) - 2 else self.inner)[body[i], body[i + 1]] = True
        self.cache: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.cache.clear()
        self.flat = np.empty(0, np.int32)
        self.bounds = np.zeros(1, np.int64)
        self.held = 0

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word) of pre-tokens given as UTF-8."""
        data = np.frombuffer(b"".join(words), np.uint8)
        length = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(length)
        if len(data) == 0:
            return np.empty(0, np.int32), length
        is_last = np.zeros(len(data), bool)
        is_last[end - 1] = True
        unit = np.where(is_last, self.final_id[data], self.inner_id[data])
        # a cut before every byte that starts a word or follows its neighbour in no token
        cut = np.ones(len(data), bool)
        pair = data[:-1], data[1:]
        cut[1:] = is_last[:-1] | ~np.where(is_last[1:], self.final[pair], self.inner[pair])
        start = np.flatnonzero(cut)
        size = np.diff(np.r_[start, len(data)])
        count = np.ones(len(start), np.int64)
        ids = np.empty(len(data), np.int32)          # a fragment's ids, at its first bytes
        ids[start[size == 1]] = unit[start[size == 1]]
        for low, high in ((2, 6), (7, 12), (13, 24), (25, SCAN_UNITS)):
            rows = np.flatnonzero((size >= low) & (size <= high))
            for lo in range(0, len(rows), 8192):
                some = rows[lo:lo + 8192]
                count[some] = self._merge_rows(unit, start[some], size[some], high, ids)
        for row in np.flatnonzero(size > SCAN_UNITS):
            out = self._merge_long(unit[start[row]:start[row] + size[row]].tolist())
            ids[start[row]:start[row] + len(out)] = out
            count[row] = len(out)
        used = np.arange(len(data)) - np.repeat(start, size) < np.repeat(count, size)
        per_byte = np.concatenate([[0], np.cumsum(used)])
        return ids[used], per_byte[end] - per_byte[end - length]

    def _merge_rows(self, unit, start, size, width, ids) -> np.ndarray:
        """Merge many fragments at once, one merge each per round; writes ids, returns counts."""
        col = np.arange(width)
        part = np.where(col < size[:, None], unit[np.minimum(start[:, None] + col, len(unit) - 1)], -1)
        rank = self.ranks.get(part[:, :-1], part[:, 1:])
        left, live = size.copy(), np.arange(len(size))
        while len(live):
            r, p = rank[live], part[live]
            i = r.argmin(axis=1)
            best = r[np.arange(len(live)), i]
            go = best != NO_MERGE
            live, r, p, i, best = live[go], r[go], p[go], i[go], best[go]
            if not len(live):
                break
            n = np.arange(len(live))
            p[n, i] = self.merged[best]
            p = np.where(col > i[:, None], np.c_[p[:, 1:], np.full(len(live), -1, np.int32)], p)
            r = np.where(col[:-1] > i[:, None], np.c_[r[:, 1:], np.full(len(live), NO_MERGE, np.int32)], r)
            after = np.where(i + 1 < width, p[n, np.minimum(i + 1, width - 1)], -1)
            has = i < width - 1
            r[n[has], i[has]] = self.ranks.get(p[n, i], after)[has]
            has = i > 0
            r[n[has], i[has] - 1] = self.ranks.get(p[n[has], i[has] - 1], p[n[has], i[has]])
            part[live], rank[live] = p, r
            left[live] -= 1
        keep = col < left[:, None]
        ids[(start[:, None] + col)[keep]] = part[keep]
        return left

    def _merge_long(self, part: list[int]) -> list[int]:
        """One long fragment by a heap over a linked list: n log n in its length."""
        rank_of = self.ranks.one.get
        right = [*range(1, len(part)), -1]
        left = list(range(-1, len(part) - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(part, part[1:])) if (r := rank_of(a << 32 | b)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = right[i]
            if j < 0 or part[i] != a or part[j] != b:
                continue
            part[i], part[j] = int(self.merged[r]), -1
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y >= 0 and (q := rank_of(part[x] << 32 | part[y])) is not None:
                    heapq.heappush(heap, (q, x, part[x], part[y]))
        return [p for p in part if p >= 0]

    def _remember(self, chunks: list[str]) -> None:
        """Encode new chunks together and add them to the cache."""
        plain = [c for c in chunks if c not in self.special]
        # lower case is taken character by character: a final sigma is no special case
        joined = unicodedata.normalize("NFC", "\n".join(plain)).replace("Σ", "σ").lower()
        words = self.split.findall(joined)
        breaks = np.fromiter((w == "\n" for w in words), bool, len(words))
        ids, count = self.encode_words([w.encode("utf-8") for w in words if w != "\n"])
        owner = np.cumsum(breaks)[~breaks]
        per_chunk = np.bincount(owner, weights=count, minlength=len(plain)).astype(np.int64) if plain else np.empty(0, np.int64)
        extra = [c for c in chunks if c in self.special]
        sizes = np.r_[per_chunk, np.ones(len(extra), np.int64)]
        first = len(self.cache)
        self.cache.update(zip(plain + extra, range(first, first + len(chunks))))
        self.flat = np.concatenate([self.flat, ids, np.array([self.special[c] for c in extra], np.int32)])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])
        self.held += sum(map(sys.getsizeof, chunks)) + PLACE_BYTES * len(chunks) + 4 * int(sizes.sum())

    def _chunks(self, text: str | None) -> list[str]:
        """White-space-free chunks; special tokens come out as chunks of their own."""
        if not text:
            return []
        marked = self.special_re is not None and any(s in text for s in self.special)
        # str.split also cuts at four control characters that are not white space here
        if not marked and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return text.split()
        pieces = self.special_re.split(text) if marked else [text]
        out: list[str] = []
        for piece in pieces:
            out.extend([piece] if piece in self.special else [c for c in _SPACE.split(piece) if c])
        return out

    def encode_column(self, texts: pa.Array) -> pa.Array:
        """list<int32> of ids for a string column (NULL: no ids)."""
        if self.held > CACHE_BYTES:
            self._clear()
        chunks, number = [], np.zeros(len(texts), np.int64)
        for row, text in enumerate(texts.to_pylist()):
            own = self._chunks(text)
            number[row] = len(own)
            chunks += own
        slots = list(map(self.cache.get, chunks))
        if None in slots:
            self._remember(list(dict.fromkeys(c for c, s in zip(chunks, slots) if s is None)))
            slots = list(map(self.cache.__getitem__, chunks))
        slot = np.array(slots, np.int64)
        begin = self.bounds[slot]
        count = self.bounds[slot + 1] - begin
        to = np.concatenate([[0], np.cumsum(count)])
        values = self.flat[np.arange(to[-1]) + np.repeat(begin - to[:-1], count)]
        offsets = to[np.concatenate([[0], np.cumsum(number)])]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))

    def decode_column(self, ids: pa.Array) -> pa.Array:
        """The tokens of each id list, joined by one space as the library does without a decoder."""
        ids = ids.cast(pa.large_list(pa.int32())) if not pa.types.is_large_list(ids.type) else ids
        flat = pa.array(self.tokens, pa.large_string()).take(ids.flatten())
        lengths = np.asarray(pc.fill_null(pc.list_value_length(ids), 0), dtype=np.int64)
        offsets = pa.array(np.r_[0, np.cumsum(lengths)], pa.int64())
        joined = pc.binary_join(pa.LargeListArray.from_arrays(offsets, flat), pa.scalar(" ", pa.large_string()))
        return joined.cast(pa.string())


def _send(spark: SparkSession, path: str):
    """The vocabulary as a broadcast: its size is that of the given file, a few megabytes."""
    return spark.sparkContext.broadcast(read_vocabulary(path))


def _by_batch(vocabulary: str, bundle, work: Callable[[WordBpe, pa.Array], pa.Array]):
    """``work`` on every batch of a task. Idle workers live on beside the next stages' memory, so a
    task leaves the encoder's tables behind but none of its chunks."""
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _model(vocabulary, bundle)
        try:
            for column in columns:
                yield work(bpe, column)
        finally:
            bpe._clear()
            pa.default_memory_pool().release_unused()
    return run


def _ids(bpe: WordBpe, texts: pa.Array) -> pa.Array:
    done = [bpe.encode_column(part) for _, part in slices(texts)]
    return pa.concat_arrays(done) if done else pa.array([], pa.list_(pa.int32()))


def _texts(bpe: WordBpe, ids: pa.Array) -> pa.Array:
    step = 64
    done = [bpe.decode_column(ids.slice(at, step)) for at in range(0, len(ids), step)]
    return pa.concat_arrays(done) if done else pa.array([], pa.string())


def _both(bpe: WordBpe, texts: pa.Array) -> pa.Array:
    ids = _ids(bpe, texts)
    return pa.StructArray.from_arrays([ids, _texts(bpe, ids)], names=["ids", "decoded"])


def encode(docs: DataFrame, vocabulary: str, *, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with a column ``out`` (array<int>) of token ids.

    Ids are those of the public library without special tokens added (special tokens that
    occur in the text itself are recognised). NULL and empty texts have no ids. Whole
    texts of any length are encoded; rows are independent, so there is no shuffle. A column
    that is called ``out`` already is replaced, the others stay as they are.
    """
    small_batches(docs.sparkSession)
    ids_of = F.arrow_udf(_by_batch(vocabulary, _send(docs.sparkSession, vocabulary), _ids), "array<int>")
    return docs.withColumn(out, ids_of(text_of(text_col)))


def decode(df: DataFrame, vocabulary: str, *, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with a column ``out``: the text of the ids (special tokens kept); NULL and empty: ''.
    A column that is called ``out`` already is replaced."""
    small_batches(df.sparkSession)
    text_of_ids = F.arrow_udf(_by_batch(vocabulary, _send(df.sparkSession, vocabulary), _texts), "string")
    return df.withColumn(out, text_of_ids(F.coalesce(F.col(ids_col), F.array().cast("array<int>"))))


def round_trip(docs: DataFrame, vocabulary: str, *, text_col: str = "text", ids: str = "ids",
               decoded: str = "decoded") -> DataFrame:
    """``decode(encode(docs))``: the columns ``ids`` and ``decoded``, made by the same encoder and decoder.

    Two operators in a row run two Python workers a core at a time, each with tables of its own;
    here one worker encodes a batch and decodes its ids, which never leave it in between.
    """
    small_batches(docs.sparkSession)
    coded = F.arrow_udf(_by_batch(vocabulary, _send(docs.sparkSession, vocabulary), _both),
                        "struct<ids:array<int>,decoded:string>")
    both = f"both_{uuid.uuid4().hex}"
    return (docs.withColumn(both, coded(text_of(text_col)))
            .withColumns({ids: F.col(both)["ids"], decoded: F.col(both)["decoded"]}).drop(both))


_MODELS: dict[str, WordBpe] = {}


def _model(vocabulary: str, bundle) -> WordBpe:
    """The worker's encoder of a broadcast vocabulary, built once."""
    if vocabulary not in _MODELS:
        _MODELS.clear()
        _MODELS[vocabulary] = WordBpe(bundle.value)
    return _MODELS[vocabulary]
