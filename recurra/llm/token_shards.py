"""Token ids in binary shards, compressed by Re-Pair grammars with random access.

Documents are encoded with the public tokenizer library, sorted by id, and cut into shards of
about a million ids. In each shard, frequent neighbouring id pairs are repeatedly replaced by
nonterminals; a shard stores its rules with their expansion lengths, the compressed sequence
and where each document begins in it, so a document or any range of ids is expanded without
the rest.

A shard's bytes (little endian)::

    magic 'RPS1', symbol width (2 or 4 bytes), first nonterminal, rules, documents, symbols
    left and right symbol of every rule       width bytes each, in order of creation
    expansion length of every rule            4 bytes each
    symbols of every document                 4 bytes each
    ids of every document                     4 bytes each
    the compressed sequence                   width bytes a symbol

Shards are the ``payload`` of Parquet rows, so Spark's committer, not a task, decides which
attempt of a task counts. Rows are (part, first, n_ids, doc_ids, payload): ``part`` is the
number of the sorted partition, ``first`` the ids before the shard in its part.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recurra.llm.bpe import byte_units
from recurra.llm.common import mix64, raw_bytes, slices, small_batches, text_of

MAGIC = b"RPS1"
HEADER = struct.Struct("<4sIIIIQ")
#: A shard is closed when it has this many ids (a longer document has a shard of its own).
SHARD_IDS = 1 << 20
#: A pair is replaced while it stands in at least this many places of a shard.
MIN_PLACES = 8
#: Rounds over a shard, and the most frequent pairs that one round replaces.
ROUNDS, ROUND_PAIRS = 8, 2048
_BUCKETS = 18
#: A worker forgets its encoded chunks when they take more bytes than this.
CACHE_BYTES = 96 << 20
_U = np.uint64


# --- encoding -------------------------------------------------------------------------------

#: Fixed value: the pre-tokenizer pattern whose tokens never span white space.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_KEY_BYTES = 24
_LONG = _U(1 << 62)                  # stands for the length of a chunk that is not found by key


def _flags(chars: bytes) -> np.ndarray:
    lut = np.zeros(256, bool)
    lut[list(chars)] = True
    return lut


_AFTER_C3 = _flags(bytes(b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)))


class ChunkEncoder:
    """Encodes texts with the library, each distinct chunk once per worker.

    Chunks are separated by ASCII white space, and a chunk also ends between a Latin letter and
    an ASCII mark that stands in no added token: the tokenizer's own pattern always splits at
    both. Chunks of up to 24 bytes are found again by their bytes as three integers, longer ones
    in a dictionary. For a tokenizer with another pre-tokenizer whole texts go to the library.
    """

    def __init__(self, spec: str):
        parsed = json.loads(spec)
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.vocabulary = self.library.get_vocab_size(with_added_tokens=True)
        norm, pre = parsed.get("normalizer") or {}, parsed.get("pre_tokenizer") or {}
        steps = pre.get("pretokenizers") or [{}]
        self.by_chunk = (
            [x["type"] for x in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and [x.get("type") for x in steps] == ["Split", "ByteLevel"]
            and steps[0]["pattern"].get("Regex") == WORD_SPLIT
            and not any(_LETTERS.fullmatch(t["content"]) for t in parsed.get("added_tokens", [])))
        marks = unicodedata.normalize("NFD", "".join(t["content"] for t in parsed.get("added_tokens", [])))
        closing = np.array([c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in marks])
        runs = np.split(closing, np.flatnonzero(np.diff(closing) > 1) + 1)
        self.closing = [(np.uint8(r[0]), len(r)) for r in runs if len(r)]
        units = byte_units()
        self.units = {b: units[b] for b in range(256)}
        self._clear()

    def _clear(self) -> None:
        self.long: dict[bytes, int] = {}
        self.long_bytes = 0
        self.keys = np.zeros((4, 1024), _U)          # three words and the length, by slot
        self.count = 0
        self.table = np.full(1 << 12, -1, np.int32)
        self.flat = np.zeros(1 << 12, np.int32)
        self.bounds = np.zeros(1025, np.int64)

    def _spans(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) of every chunk; ``data`` is followed by no padding here.

        White space, letters and closing marks are told by comparisons: looked up in a table
        of bytes they cost several times as much.
        """
        n = len(data)
        solid = (data != 32) & (data - np.uint8(9) > 4)
        new_text = np.zeros(n + 1, bool)
        new_text[off] = True
        begin, cut = solid.copy(), np.zeros(n, bool)
        begin[1:] &= ~solid[:-1] | new_text[1:n]
        letter = (data | np.uint8(32)) - np.uint8(97) < 26
        lead = data[:-1] == 0xC3
        if lead.any():
            letter[1:] |= lead & _AFTER_C3[data[1:]]
        closing = np.zeros(n, bool)
        for low, size in self.closing:
            closing |= data - low < size
        cut[1:] = closing[1:] & letter[:-1] & ~new_text[1:n]
        begin |= cut
        last = solid.copy()
        last[:-1] &= ~solid[1:] | begin[1:]
        return np.flatnonzero(begin), np.flatnonzero(last) + 1

    def _find(self, key: np.ndarray, spread: np.ndarray) -> np.ndarray:
        """Slots of the keys (columns), -1 where unknown."""
        found = np.full(key.shape[1], -1, np.int32)
        mask = _U(len(self.table) - 1)
        todo, at = np.arange(key.shape[1]), spread & mask
        while len(todo):
            slot = self.table[at]
            taken = slot >= 0
            same = taken & (self.keys[:, slot] == key[:, todo]).all(axis=0)
            found[todo[same]] = slot[same]
            on = taken & ~same
            todo, at = todo[on], (at[on] + _U(1)) & mask
        return found

    def _place(self, slot: np.ndarray, spread: np.ndarray) -> None:
        """Enter slots into the probed table."""
        mask = _U(len(self.table) - 1)
        at = spread & mask
        while len(slot):
            free = self.table[at] < 0
            self.table[at[free]] = slot[free]
            left = self.table[at] != slot
            slot, at = slot[left], (at[left] + _U(1)) & mask

    @staticmethod
    def _spread(key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64(key[0] ^ mix64(key[1] + key[3] ^ mix64(key[2])))

    def _library_ids(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk. A word of Latin letters is one pre-token that normalising only
        lower-cases, so it goes straight to the library's model."""
        model, units = self.library.model, self.units
        out: list = [None] * len(chunks)
        rest = []
        for i, chunk in enumerate(chunks):
            if _LETTERS.fullmatch(chunk):
                low = chunk.lower()
                word = low if low.isascii() else "".join([units[b] for b in low.encode("utf-8")])
                out[i] = [t.id for t in model.tokenize(word)]
            else:
                rest.append(i)
        for i, coded in zip(rest, self.library.encode_batch([chunks[i] for i in rest], add_special_tokens=False)):
            out[i] = coded.ids
        return out

    def _remember(self, chunks: list[bytes], key: np.ndarray | None) -> int:
        """Encode new chunks; returns the first of their slots. ``key``: of the short ones."""
        coded = self._library_ids([c.decode("utf-8") for c in chunks])
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        ids = np.fromiter((i for c in coded for i in c), np.int32, int(sizes.sum()))
        first, n = self.count, self.count + len(chunks)
        while n > self.keys.shape[1]:
            self.keys = np.concatenate([self.keys, np.zeros_like(self.keys)], axis=1)
            self.bounds = np.concatenate([self.bounds, np.zeros(self.keys.shape[1] + 1 - len(self.bounds), np.int64)])
        begin = int(self.bounds[first])
        while begin + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[begin:begin + len(ids)] = ids
        self.bounds[first + 1:n + 1] = begin + np.cumsum(sizes)
        self.keys[3, first:n] = _LONG
        self.count = n
        if key is not None:
            self.keys[:, first:n] = key
            new = np.arange(first, n, dtype=np.int32)
            if 2 * n > len(self.table):
                self.table = np.full(1 << (4 * n).bit_length(), -1, np.int32)
                new = np.flatnonzero(self.keys[3, :n] < _LONG).astype(np.int32)
            self._place(new, self._spread(self.keys[:, new]))
        return first

    def _slots(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Slots of the chunks. Arrow tells equal ones of this run of texts, each with the white
        space behind it, so the worker's table is asked once for each."""
        if len(start) == 0:
            return np.empty(0, np.int64)
        bounds = pa.py_buffer(np.r_[start, len(data)].astype(np.int64))
        chunks = pa.Array.from_buffers(pa.large_binary(), len(start), [None, bounds, pa.py_buffer(data)])
        coded = chunks.dictionary_encode()
        number = coded.indices.to_numpy()
        first = np.empty(len(coded.dictionary), np.int64)
        first[number[::-1]] = np.arange(len(start))[::-1]
        return self._distinct_slots(data, start[first], end[first])[number]

    def _distinct_slots(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        padded = np.concatenate([data, np.zeros(_KEY_BYTES + 8, np.uint8)])
        word = np.ndarray((len(padded) - 7,), "<u8", padded.data, strides=(1,))
        size = end - start
        short = np.flatnonzero(size <= _KEY_BYTES)
        s, z = start[short], size[short]
        key = np.empty((4, len(short)), _U)
        for i in range(3):
            bits = np.clip(z - 8 * i, 0, 8) * 8
            keep = np.where(bits >= 64, ~_U(0), (_U(1) << np.minimum(bits, 63).astype(_U)) - _U(1))
            key[i] = word[s + 8 * i] & keep
        key[3] = z
        spread = self._spread(key)
        found = self._find(key, spread)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            order = missing[np.argsort(spread[missing], kind="stable")]
            k = key[:, order]
            new = np.r_[True, (k[:, 1:] != k[:, :-1]).any(axis=0)]
            pick = order[new]
            raw = data.tobytes()
            first = self._remember([raw[a:a + n] for a, n in zip(s[pick].tolist(), z[pick].tolist())], key[:, pick])
            found[order] = first + np.cumsum(new) - 1
        slots = np.empty(len(start), np.int64)
        slots[short] = found
        for i in np.flatnonzero(size > _KEY_BYTES).tolist():
            chunk = data[start[i]:end[i]].tobytes()
            if chunk not in self.long:
                self.long[chunk] = self._remember([chunk], None)
                self.long_bytes += len(chunk) + 100
            slots[i] = self.long[chunk]
        return slots

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids one text after the other, number of ids of each text); NULL has none."""
        if not self.by_chunk:
            coded = [e.ids for e in self.library.encode_batch([t or "" for t in texts.to_pylist()],
                                                              add_special_tokens=False)]
            sizes = np.fromiter(map(len, coded), np.int64, len(coded))
            return np.fromiter((i for c in coded for i in c), np.int32, int(sizes.sum())), sizes
        if self.keys.nbytes + self.table.nbytes + self.flat.nbytes + self.bounds.nbytes + self.long_bytes > CACHE_BYTES:
            self._clear()
        data, off = raw_bytes(texts)
        if len(data) == 0:
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        start, end = self._spans(data, off)
        slot = self._slots(data, start, end)
        begin = self.bounds[slot]
        count = self.bounds[slot + 1] - begin
        to = np.concatenate([[0], np.cumsum(count)])
        ids = self.flat[np.arange(to[-1]) + np.repeat(begin - to[:-1], count)]
        edge = to[np.searchsorted(start, off)]
        return ids, np.diff(edge)


# --- Re-Pair --------------------------------------------------------------------------------

def _chosen(seq: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """(places, rule number of each) of one round: the first symbols of the replaced pairs.

    Pairs are counted in hashed buckets and the fullest buckets are ranked; where pairs share
    a ranked bucket, the commoner of two of them has it for this round. A place is taken if its pair ranks
    before the pairs that overlap it; in a run of one symbol every other place is taken. No
    pair begins at one of ``ends``, the last symbols of the documents.
    """
    n = len(seq) - 1
    if n < 1:
        return None
    mixed = seq[:-1] * np.uint32(0x9E3779B1)
    mixed += seq[1:] * np.uint32(0x85EBCA6B)
    mixed >>= np.uint32(32 - _BUCKETS)
    bucket = mixed.astype(np.intp)
    bucket[ends[:-1]] = 1 << _BUCKETS                                # a bucket of no pair
    places = np.bincount(bucket, minlength=(1 << _BUCKETS) + 1)
    places[-1] = 0
    often = np.flatnonzero(places >= MIN_PLACES)
    if len(often) == 0:
        return None
    often = often[np.argsort(-places[often], kind="stable")][:ROUND_PAIRS]
    none = len(often)
    rank_of = np.full((1 << _BUCKETS) + 1, none, np.int16)
    rank_of[often] = np.arange(none)
    rank = np.full(n + 2, none, np.int16)                            # a border on both sides
    np.take(rank_of, bucket, out=rank[1:-1], mode="clip")
    at = np.flatnonzero(rank[1:-1] < none)
    own, pair = rank[1:-1][at], seq[at].astype(_U) << _U(32) | seq[at + 1]
    owner, other = np.zeros(none, _U), np.zeros(none, _U)
    owner[own] = pair
    has = owner[own] == pair
    other[own[~has]] = pair[~has]                                    # where pairs share the bucket
    had, would = (np.bincount(own[x], minlength=none) for x in (has, other[own] == pair))
    owner = np.where(would > had, other, owner)
    has = owner[own] == pair
    has &= (np.bincount(own[has], minlength=none) >= MIN_PLACES)[own]
    rank[1:-1][at[~has]] = none
    at, own = at[has], own[has]
    if len(at) == 0:
        return None
    before, after = rank[at], rank[at + 2]
    take = (before > own) & (after >= own)
    inner = np.flatnonzero(before == own)                            # runs: all places but the first
    if len(inner):
        run = np.flatnonzero(np.r_[True, np.diff(inner) > 1])
        length = np.diff(np.r_[run, len(inner)])
        nth = np.arange(len(inner)) - np.repeat(run, length) + 1
        clear = np.repeat(rank[at[inner[run] - 1]] > own[inner[run]], length)
        take[inner] = clear & (nth % 2 == 0) & (after[inner] >= own[inner])
    at, own = at[take], own[take]
    used = np.bincount(own, minlength=none)
    worth = used >= max(2, MIN_PLACES // 2)
    if not worth.any():
        return None
    keep = worth[own]
    return at[keep], (np.cumsum(worth) - 1)[own[keep]]


def compress(ids: np.ndarray, counts: np.ndarray, base: int, rounds: int = ROUNDS) -> bytes:
    """One shard: the ids of documents, one after the other, each of ``counts`` ids.

    ``base`` is above every id; pairs do not cross document borders. While they fit, symbols
    take two bytes, and no more rules are made than that allows.
    """
    base = max(base, int(ids.max()) + 1 if len(ids) else 0)
    most = (1 << 16) - base if base < (1 << 16) - 256 else (1 << 31) - base
    counts = np.asarray(counts)
    seq = ids.astype(np.uint32)
    ends = np.cumsum(counts)[counts > 0] - 1                         # last symbol of every document
    left, right, length = (np.empty(0, np.int32) for _ in range(3))
    for _ in range(rounds):
        found = _chosen(seq, ends)
        if found is None:
            break
        at, rule = found
        room = most - len(left)
        at, rule = at[rule < room], rule[rule < room]
        if len(at) == 0:
            break
        some = np.zeros(int(rule.max()) + 1, np.int64)
        some[rule] = at                                              # one place of each rule
        a, b = seq[some].astype(np.int64), seq[some + 1].astype(np.int64)
        size = [np.where(x < base, 1, np.r_[length, 0][np.maximum(x - base, -1)]) for x in (a, b)]
        seq[at] = base + len(left) + rule
        ends = ends - np.searchsorted(at, ends)                      # the symbols at + 1 go
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        seq = seq[stay]
        left, right = np.r_[left, a].astype(np.int32), np.r_[right, b].astype(np.int32)
        length = np.r_[length, size[0] + size[1]].astype(np.int32)
    symbols = np.zeros(len(counts), np.int64)
    symbols[counts > 0] = np.diff(np.r_[-1, ends])
    width = 2 if base + len(left) <= 1 << 16 else 4
    kind = f"<u{width}"
    return b"".join([HEADER.pack(MAGIC, width, base, len(left), len(counts), len(seq)),
                     left.astype(kind).tobytes(), right.astype(kind).tobytes(), length.astype("<u4").tobytes(),
                     symbols.astype("<u4").tobytes(), counts.astype("<u4").tobytes(),
                     seq.astype(kind).tobytes()])


class Shard:
    """One shard's bytes, opened for reading."""

    def __init__(self, payload: bytes):
        magic, width, self.base, rules, docs, symbols = HEADER.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = HEADER.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out.astype(np.int64)

        self.left, self.right = take(f"<u{width}", rules), take(f"<u{width}", rules)
        self.length = take("<u4", rules)
        self.symbols, self.counts = take("<u4", docs), take("<u4", docs)
        self.seq = take(f"<u{width}", symbols)
        self._open_rules()

    def _open_rules(self) -> None:
        """The expansions of all rules; rules of one round use only rules of earlier rounds."""
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.zeros(int(self.length.sum()), np.int64)
        newest = np.maximum(self.left, self.right) - self.base
        done = 0
        while done < len(self.left):
            open_ = np.flatnonzero(newest[done:] >= done)
            stop = done + int(open_[0]) if len(open_) else len(self.left)
            both = np.stack([self.left[done:stop], self.right[done:stop]], axis=1).ravel()
            out = self.expand(both)
            self.flat[self.start[done]:self.start[done] + len(out)] = out
            done = stop

    def lengths(self, symbols: np.ndarray) -> np.ndarray:
        out = np.ones(len(symbols), np.int64)
        rule = symbols >= self.base
        out[rule] = self.length[symbols[rule] - self.base]
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        size = self.lengths(symbols)
        ids = np.repeat(symbols, size)
        nth = np.arange(len(ids)) - np.repeat(np.cumsum(size) - size, size)
        rule = ids >= self.base
        ids[rule] = self.flat[self.start[ids[rule] - self.base] + nth[rule]]
        return ids

    def document(self, number: int) -> np.ndarray:
        """The ids of one document; nothing else is expanded."""
        to = int(self.symbols[:number + 1].sum())
        return self.expand(self.seq[to - int(self.symbols[number]):to])

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of the shard, by the expansion lengths of its symbols."""
        to = np.cumsum(self.lengths(self.seq))
        start, stop = max(0, start), min(stop, int(to[-1]) if len(to) else 0)
        if start >= stop:
            return np.empty(0, np.int64)
        a, b = np.searchsorted(to, [start, stop - 1], side="right")
        out = self.expand(self.seq[a:b + 1])
        skip = start - (int(to[a - 1]) if a else 0)
        return out[skip:skip + stop - start]


# --- files ----------------------------------------------------------------------------------

_ENCODERS: dict[str, ChunkEncoder] = {}


def _encoder(vocabulary: str, bundle) -> ChunkEncoder:
    """The worker's encoder of a broadcast tokenizer file, built once."""
    if vocabulary not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[vocabulary] = ChunkEncoder(bundle.value)
    return _ENCODERS[vocabulary]


def _write(vocabulary: str, bundle, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, bundle)
        part, first = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        size = 0

        def shard() -> pa.RecordBatch:
            nonlocal first
            ids, counts = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            doc_ids = pa.concat_arrays([h[2] for h in held])
            payload = compress(ids, counts, encoder.vocabulary)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids),
                 pa.array([payload], pa.binary())], names=["part", "first", "n_ids", "doc_ids", "payload"])
            first += len(ids)
            return row

        for batch in batches:
            for at, texts in slices(batch.column("text")):
                ids, counts = encoder.encode(texts)
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id)                   # the end id of every document
                held.append((ids, counts + 1, batch.column("doc_id").slice(at, len(texts))))
                size += len(ids)
                if size >= SHARD_IDS:
                    yield shard()
                    held, size = [], 0
        if held:
            yield shard()
    return run


def write_shards(docs: DataFrame, path: str, vocabulary: str, *, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = 1) -> None:
    """Encode ``docs`` and write its shards under ``path``, in ascending order of the id.

    ``vocabulary`` is a tokenizer file of the public library. NULL texts are empty: such a
    document is its end id alone. NULL ids come first; rows of one id are ordered by a hash of
    their text, and a hot id spreads over as many sorted partitions as it needs. Other columns
    are not read. An empty table writes no shard. The vocabulary is broadcast: its size is
    that of the given file, a few megabytes. Memory of a task: one shard and the encoder's
    cache, both bounded (a single document of more ids makes a larger shard).
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(vocabulary, encoding="utf-8") as f:
        bundle = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    keyed = rows.select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("m"))
    key = [F.col("doc_id").asc_nulls_first(), "h", "m"]
    id_type = docs.schema[id_col].dataType.simpleString()
    (keyed.repartitionByRange(*key).sortWithinPartitions(*key).select("doc_id", "text")
     .mapInArrow(_write(vocabulary, bundle, end_id),
                 f"part int, first long, n_ids long, doc_ids array<{id_type}>, payload binary")
     .write.parquet(path))


def _read_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            shard = Shard(batch.column("payload")[row].as_py())
            ids = shard.expand(shard.seq).astype("<u4")
            ends = np.cumsum(shard.counts)
            begins = ends - shard.counts
            raw = ids.tobytes()
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_ids")[row].values,
                 pa.array(begins + batch.column("first")[row].as_py() + batch.column("before")[row].as_py()),
                 pa.array(shard.counts), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])


def _with_starts(shards: DataFrame) -> DataFrame:
    """Shards with ``before``: the ids of all earlier parts. One row per sorted partition is
    summed in a window and broadcast."""
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).cast("long").alias("before")))
    return shards.join(F.broadcast(parts), "part")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the shards alone.

    ``start`` counts the ids of all documents before it, ``n_tokens`` has the end id, and
    ``ids_crc32`` is of the ids as little-endian unsigned 32-bit integers.
    """
    shards = spark.read.parquet(path)
    id_type = shards.schema["doc_ids"].dataType.elementType.simpleString()
    small_batches(spark, 4)
    return (_with_starts(shards).select("first", "before", "doc_ids", "payload")
            .mapInArrow(_read_documents, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long"))


def read_ids(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """(start, ids) of the pieces of the range ``start`` to ``stop`` of all ids, one row per
    shard that it meets; other shards are not opened, other symbols not expanded."""
    shards = _with_starts(spark.read.parquet(path)).withColumn("at", F.col("before") + F.col("first"))
    met = shards.filter((F.col("at") < stop) & (F.col("at") + F.col("n_ids") > start)).select("at", "payload")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, payload in zip(batch.column("at").to_pylist(), batch.column("payload").to_pylist()):
                ids = Shard(payload).ids(start - at, stop - at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([max(at, start)], pa.int64()), pa.array([ids.tolist()], pa.list_(pa.int32()))],
                    names=["start", "ids"])

    return met.mapInArrow(cut, "start long, ids array<int>")
