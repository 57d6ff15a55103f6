"""Shared helpers of the training-data operators.

Conventions of the whole subpackage
-----------------------------------
* An operator picks the columns it needs by parameter, so extra columns never clash.
* A NULL text is an empty text; a NULL id is an ordinary value that sorts first.
* "Words" are maximal runs of bytes other than space and ``\\t \\n \\v \\f \\r``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.session import ensure_checkpoint_dir

WS = "\\x20\\x09-\\x0D"          # the white space of the word definition, as a regex class body
WORD_RE = f"[^{WS}]+"

#: Text bytes that one numpy pass handles at once inside a task (bounds a worker's memory).
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("string")


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bound the Arrow batches that go to the Python workers by rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def freeze(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    Used where two consumers must see the same physical layout (partition numbers,
    generated ids) or where an iteration would otherwise grow its lineage.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as a table of the shared checkpoint folder, and read from there.

    Cuts the lineage as ``freeze`` does, but computes ``df`` a single time and lets later
    stages read only the columns and rows they use.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def norm_space(col: Column) -> Column:
    """Every white-space run replaced by one space (runs that already are one space are skipped)."""
    return F.regexp_replace(col, f"[\\x09-\\x0D][{WS}]*|\\x20[{WS}]+", " ")


def keep_rows(docs: DataFrame, decisions: DataFrame, *, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``decisions`` (doc_id, text_sha, kept) keeps, columns unchanged.

    ``text_sha`` is the hex SHA-256 of the raw text. When an id repeats with the same
    text, one of those rows is returned (they are found by their count, so only they pay
    for the extra grouping).
    """
    key = F.struct(F.col(id_col).alias("i"), F.sha2(text_of(text_col), 256).alias("s"))
    rows = docs.select(F.struct("*").alias("row"), key.alias("key"))
    won = (decisions.groupBy("doc_id", "text_sha")
           .agg(F.count("*").alias("n"), F.max("kept").alias("kept")).filter("kept")
           .select(F.struct(F.col("doc_id").alias("i"), F.col("text_sha").alias("s")).alias("key"),
                   "n"))
    hit = rows.join(won, "key")
    once = hit.filter("n = 1").select("row")
    many = (hit.filter("n > 1").groupBy("key").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
            .select("row"))
    return once.unionByName(many).select("row.*")


# --- numpy text kernel: words and shingles of an Arrow string column -----------------------

_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the 64 output bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def seeded(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


_BASE = 0x5851F42D4C957F2D
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = seeded(256, 11)
_STEP = seeded(64, 23) | _U(1)


def _flags(chars: bytes) -> np.ndarray:
    lut = np.zeros(256, bool)
    lut[list(chars)] = True
    return lut


WHITE = _flags(b" \t\n\x0b\x0c\r")


def slices(arr: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Runs of rows of at most ``limit`` bytes together (a longer text makes a run of its own)."""
    if len(arr) == 0:
        return
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(arr), 0), dtype=np.int64))
    at = 0
    while at < len(arr):
        done = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, done + limit, side="right")))
        yield at, arr.slice(at, to - at)
        at = to


def raw_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, NULL as empty."""
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    _, off, data = arr.buffers()
    off = np.frombuffer(off, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.empty(0, np.uint8)
    return data, off - off[0]


class PrefixHash:
    """Polynomial prefix sums modulo 2^64: the hash of any byte range in constant time."""

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        with np.errstate(over="ignore"):
            power = np.full(n, _BASE, _U)
            power[0] = 1
            np.multiply.accumulate(power, out=power)
            self.inverse = np.full(n, _BASE_INV, _U)
            self.inverse[0] = 1
            np.multiply.accumulate(self.inverse, out=self.inverse)
            self.sums = np.zeros(n, _U)
            np.cumsum(_BYTE[data] * power[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (self.sums[end] - self.sums[start]) * self.inverse[start]
            return mix64(h + (end - start).astype(_U) * _U(0x9E3779B97F4A7C15) + _U(salt))


def words(data: np.ndarray, off: np.ndarray, white: np.ndarray = WHITE
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start byte, end byte) of every word, in order."""
    solid = ~white[data]
    first = np.zeros(len(data) + 1, bool)
    first[off[:-1]] = True
    first[-1] = True
    start, end = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1] | first[1:-1]
    end[:-1] &= ~solid[1:] | first[1:-1]
    s = np.flatnonzero(start)
    e = np.flatnonzero(end) + 1
    return np.searchsorted(off, s, side="right") - 1, s, e


def shingles(doc: np.ndarray, word_hash: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(word number of the first word, hash) of every run of ``size`` words inside one text.

    A text of fewer words (but one at least) has one shingle: all its words.
    """
    n = len(doc)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, _U)
    with np.errstate(over="ignore"):
        m = max(0, n - size + 1)
        acc = np.zeros(m, _U)
        for i in range(size):
            acc += word_hash[i:i + m] * _STEP[i]
        at = np.flatnonzero(doc[:m] == doc[size - 1:size - 1 + m])
        acc = acc[at]
        begin = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        count = np.diff(np.r_[begin, n])
        short = count < size
        if short.any():
            b, c = begin[short], count[short]
            more = np.zeros(len(b), _U)
            for i in range(size - 1):
                has = c > i
                more[has] += word_hash[b[has] + i] * _STEP[i]
            at, acc = np.r_[at, b], np.r_[acc, more + c.astype(_U)]
            order = np.argsort(at, kind="stable")
            at, acc = at[order], acc[order]
        return at, mix64(acc)
