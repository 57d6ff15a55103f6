"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

Terms are trigrams of character classes and a few word-repetition events, counted per text.
Counts are weighted by log(1 + tf) * idf, projected on the leading singular directions of a
bounded labelled sample, and scaled to length 1. Every document is then compared with all
sample vectors (blocked matrix products in the tasks), and the labels of its nearest
neighbours vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.llm.common import (_U, PrefixHash, _flags, mix64, raw_bytes, shingles, slices, small_batches,
                                text_of, words)

#: Bound of the labelled sample that is collected, broadcast and searched.
MAX_LABELLED = 4096
DIMENSIONS = 48
NEIGHBOURS = 25
#: Weight of the sample's mean label among the votes: decides texts without terms.
PRIOR_WEIGHT = 0.05
_BLOCK = 256

# Character classes (fixed values): the bytes of each class, the rest are letters.
_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\x0b\x0c\r", b".,;:", b"!?", b"|<>",
            b"#*$%&", b"\"'()[]{}-_/\\@+=^~`")
N_CLASSES = len(_CLASSES) + 1
N_GRAMS = N_CLASSES ** 3
#: After the trigrams: a word equal to the one before; a 5-word run seen before in the text;
#: a word seen before; a word; a line seen before.
N_TERMS = N_GRAMS + 5
_CLASS = np.zeros(256, np.int64)
for _i, _c in enumerate(_CLASSES):
    _CLASS[list(_c)] = _i + 1
_NEWLINE = _flags(b"\n")


def _seen_before(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """True for values that occur earlier in the same text."""
    with np.errstate(over="ignore"):
        key = mix64(h ^ mix64(doc.astype(_U)))
    _, first = np.unique(key, return_index=True)
    out = np.ones(len(key), bool)
    out[first] = False
    return out


def term_counts(texts: pa.Array) -> np.ndarray:
    """Texts x N_TERMS matrix of counts (NULL and empty: zeros)."""
    data, off = raw_bytes(texts)
    n = len(texts)
    out = np.zeros((n, N_TERMS), np.float32)
    if len(data) == 0:
        return out
    cls = _CLASS[data]
    row = np.repeat(np.arange(n), np.diff(off))
    if len(data) > 2:
        gram = (cls[:-2] * N_CLASSES + cls[1:-1]) * N_CLASSES + cls[2:]
        inside = row[:-2] == row[2:]
        flat = (row[:-2] * N_GRAMS + gram)[inside]
        out[:, :N_GRAMS] = np.bincount(flat, minlength=n * N_GRAMS).reshape(n, N_GRAMS)
    doc, start, end = words(data, off)
    if len(doc):
        prefix = PrefixHash(data)
        h = prefix.of(start, end)
        again = np.zeros(len(doc), bool)
        again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        at, runs = shingles(doc, h, 5)
        l_doc, l_start, l_end = words(data, off, _NEWLINE)
        events = ((doc, again), (doc[at], _seen_before(doc[at], runs)), (doc, _seen_before(doc, h)),
                  (doc, np.ones(len(doc), bool)), (l_doc, _seen_before(l_doc, prefix.of(l_start, l_end))))
        for i, (owner, event) in enumerate(events):
            out[:, N_GRAMS + i] = np.bincount(owner, weights=event, minlength=n)
    return out


@dataclass(frozen=True)
class Voter:
    """The fitted space: term weights, projection, sample vectors and their labels."""
    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int

    def embed(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_unit(np.log1p(counts) * self.idf) @ self.projection)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest sample vectors."""
        if len(self.labels) == 0:
            return np.full(len(counts), 0.5)
        prior = self.labels.mean()
        k = min(self.neighbours, len(self.labels))
        out = np.empty(len(counts))
        vec = self.embed(counts)
        for lo in range(0, len(vec), _BLOCK):
            # float32 products, all neighbours: exact search
            sim = vec[lo:lo + _BLOCK] @ self.vectors.T
            near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(sim, near, axis=1), 0).astype(float) ** 8
            votes = (weight * self.labels[near]).sum(axis=1)
            out[lo:lo + _BLOCK] = (votes + PRIOR_WEIGHT * prior) / (weight.sum(axis=1) + PRIOR_WEIGHT)
        return np.clip(out, 0.0, 1.0)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(norm > 0, norm, 1)).astype(np.float32)


def fit_voter(counts: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS,
              neighbours: int = NEIGHBOURS) -> Voter:
    """Weights, singular directions (subspace iteration from a fixed start) and vectors."""
    n = len(labels)
    idf = np.log((1 + n) / (1 + (counts > 0).sum(axis=0))) + 0.05
    x = _unit(np.log1p(counts) * idf).astype(np.float64)
    d = min(dimensions, n, x.shape[1])
    start = np.random.default_rng(5).standard_normal((x.shape[1], d))
    basis = np.linalg.qr(start)[0] if d else start
    for _ in range(6):
        if d:
            basis = np.linalg.qr(x.T @ (x @ basis))[0]
    basis = basis.astype(np.float32)
    return Voter(idf.astype(np.float32), basis, _unit(x.astype(np.float32) @ basis), labels.astype(float), neighbours)


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse term counts of each text: (id, label, terms, counts)."""
    for batch in batches:
        for at, texts in slices(batch.column("text")):
            counts = term_counts(texts)
            rows = [np.flatnonzero(c) for c in counts]
            part = batch.slice(at, len(texts))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("label"),
                 pa.array([r.astype(np.uint16).tobytes() for r in rows], pa.binary()),
                 pa.array([counts[i, r].tobytes() for i, r in enumerate(rows)], pa.binary())],
                names=["id", "label", "terms", "counts"])


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_labelled: int = MAX_LABELLED, **params) -> Voter:
    """Fit on at most ``max_labelled`` labelled rows, chosen by the MD5 of their id.

    Rows without an id or a label are left out; ids that repeat count once, with the
    smallest label, and the smallest text. Without any labelled text every score is 0.5.
    """
    small_batches(docs.sparkSession)
    chosen = (labels.select(F.col(id_col).cast("string").alias("id"), F.col(label_col).cast("double").alias("label"))
              .filter("id is not null and label is not null")
              .groupBy("id").agg(F.min("label").alias("label"))
              .orderBy(F.md5("id"), "id").limit(max_labelled))
    texts = docs.select(F.col(id_col).cast("string").alias("id"), text_of(text_col).alias("text"))
    # the sample is bounded by max_labelled rows of an id and a label, so it may be broadcast
    rows = texts.join(F.broadcast(chosen), "id").select("id", "label", "text")
    found = rows.mapInArrow(_count_rows, "id string, label double, terms binary, counts binary")
    best = (found.groupBy("id").agg(F.min(F.struct("terms", "counts", "label")).alias("m"))
            .select("id", "m.*").orderBy("id").limit(max_labelled).toArrow())
    counts = np.zeros((best.num_rows, N_TERMS), np.float32)
    for i, (terms, values) in enumerate(zip(best.column("terms").to_pylist(), best.column("counts").to_pylist())):
        counts[i, np.frombuffer(terms, np.uint16)] = np.frombuffer(values, np.float32)
    return fit_voter(counts, np.asarray(best.column("label"), dtype=float), **params)


def score_quality(docs: DataFrame, voter: Voter, *, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = 0.7) -> DataFrame:
    """One row per input row: doc_id, score (0 to 1), predicted (1 if score >= threshold).

    Only the text counts. NULL and empty texts have no terms: the sample's mean label
    decides. Repeated rows score alike; rows are independent, so there is no shuffle.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(voter)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.score(term_counts(t)) for _, t in slices(batch.column("text"), 1 << 19)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.concatenate([np.empty(0), *scores]))], names=["id", "score"])

    rows = docs.select(F.col(id_col).cast("string").alias("id"), text_of(text_col).alias("text"))
    scored = rows.mapInArrow(run, "id string, score double")
    return scored.select(F.col("id").cast(id_type).alias("doc_id"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
