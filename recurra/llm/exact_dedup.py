"""Exact dedup by content sort.

Sampled splitters range-partition the normalised bytes, an external sort places equal texts
side by side in each partition, and neighbours are compared in full. The sort key is the
first 64 characters, then the text's SHA-256 as a tie-break of long common prefixes, then
the id: short keys keep the splitter sample small, and the id in the key lets a group of
copies of any size spread over as many partitions as it needs. Runs that cross a partition
border are put together from a table with two rows per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recurra.llm.common import freeze, keep_rows, norm_space, small_batches, text_of

_MARKED = ("id_bits binary, text_sha string, digest string, pid int, run long, "
           "starts boolean, head boolean, tail boolean, edge string")


def _mark_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the runs of equal neighbours of one sorted partition; only the first and the
    last row carry their text on."""
    pid = TaskContext.get().partitionId()
    before, run, first, held = None, -1, True, None

    def out(batch: pa.RecordBatch, starts, runs, head: bool = False, tail: bool = False,
            edge: str | None = None) -> pa.RecordBatch:
        n = batch.num_rows
        return pa.RecordBatch.from_arrays(
            [batch.column("id_bits"), batch.column("text_sha"), batch.column("digest"),
             pa.array(np.full(n, pid, np.int32)), pa.array(runs), pa.array(starts),
             pa.array([head] * n), pa.array([tail] * n), pa.array([edge] * n, pa.string())],
            names=["id_bits", "text_sha", "digest", "pid", "run", "starts", "head", "tail", "edge"])

    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        text = batch.column("norm")
        starts = np.ones(n, bool)
        starts[1:] = ~np.asarray(pc.equal(text.slice(1), text.slice(0, n - 1)))
        starts[0] = before is None or text[0].as_py() != before
        runs = run + np.cumsum(starts).astype(np.int64)
        before, run = text[n - 1].as_py(), int(runs[-1])
        if held is not None:
            yield out(*held)
        lo = 0
        if first:
            first = False
            yield out(batch.slice(0, 1), starts[:1], runs[:1], head=True, tail=False,
                      edge=text[0].as_py())
            lo = 1
        held = None
        if n > lo:
            if n - 1 > lo:
                yield out(batch.slice(lo, n - 1 - lo), starts[lo:n - 1], runs[lo:n - 1])
            held = (batch.slice(n - 1), starts[n - 1:], runs[n - 1:])
    if held is not None:
        yield out(*held, tail=True, edge=before)


def equal_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, text_sha.

    Texts are equal when identical after white-space runs became one space; NULL is the
    empty text. ``keep_id`` is the group's smallest id (NULL ids last); exactly one row of
    a group is ``kept``, also where rows repeat with the same id. ``text_sha256`` is of the
    normalised text, ``text_sha`` of the raw one. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    rows = rows.select("doc_id", F.sha2("t", 256).alias("text_sha"), norm_space(F.col("t")).alias("norm"))
    key = [F.col("prefix"), F.col("digest"), F.col("doc_id").asc_nulls_last(), F.col("text_sha")]
    ranged = (rows.select("doc_id", "text_sha", "norm", F.substring("norm", 1, 64).alias("prefix"),
                          F.sha2("norm", 256).alias("digest"))
              .repartitionByRange(*key).sortWithinPartitions(*key))
    marked = freeze(
        ranged.select(F.col("doc_id").cast("string").cast("binary").alias("id_bits"),
                      "text_sha", "digest", "norm")
        .mapInArrow(_mark_runs, _MARKED)
        .withColumn("doc_id", F.col("id_bits").cast("string").cast(id_type)).drop("id_bits"))

    # borders: does a partition's first run go on from the last run of the one before?
    edges = marked.filter("edge is not null")
    heads = edges.filter("head").select("pid", F.col("edge").alias("first_text"))
    # the last row of a partition is its tail row, or its head row when it has one row only
    tails = (edges.groupBy("pid").agg(F.max_by(F.struct("run", "edge"), F.col("tail")).alias("e"))
             .select("pid", F.col("e.run").alias("last_run"), F.col("e.edge").alias("last_text")))
    by_pid = Window.orderBy("pid")
    follow = heads.select("pid", F.lag("pid").over(by_pid).alias("prev_pid"))
    parts = (heads.join(follow, "pid")
             .join(tails.select(F.col("pid").alias("prev_pid"), F.col("last_text").alias("prev_text")),
                   "prev_pid", "left")
             .join(tails.select("pid", "last_run"), "pid")
             .select("pid", "last_run",
                     F.coalesce(F.col("first_text") == F.col("prev_text"), F.lit(False)).alias("joined")))
    fresh = F.when(~F.col("joined") | (F.col("last_run") > 0), F.struct("pid", "last_run"))
    owner = F.last(fresh, ignorenulls=True).over(by_pid.rowsBetween(Window.unboundedPreceding, -1))
    owners = (parts.select("pid", "joined", owner.alias("o")).filter("joined")
              .select("pid", F.lit(0).cast("long").alias("run"),
                      F.col("o.pid").alias("o_pid"), F.col("o.last_run").alias("o_run")))

    runs = (marked.groupBy("pid", "run").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
            .join(owners, ["pid", "run"], "left")
            .withColumn("o_pid", F.coalesce("o_pid", "pid")).withColumn("o_run", F.coalesce("o_run", "run")))
    groups = runs.groupBy("o_pid", "o_run").agg(F.min("first_id").alias("keep_id"),
                                                 F.sum("n").alias("group_size"))
    known = runs.select("pid", "run", "o_pid", "o_run").join(groups, ["o_pid", "o_run"])
    return marked.join(known, ["pid", "run"]).select(
        "doc_id", "keep_id", "group_size",
        (F.col("starts") & (F.col("o_pid") == F.col("pid")) & (F.col("o_run") == F.col("run"))).alias("kept"),
        F.col("digest").alias("text_sha256"), "text_sha")


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay (one per group of equal texts), columns unchanged."""
    return keep_rows(docs, equal_groups(docs, id_col=id_col, text_col=text_col),
                     id_col=id_col, text_col=text_col)
