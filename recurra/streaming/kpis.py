"""Structured Streaming: incremental paid revenue and Enterprise ticket alerts.

* ``daily_paid``: watermarked 1-day event-time windows of Paid inflow (a day is emitted once);
* ``daily_totals``: the running total of every day, complete after each trigger;
* ``ticket_alerts``: stream-static semi join of streamed tickets with the accounts
  of a plan segment.

Monthly tables that a replayed batch does not change are in ``upsert``, alerts from the two
feeds of opened and resolved tickets in ``tickets``.

All read a directory of Parquet files as they arrive (schema from the canonical
contract), keep the semantics of their batch operators, and write to a Parquet
sink with a checkpoint, so a restarted query continues where it stopped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from recurra.operators.extensions import segment_users
from recurra.session import apply_sql_conf, ensure_checkpoint_dir
from recurra.sources.schema import PAYMENTS, SUPPORT_TICKETS


def payments_stream(spark: SparkSession, source_dir: str, max_files: int | None = None) -> DataFrame:
    """``max_files`` bounds a micro-batch. A watermarked stream over files that are not in
    time order must leave it unset: rows older than the watermark of an earlier batch
    are dropped."""
    apply_sql_conf(spark)
    reader = spark.readStream.schema(PAYMENTS.schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(source_dir)


def daily_paid(stream: DataFrame, *, lateness: str = "3 days") -> DataFrame:
    """Paid inflow per day with an event-time watermark: a day is emitted once the
    watermark passes its end, and late rows within ``lateness`` still count.

    Watermarks need a ``timestamp`` event time; the wall-clock ``timestamp_ntz`` is
    read as UTC (the session time zone the library pins), so 1-day windows start at
    the same midnights as the batch day buckets.
    """
    return (stream.where(F.col("payment_status") == "Paid")
            .withColumn("event_ts", F.col("payment_date").cast("timestamp"))
            .withWatermark("event_ts", lateness)
            .groupBy(F.window("event_ts", "1 day").alias("w"))
            .agg(F.sum(F.col("amount").cast("decimal(38,2)")).alias("inflow"),
                 F.count(F.lit(1)).alias("payments"))
            .select(F.to_date(F.col("w.start")).alias("sale_day"), "inflow", "payments"))


def daily_totals(stream: DataFrame) -> DataFrame:
    """Paid inflow of every day so far. There is no watermark, so no row is ever late and
    the newest day is there too; the state is one row per calendar day."""
    return (stream.where(F.col("payment_status") == "Paid")
            .groupBy(F.to_date("payment_date").alias("sale_day"))
            .agg(F.sum(F.col("amount").cast("decimal(38,2)")).alias("inflow"),
                 F.count(F.lit(1)).alias("payments")))


def run_daily_totals(spark: SparkSession, source_dir: str, *, max_files: int | None = None) -> DataFrame:
    """Drain what is in ``source_dir`` now and return the totals of every day: equal to the
    batch result, in however many micro-batches and whatever order the files come. The
    complete-mode result (one row per calendar day) is held as an in-memory table."""
    name = f"daily_totals_{uuid.uuid4().hex}"
    state = f"{ensure_checkpoint_dir(spark).rstrip('/')}/recurra-stream/{uuid.uuid4().hex}"
    q = (daily_totals(payments_stream(spark, source_dir, max_files)).writeStream
         .format("memory").queryName(name).outputMode("complete")
         .option("checkpointLocation", state).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.table(name)


def start_daily_paid(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                     *, available_now: bool = True, lateness: str = "3 days") -> StreamingQuery:
    """Daily paid inflow from a directory of payments Parquet files into a Parquet sink."""
    q = (daily_paid(payments_stream(spark, source_dir), lateness=lateness)
         .writeStream.format("parquet").outputMode("append")
         .option("path", sink_dir).option("checkpointLocation", checkpoint_dir))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()


def tickets_stream(spark: SparkSession, source_dir: str) -> DataFrame:
    return spark.readStream.schema(SUPPORT_TICKETS.schema).parquet(source_dir)


def ticket_alerts(tickets: DataFrame, s: DataFrame, pl: DataFrame, *, hours: float = 12,
                  segment: str = "Enterprise") -> DataFrame:
    """Stream-static: streamed tickets of segment accounts unresolved after ``hours``."""
    late = F.col("resolution_hours").isNull() | (F.col("resolution_hours") > hours)
    return (tickets.where(late).join(segment_users(s, pl, segment), "user_id", "left_semi")
            .select("ticket_id", "user_id", "created_date", "priority", "category",
                    F.col("resolution_hours").cast("double").alias("resolution_hours")))


def start_ticket_alerts(spark: SparkSession, source_dir: str, s: DataFrame, pl: DataFrame,
                        sink_dir: str, checkpoint_dir: str, *, hours: float = 12,
                        available_now: bool = True) -> StreamingQuery:
    """Alerts for streamed tickets (stream-static semi join) into a Parquet sink."""
    q = (ticket_alerts(tickets_stream(spark, source_dir), s, pl, hours=hours)
         .writeStream.format("parquet").outputMode("append")
         .option("path", sink_dir).option("checkpointLocation", checkpoint_dir))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()


def run_available_now(spark: SparkSession, start, *args, timeout_s: int | None = None,
                      **kwargs) -> DataFrame:
    """Run a stream over everything currently in its source and return the sink
    contents. Sink and stream checkpoint live in a fresh folder under the shared
    checkpoint dir. ``timeout_s`` is unset by default: draining takes as long as it takes."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/recurra-stream/{uuid.uuid4().hex}"
    q = start(spark, *args, sink_dir=f"{base}/out", checkpoint_dir=f"{base}/state", **kwargs)
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream did not drain its source within {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(f"{base}/out")
