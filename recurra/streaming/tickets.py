"""Alerts for tickets left open too long: a stream-stream join of openings and resolutions.

Openings are joined with the resolutions of the same ticket within the allowed hours; the join is a
left outer one with watermarks on both sides, so an opening comes out without a partner
exactly when the watermark has passed its deadline and no resolution in time was seen. All state
is Spark's own (on the JVM): openings until their deadline, resolutions as long as an opening
could still want them. A late resolution needs no attention: its ticket is alerted already.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from recurra.operators.extensions import segment_users
from recurra.session import apply_sql_conf, ensure_checkpoint_dir

OPENED = ("ticket_id long, user_id long, created_date timestamp_ntz, priority string, category string")
RESOLVED = "ticket_id long, resolved_at timestamp_ntz"


def later(column: str, hours: float) -> Column:
    """The column plus some hours (to the second), as a literal interval: the planner reads the
    bound on the state from it."""
    return F.expr(f"{column} + INTERVAL '{round(hours * 3600)}' SECOND")


def feed(spark: SparkSession, folder: str, schema: str, max_files: int | None = None) -> DataFrame:
    apply_sql_conf(spark)
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def unresolved(opened: DataFrame, resolved: DataFrame, users: DataFrame, *, hours: float = 12,
               lateness: str = "1 day") -> DataFrame:
    """(ticket_id, user_id, created_date, priority, category, alert_at) of tickets of ``users``
    that were not resolved within ``hours``; resolved exactly at the deadline is in time.

    ``lateness`` must cover how far out of order the two feeds' files are: a row older than
    the newest one seen by more than that is dropped by the watermark. A row without ids only
    moves its feed's clock (for quiet feeds, or to close one).
    """
    # keys are read through the event time: a filter on such a key stays above the watermark,
    # which must see every row, those without a key too
    o = (opened.withColumn("opened_ts", F.col("created_date").cast("timestamp")).withWatermark("opened_ts", lateness)
         .withColumn("user_id", F.when(F.col("opened_ts").isNotNull(), F.col("user_id")))
         .join(users.select("user_id"), "user_id", "left_semi"))
    r = (resolved.withColumn("resolved_ts", F.col("resolved_at").cast("timestamp")).withWatermark("resolved_ts", lateness)
         .select(F.when(F.col("resolved_ts").isNotNull(), F.col("ticket_id")).alias("resolved_id"), "resolved_ts"))
    in_time = ((F.col("ticket_id") == F.col("resolved_id")) & (F.col("resolved_ts") >= F.col("opened_ts"))
               & (F.col("resolved_ts") <= later("opened_ts", hours)))
    return (o.join(r, in_time, "left_outer").where(F.col("resolved_id").isNull())
            .select("ticket_id", "user_id", "created_date", "priority", "category",
                    later("created_date", hours).alias("alert_at")))


def start_unresolved(spark: SparkSession, opened_dir: str, resolved_dir: str, s: DataFrame, pl: DataFrame,
                     sink_dir: str, checkpoint_dir: str, *, hours: float = 12, lateness: str = "1 day",
                     segment: str = "Enterprise", max_files: int | None = None,
                     available_now: bool = True) -> StreamingQuery:
    """Alerts of ``segment`` accounts from two folders of Parquet files into a Parquet sink."""
    alerts = unresolved(feed(spark, opened_dir, OPENED, max_files), feed(spark, resolved_dir, RESOLVED, max_files),
                        segment_users(s, pl, segment), hours=hours, lateness=lateness)
    q = (alerts.writeStream.format("parquet").outputMode("append")
         .option("path", sink_dir).option("checkpointLocation", checkpoint_dir))
    return (q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")).start()


def write_feeds(tickets: DataFrame, folder: str) -> tuple[str, str]:
    """The two feeds of a ticket table: its openings, and its resolutions as rows of their own."""
    opened, resolved = f"{folder}/opened", f"{folder}/resolved"
    tickets.select("ticket_id", "user_id", "created_date", "priority", "category").write.mode("append").parquet(opened)
    at = F.col("created_date") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                    (F.col("resolution_hours") * 3600).cast("decimal(18,6)"))
    (tickets.where(F.col("resolution_hours").isNotNull()).select("ticket_id", at.alias("resolved_at"))
     .write.mode("append").parquet(resolved))
    return opened, resolved


def write_clock(spark: SparkSession, opened: str, resolved: str, at: str) -> None:
    """One row per feed that says "it is now ``at``"."""
    now = spark.range(1).select(F.lit(None).cast("long").alias("ticket_id"),
                                F.lit(at).cast("timestamp_ntz").alias("at"))
    (now.select("ticket_id", F.lit(None).cast("long").alias("user_id"), F.col("at").alias("created_date"),
                F.lit(None).cast("string").alias("priority"), F.lit(None).cast("string").alias("category"))
     .write.mode("append").parquet(opened))
    now.select("ticket_id", F.col("at").alias("resolved_at")).write.mode("append").parquet(resolved)


def run_unresolved(spark: SparkSession, tickets: DataFrame, s: DataFrame, pl: DataFrame, *, close_at: str,
                   **params) -> DataFrame:
    """Write the feeds of ``tickets``, let the clock say ``close_at`` at their end, drain both,
    and return the alerts."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/recurra-stream/{uuid.uuid4().hex}"
    opened, resolved = write_feeds(tickets, f"{base}/feeds")
    write_clock(spark, opened, resolved, close_at)
    q = start_unresolved(spark, opened, resolved, s, pl, f"{base}/out", f"{base}/state", **params)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(f"{base}/out")
