"""Monthly KPIs refreshed by micro-batches: a keyed sink that a replayed batch does not change.

A micro-batch is reduced to a small delta of mergeable states (sums, counts, id bitmaps), the
deltas of its months are merged with the stored states of those months, and the result is
written as a new version of just those months. The batch counts once its commit is written;
what an unfinished batch left behind is never read and is overwritten when Spark replays the
batch under its old number. Folder layout::

    delta/batch=<id>            the batch's own states
    state/version=<id>/month=   merged states of the months that batch touched
    commits/batch=<id>          written last

The newest committed version of each month is the state. ``compact`` starts a new folder from it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from recurra.functions import month_start, pg_round, ratio, to_money
from recurra.session import apply_sql_conf, ensure_checkpoint_dir
from recurra.sources.schema import PAYMENTS, SUPPORT_TICKETS, TableSpec


@dataclass(frozen=True)
class MonthlyKpi:
    """How rows become states, states merge, and states are shown."""
    source: TableSpec
    schema: str                                   # of the state, without month
    delta: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    view: Callable[[DataFrame], DataFrame]


# --- the two KPI tables ---------------------------------------------------------------------

def _paid_delta(p: DataFrame) -> DataFrame:
    return (p.where(F.col("payment_status") == "Paid")
            .groupBy(month_start("payment_date").alias("month"),
                     F.bitmap_bucket_number(F.col("user_id")).alias("bucket"))
            .agg(F.sum(to_money("amount")).alias("paid"), F.count(F.lit(1)).alias("payments"),
                 F.bitmap_construct_agg(F.bitmap_bit_position(F.col("user_id"))).alias("ids")))


def _paid_merge(state: DataFrame) -> DataFrame:
    return state.groupBy("month", "bucket").agg(
        F.sum("paid").cast("decimal(38,2)").alias("paid"), F.sum("payments").alias("payments"),
        F.bitmap_or_agg("ids").alias("ids"))


def _paid_view(state: DataFrame) -> DataFrame:
    """The columns of ``kpi_monthly_paid``."""
    per_month = state.groupBy("month").agg(
        F.sum("paid").alias("m"), F.sum(F.bitmap_count("ids")).alias("paying_customers"),
        F.sum("payments").alias("payments"))
    return per_month.select("month", pg_round("m", 2).alias("mrr"), "paying_customers", "payments",
                            pg_round(F.col("m") * 12, 2).alias("arr"))


PAID = MonthlyKpi(PAYMENTS, "bucket long, paid decimal(38,2), payments long, ids binary",
                  _paid_delta, _paid_merge, _paid_view)


def sla(hours: float = 24) -> MonthlyKpi:
    def delta(t: DataFrame) -> DataFrame:
        hit = F.when(F.col("resolution_hours") <= hours, 1).otherwise(0)
        return t.groupBy(month_start("created_date").alias("month")).agg(
            F.count(F.lit(1)).alias("tickets"), F.sum(hit).cast("long").alias("hits"),
            F.sum(to_money("resolution_hours")).alias("hours"), F.count("resolution_hours").alias("resolved"))

    def merge(state: DataFrame) -> DataFrame:
        return state.groupBy("month").agg(
            F.sum("tickets").alias("tickets"), F.sum("hits").alias("hits"),
            F.sum("hours").cast("decimal(38,2)").alias("hours"), F.sum("resolved").alias("resolved"))

    def view(state: DataFrame) -> DataFrame:
        """The columns of ``q18_sla_trend``."""
        return state.select(F.col("month").alias("ticket_month"), F.col("tickets").alias("total_tickets"),
                            pg_round(ratio("hours", "resolved"), 2).alias("avg_resolution_hours"),
                            pg_round(ratio(F.col("hits") * 100, F.col("tickets")), 2)
                            .alias("sla_resolution_rate_percent"))

    return MonthlyKpi(SUPPORT_TICKETS, "tickets long, hits long, hours decimal(38,2), resolved long",
                      delta, merge, view)


# --- the sink -------------------------------------------------------------------------------

def last_commit(spark: SparkSession, folder: str) -> int | None:
    """The newest committed batch; earlier ones are committed too (a stream runs in order)."""
    try:
        return spark.read.schema("batch long").parquet(f"{folder}/commits").agg(F.max("batch")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current_state(spark: SparkSession, folder: str, kpi: MonthlyKpi, before: int | None = None
                  ) -> DataFrame | None:
    """The newest committed version of every month, of batches below ``before`` if given; None
    while there is none."""
    last = last_commit(spark, folder)
    if last is not None and before is not None:
        last = min(last, before - 1)
    if last is None or last < 0:
        return None
    state = (spark.read.schema(f"{kpi.schema}, version long, month date").parquet(f"{folder}/state")
             .where(F.col("version") <= last))
    newest = state.groupBy("month").agg(F.max("version").alias("version"))     # one row per month
    return state.join(F.broadcast(newest), ["month", "version"]).drop("version")


def _commit(spark: SparkSession, folder: str, batch_id: int) -> None:
    (spark.createDataFrame([(batch_id,)], "n long").coalesce(1)
     .write.mode("overwrite").parquet(f"{folder}/commits/batch={batch_id}"))


def upsert(rows: DataFrame, batch_id: int, folder: str, kpi: MonthlyKpi) -> None:
    """Bring ``rows``, the batch ``batch_id``, into the states under ``folder``.

    Doing so again with the same number and rows changes nothing: a committed batch returns
    at once, an unfinished one is computed from the versions before it and overwritten.
    """
    spark = rows.sparkSession
    last = last_commit(spark, folder)
    if last is not None and last >= batch_id:
        return
    path = f"{folder}/delta/batch={batch_id}"
    kpi.delta(rows).write.mode("overwrite").parquet(path)
    delta = spark.read.schema(f"month date, {kpi.schema}").parquet(path)
    old = current_state(spark, folder, kpi, before=batch_id)
    if old is not None:
        months = delta.select("month").distinct()                     # at most the calendar's months
        delta = delta.unionByName(old.join(F.broadcast(months), "month", "left_semi"))
    (kpi.merge(delta).repartition("month").write.mode("overwrite").partitionBy("month")
     .parquet(f"{folder}/state/version={batch_id}"))
    _commit(spark, folder, batch_id)


def compact(spark: SparkSession, folder: str, target: str, kpi: MonthlyKpi) -> None:
    """The current state as one version of a new folder, where the stream can go on."""
    last = last_commit(spark, folder)
    if last is None:
        raise ValueError(f"nothing is committed in {folder}")
    (current_state(spark, folder, kpi).repartition("month").write.partitionBy("month")
     .parquet(f"{target}/state/version={last}"))
    _commit(spark, target, last)


def start_monthly(spark: SparkSession, source_dir: str, folder: str, checkpoint_dir: str, kpi: MonthlyKpi, *,
                  max_files: int | None = None, available_now: bool = True) -> StreamingQuery:
    """The stream of a folder of Parquet files into the states under ``folder``. There is no
    watermark: no row is ever late, in whatever order files come."""
    apply_sql_conf(spark)
    reader = spark.readStream.schema(kpi.source.schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    writer = (reader.parquet(source_dir).writeStream
              .foreachBatch(lambda rows, batch_id: upsert(rows, batch_id, folder, kpi))
              .option("checkpointLocation", checkpoint_dir))
    return (writer.trigger(availableNow=True) if available_now
            else writer.trigger(processingTime="1 minute")).start()


def monthly_table(spark: SparkSession, folder: str, kpi: MonthlyKpi) -> DataFrame:
    """The KPI table as of the last commit (no rows before the first)."""
    state = current_state(spark, folder, kpi)
    if state is None:
        state = spark.createDataFrame([], f"month date, {kpi.schema}")
    return kpi.view(state)


def run_monthly(spark: SparkSession, source_dir: str, kpi: MonthlyKpi, *, max_files: int | None = None) -> DataFrame:
    """Drain what is in ``source_dir`` now and return the KPI table."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/recurra-stream/{uuid.uuid4().hex}"
    q = start_monthly(spark, source_dir, f"{base}/kpi", f"{base}/stream", kpi, max_files=max_files)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return monthly_table(spark, f"{base}/kpi", kpi)
