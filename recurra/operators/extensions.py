"""Operators the reference only proposes in prose (built last, labelled extensions)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions import month_index, month_start, pg_round, to_money

REFERENCE_AS_OF = "2026-01-01"
REFERENCE_WINDOW_START = "2025-12-01"


def segment_users(s: DataFrame, pl: DataFrame, segment: str = "Enterprise") -> DataFrame:
    """Distinct users holding an Active subscription on a plan of ``segment``."""
    plans = pl.where(F.col("target_segment") == segment).select("plan_id")
    return (s.where(F.col("status") == "Active").select("user_id", "plan_id")
            .join(plans, "plan_id", "left_semi").select("user_id").distinct())


def x_ticket_alert(t: DataFrame, s: DataFrame, pl: DataFrame, *, hours: float = 12,
                   segment: str = "Enterprise") -> DataFrame:
    """Tickets of ``segment`` accounts unresolved after ``hours`` (open or slower)."""
    late = F.col("resolution_hours").isNull() | (F.col("resolution_hours") > hours)
    return (t.where(late).join(segment_users(s, pl, segment), "user_id", "left_semi")
            .select("ticket_id", "user_id", "created_date", "priority", "category",
                    F.col("resolution_hours").cast("double").alias("resolution_hours"),
                    (F.col("created_date") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                                F.lit(float(hours) * 3600)))
                    .alias("alert_at")))


def x_retry_recovery(p: DataFrame, *, days: int = 1) -> DataFrame:
    """Failed payments followed by a Paid one of the same subscription within ``days``
    days (strictly later), per month of the failure: failures, recovered, amount.

    Time is cut into ``days``-wide buckets. The window (t, t + days] of a failure
    in bucket b touches only buckets b and b + 1: a Paid payment in b qualifies iff
    the bucket's latest Paid time is after t, one in b + 1 iff the bucket's earliest
    Paid time is within t + days. So Paid rows reduce to (subscription, bucket) ->
    min/max time and each failure probes exactly 2 buckets by equi-join -- no range
    join, no per-day fan-out, and a busy subscription adds one row per bucket.
    """
    width = F.lit(days * 86400)
    bucket = F.floor(F.unix_seconds(F.col("payment_date").cast("timestamp")) / width)
    paid = (p.where(F.col("payment_status") == "Paid")
            .groupBy("subscription_id", bucket.alias("bucket"))
            .agg(F.min("payment_date").alias("first_ts"), F.max("payment_date").alias("last_ts")))
    fail = p.where(F.col("payment_status") == "Failed").select(
        "payment_id", "subscription_id", "payment_date", to_money("amount").alias("amount"),
        bucket.alias("b0"))
    probe = fail.select("payment_id", "subscription_id", "payment_date",
                        F.explode(F.array(F.lit(0), F.lit(1))).alias("k"), "b0") \
        .withColumn("bucket", F.col("b0") + F.col("k"))
    limit = F.col("payment_date") + F.make_dt_interval(F.lit(days))
    hit = (probe.join(paid, ["subscription_id", "bucket"])
           .where(F.when(F.col("k") == 0, F.col("last_ts") > F.col("payment_date"))
                  .otherwise(F.col("first_ts") <= limit))
           .select("payment_id").distinct().withColumn("recovered", F.lit(1)))
    flagged = fail.join(hit, "payment_id", "left")
    return (flagged.groupBy(month_start("payment_date").alias("month"))
            .agg(F.count(F.lit(1)).alias("failed_payments"),
                 F.count("recovered").alias("recovered_payments"),
                 F.coalesce(F.sum(F.when(F.col("recovered") == 1, F.col("amount"))),
                            F.lit(0)).alias("recovered"))
            .select("month", "failed_payments", "recovered_payments",
                    pg_round("recovered", 2).alias("recovered_amount"))
            .orderBy("month"))


def x_engagement_target(s: DataFrame, pl: DataFrame, pu: DataFrame, *,
                        window_start: str = REFERENCE_WINDOW_START, min_price: float = 99,
                        max_minutes: int = 60) -> DataFrame:
    """Active subscriptions priced at least ``min_price`` whose users logged fewer than
    ``max_minutes`` active minutes since ``window_start`` (usage pre-aggregated per user)."""
    minutes = (pu.where(F.col("event_date") >= F.lit(window_start).cast("date"))
               .groupBy("user_id").agg(F.sum("active_minutes").alias("minutes")))
    m = F.coalesce(F.col("minutes"), F.lit(0)).cast("long")
    return (s.where((F.col("status") == "Active") & (F.col("monthly_price") >= min_price))
            .join(pl.select("plan_id", "plan_name"), "plan_id")
            .join(minutes, "user_id", "left")
            .where(m < max_minutes)
            .select("subscription_id", "user_id", "plan_name",
                    F.col("monthly_price").cast("double").alias("monthly_price"),
                    m.alias("minutes_in_window")))


def x_trend_forecast(monthly: DataFrame, *, value: str = "mrr", horizon: int = 3) -> DataFrame:
    """Least-squares line over month number and the next ``horizon`` months' values."""
    x = (month_index("month")).cast("double")
    fit = monthly.agg(F.regr_slope(F.col(value).cast("double"), x).alias("slope"),
                      F.regr_intercept(F.col(value).cast("double"), x).alias("intercept"),
                      F.max("month").alias("last"))
    ahead = fit.select("slope", "intercept",
                       F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("k"), "last") \
        .withColumn("month", F.add_months("last", F.col("k")))
    return ahead.select("month", pg_round(F.col("intercept") + F.col("slope") *
                                          month_index("month").cast("double"), 2)
                        .alias("forecast"))
