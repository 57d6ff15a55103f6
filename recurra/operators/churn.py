"""Churn operators: logo churn by month, inactivity warnings, churn reasons, churn by channel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions import month_start, pg_round, ratio

REFERENCE_AS_OF = "2026-01-01"
REFERENCE_WINDOW_START = "2025-12-01"


def q03_logo_churn(s: DataFrame, c: DataFrame) -> DataFrame:
    """Month of signups: new subscriptions, churn events that month, churned/new %."""
    signups = (s.groupBy(month_start("start_date").alias("active_month"))
               .agg(F.count("subscription_id").alias("new_signups")))
    churns = (c.groupBy(month_start("churn_date").alias("active_month"))
              .agg(F.count("subscription_id").alias("churned")))
    churned = F.coalesce(F.col("churned"), F.lit(0)).cast("long")
    return (signups.join(churns, "active_month", "left")
            .select("active_month", "new_signups",
                    churned.alias("churned_subscribers"),
                    pg_round(ratio(churned * 100, F.col("new_signups")), 2)
                    .alias("monthly_logo_churn_rate_percent"))
            .orderBy("active_month"))


def _risk_labels(hi: int, lo: int) -> tuple[str, str, str]:
    # fixed values: the reference's label texts (at hi=45, lo=30)
    return (f"Critical Risk ({hi}+ Days Inactive)",
            f"High Risk ({lo}-{hi} Days Inactive)",
            "Healthy Activity")


def q09_churn_warning(s: DataFrame, pl: DataFrame, pu: DataFrame, *,
                      as_of: str = REFERENCE_AS_OF, window_start: str = REFERENCE_WINDOW_START,
                      lo: int = 30, hi: int = 45, limit: int = 100) -> DataFrame:
    """Active subscriptions ranked by days since last product activity (top ``limit``)."""
    recent = (pu.where(F.col("event_date") >= F.lit(window_start).cast("date"))
              .groupBy("user_id")
              .agg(F.max("event_date").alias("last_active_date"),
                   F.sum("events").alias("recent_events")))
    inactive = F.datediff(F.lit(as_of).cast("date"),
                          F.coalesce(F.col("last_active_date"), F.col("start_date")))
    critical, high, healthy = _risk_labels(hi, lo)
    risk = (F.when(F.col("inactive_days") > hi, critical)
            .when(F.col("inactive_days").between(lo, hi), high).otherwise(healthy))
    return (s.where(F.col("status") == "Active")
            .join(pl.select("plan_id", "plan_name"), "plan_id")
            .join(recent, "user_id", "left")
            .select("subscription_id", "user_id",
                    F.col("plan_name").alias("subscription_tier"),
                    F.col("monthly_price").cast("double").alias("account_monthly_cost"),
                    F.coalesce(F.col("recent_events"), F.lit(0)).cast("long")
                    .alias("total_events_last_30_days"),
                    inactive.alias("inactive_days"))
            .withColumn("retention_risk_level", risk)
            # top-k: each task keeps its best ``limit`` rows, then one small merge
            .orderBy(F.desc_nulls_first("inactive_days"), F.asc("total_events_last_30_days"),
                     F.asc("subscription_id"))
            .limit(limit)
            .drop("subscription_id"))


def q16_churn_reasons(c: DataFrame) -> DataFrame:
    """Churn reason: occurrences, share of all churn events, mean lost MRR."""
    by_reason = c.groupBy("churn_reason").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("mrr").cast("decimal(38,2)")).alias("lost"),
        F.count("mrr").alias("n_mrr"))
    # reasons are free text (unbounded): the total is a scalar subquery, not a
    # global window over all reason rows
    total = c.agg(F.count(F.lit(1))).scalar()
    return by_reason.select(
        "churn_reason",
        F.col("n").alias("churn_occurrences"),
        pg_round(ratio(F.col("n") * 100, total), 2).alias("churn_percentage"),
        pg_round(ratio("lost", "n_mrr"), 2).alias("average_lost_mrr"),
    ).orderBy(F.desc_nulls_first("churn_occurrences"))


def n4_channel_churn(s: DataFrame, u: DataFrame) -> DataFrame:
    """Acquisition channel: subscriptions, churned ones, churn rate % (descending)."""
    per_user = s.groupBy("user_id").agg(
        F.count("subscription_id").alias("n"),
        F.sum(F.when(F.col("status") == "Churned", 1).otherwise(0)).alias("churned"))
    by_channel = (per_user.join(u.select("user_id", "acquisition_channel"), "user_id")
                  .groupBy("acquisition_channel")
                  .agg(F.sum("n").cast("long").alias("total_customers"),
                       F.sum("churned").cast("long").alias("churned_customers")))
    return by_channel.withColumn(
        "churn_rate", ratio("churned_customers", "total_customers") * 100
    ).orderBy(F.desc_nulls_first("churn_rate"))
