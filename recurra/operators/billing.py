"""Billing operators: duplicate charges, decline rates, payment profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions import pg_round, ratio


def q14_dup_payments(p: DataFrame) -> DataFrame:
    """(subscription, payment_date, amount) groups seen more than once, any status."""
    return (p.groupBy("subscription_id", "payment_date", "amount")
            .agg(F.count(F.lit(1)).alias("duplicate_occurrences"))
            .where(F.col("duplicate_occurrences") > 1)
            .select("subscription_id", "payment_date",
                    F.col("amount").cast("double").alias("amount"), "duplicate_occurrences"))


def q21_decline_rate(p: DataFrame) -> DataFrame:
    """Plan: payment attempts, failed ones, decline rate %."""
    failed = F.sum(F.when(F.col("payment_status") == "Failed", 1).otherwise(0))
    return (p.groupBy("plan_id")
            .agg(F.count(F.lit(1)).alias("payment_attempts"), failed.alias("failed"))
            .select("plan_id", "payment_attempts",
                    F.col("failed").cast("long").alias("failed_payments"),
                    pg_round(ratio(F.col("failed") * 100, F.col("payment_attempts")), 2)
                    .alias("payment_decline_rate_percent"))
            .orderBy(F.desc_nulls_first("payment_decline_rate_percent")))


def k2_quality_profile(p: DataFrame, key: str = "payment_id") -> DataFrame:
    """Rows and distinct payment ids."""
    return p.agg(F.count(F.lit(1)).alias("row_count"),
                 F.countDistinct(key).alias("distinct_records"))
