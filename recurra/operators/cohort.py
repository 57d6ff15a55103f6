"""Cohort operators: signup-month cohorts by months since signup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions import month_diff, month_start, ratio


def _user_payment_months(p: DataFrame, paid_only: bool) -> DataFrame:
    """Distinct (user, payment month): pre-aggregated before the join with users,
    so a user with very many payments contributes at most one row per month."""
    if paid_only:
        p = p.where(F.col("payment_status") == "Paid")
    return p.select("user_id", month_start("payment_date").alias("active_month")).distinct()


def _cohort_rows(p: DataFrame, u: DataFrame, max_index: int, paid_only: bool) -> DataFrame:
    cohorts = u.select("user_id", month_start("signup_date").alias("cohort_month"))
    return (_user_payment_months(p, paid_only).join(cohorts, "user_id")
            .withColumn("month_index", month_diff("active_month", "cohort_month").cast("int"))
            .where(F.col("month_index").between(0, max_index)))


def q07_cohort_counts(p: DataFrame, u: DataFrame, *, max_index: int = 12) -> DataFrame:
    """Cohort month x month index (0..max_index): distinct users with a Paid payment."""
    # rows are unique per (user, month) and the month fixes the index, so a plain
    # count equals COUNT(DISTINCT user_id) without a second distinct shuffle
    return (_cohort_rows(p, u, max_index, paid_only=True)
            .groupBy("cohort_month", "month_index")
            .agg(F.count(F.lit(1)).alias("active_subscribers"))
            .orderBy("cohort_month", "month_index"))


def cohort_counts_all_statuses(p: DataFrame, u: DataFrame, *, max_index: int = 12) -> DataFrame:
    """Long form of the notebook matrix: distinct paying users (any status) per cell,
    with the month-0 size and retention % of month 0 (NULL when month 0 is absent)."""
    cells = (_cohort_rows(p, u, max_index, paid_only=False)
             .groupBy("cohort_month", "month_index")
             .agg(F.count(F.lit(1)).alias("users")))
    base = cells.where(F.col("month_index") == 0).select(
        "cohort_month", F.col("users").alias("cohort_size"))
    return (cells.join(base, "cohort_month", "left")
            .withColumn("retention_pct", ratio("users", "cohort_size") * 100))


def n5_cohort_matrix(p: DataFrame, u: DataFrame, *, max_index: int = 12) -> DataFrame:
    """Wide retention matrix: one row per signup month, columns m0..m{max_index} in %."""
    long = cohort_counts_all_statuses(p, u, max_index=max_index)
    wide = (long.groupBy("cohort_month")
            .pivot("month_index", list(range(max_index + 1)))
            .agg(F.first("retention_pct")))
    return wide.select("cohort_month", *[F.col(str(i)).alias(f"m{i}")
                                         for i in range(max_index + 1)]).orderBy("cohort_month")


def n5_cohort_head(p: DataFrame, u: DataFrame, *, cohorts: int = 5, months: int = 6,
                   digits: int = 1) -> DataFrame:
    """First ``cohorts`` cohorts x first ``months`` month columns, rounded."""
    from recurra.functions import pg_round
    m = n5_cohort_matrix(p, u)
    return m.orderBy("cohort_month").limit(cohorts).select(
        "cohort_month", *[pg_round(f"m{i}", digits).alias(f"m{i}") for i in range(months)])
