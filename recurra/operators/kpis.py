"""KPI tables: monthly active snapshot, paid KPIs by month/plan, usage KPIs, billing schedule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recurra.functions import month_start, pg_round, tenure_days, to_money

REFERENCE_AS_OF = "2026-01-01"


def calendar_months(bounds: DataFrame, lo: str = "lo", hi: str = "hi", out: str = "month") -> DataFrame:
    """Explode a one-row frame of (lo, hi) month dates into one row per month."""
    return bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi), F.expr("interval 1 month")))
                         .alias(out))


def kpi_monthly_snapshot(s: DataFrame, *, from_month: str | None = None,
                         to_month: str | None = None) -> DataFrame:
    """Per month: active logos, MRR and ARR of subscriptions active in that month, from the
    first start month to ``to_month`` (a caller's as-of month; by default the last start month).

    Active in month m <=> start month <= m and (not Churned or end month >= m);
    a churned row without end_date fails the second test (SQL NULL logic).
    Computed as +1/-1 events per subscription aggregated by month and a running
    sum over the (small) month axis -- no range join of months x subscriptions.
    """
    start_m = month_start("start_date")
    end_m = month_start("end_date")
    churned = F.col("status") == "Churned"
    ever = ~churned | (end_m >= start_m)            # NULL (churned, no end) drops out
    live = s.where(ever).select(
        start_m.alias("start_m"),
        F.when(churned, F.add_months(end_m, 1)).alias("stop_m"),
        to_money("monthly_price").alias("price"))
    events = live.select(F.col("start_m").alias("month"), F.lit(1).alias("d_n"),
                         F.col("price").alias("d_mrr")).unionByName(
        live.where(F.col("stop_m").isNotNull())
        .select(F.col("stop_m").alias("month"), F.lit(-1).alias("d_n"),
                (-F.col("price")).alias("d_mrr")))
    deltas = events.groupBy("month").agg(F.sum("d_n").alias("d_n"), F.sum("d_mrr").alias("d_mrr"))
    bounds = s.agg(F.min(start_m).alias("lo"), F.max(start_m).alias("hi"))
    if from_month:
        bounds = bounds.withColumn("lo", F.lit(from_month).cast("date"))
    if to_month:
        bounds = bounds.withColumn("hi", F.lit(to_month).cast("date"))
    spine = calendar_months(bounds)
    axis = (deltas.unionByName(spine.select("month", F.lit(0).alias("d_n"),
                                             F.lit(0).cast("decimal(38,2)").alias("d_mrr")))
            .groupBy("month").agg(F.sum("d_n").alias("d_n"), F.sum("d_mrr").alias("d_mrr")))
    run = W.orderBy("month").rowsBetween(W.unboundedPreceding, 0)   # one row per month
    cum = axis.select("month", F.sum("d_n").over(run).alias("n"),
                      F.sum("d_mrr").over(run).alias("mrr"))
    return (cum.join(spine, "month")
            .select("month", F.col("n").cast("long").alias("active_logos"),
                    pg_round("mrr", 2).alias("mrr"),
                    pg_round(F.col("mrr") * 12, 2).alias("arr"))
            .orderBy("month"))


def kpi_monthly_paid(p: DataFrame) -> DataFrame:
    """Month: Paid revenue, distinct paying customers, Paid payments, ARR = 12 x MRR."""
    paid = p.where(F.col("payment_status") == "Paid")
    return (paid.groupBy(month_start("payment_date").alias("month"))
            .agg(F.sum(to_money("amount")).alias("m"),
                 F.countDistinct("user_id").alias("paying_customers"),
                 F.count(F.lit(1)).alias("payments"))
            .select("month", pg_round("m", 2).alias("mrr"), "paying_customers", "payments",
                    pg_round(F.col("m") * 12, 2).alias("arr"))
            .orderBy("month"))


def kpi_plan(p: DataFrame, pl: DataFrame) -> DataFrame:
    """Plan: Paid revenue, distinct customers, Paid payments (plan names are unique)."""
    per_plan = (p.where(F.col("payment_status") == "Paid").groupBy("plan_id")
                .agg(F.sum(to_money("amount")).alias("m"),
                     F.countDistinct("user_id").alias("customers"),
                     F.count(F.lit(1)).alias("payments")))
    return (per_plan.join(pl.select("plan_id", "plan_name"), "plan_id")
            .select("plan_name", pg_round("m", 2).alias("mrr"), "customers", "payments")
            .orderBy(F.desc_nulls_first("mrr")))


def kpi_usage(pu: DataFrame) -> DataFrame:
    """Feature: total events, distinct users, total active minutes."""
    return (pu.groupBy("feature")
            .agg(F.sum("events").cast("long").alias("events"),
                 F.countDistinct("user_id").alias("users"),
                 F.sum("active_minutes").cast("long").alias("active_minutes"))
            .orderBy(F.desc_nulls_first("events")))


def _months_active(as_of: str):
    days = tenure_days("status", "start_date", "end_date", as_of)
    return F.greatest(F.lit(1), F.floor(days / 30).cast("int"))


def gen_months_active(s: DataFrame, *, as_of: str = REFERENCE_AS_OF) -> DataFrame:
    """Whole 30-day months each subscription has been billed: at least 1, counted to
    its end date when churned with one, else to ``as_of``."""
    return s.select("subscription_id", _months_active(as_of).alias("months_active"))


def gen_billing_schedule(s: DataFrame, *, as_of: str = REFERENCE_AS_OF, step: int = 30) -> DataFrame:
    """One row per billing date: start + k*step days for k < months_active (map-only)."""
    seq = F.explode(F.sequence(F.lit(0), _months_active(as_of) - 1)).alias("billing_seq")
    return (s.select("subscription_id", "user_id", "plan_id", "start_date",
                     F.col("monthly_price").cast("double").alias("amount"), seq)
            .select("subscription_id", "user_id", "plan_id", "billing_seq",
                    F.date_add("start_date", F.col("billing_seq") * step).alias("billing_date"),
                    "amount"))
