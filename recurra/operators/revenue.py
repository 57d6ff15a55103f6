"""Revenue operators: scorecard, MRR trends, expansion, NRR, rolling inflow, ARR by region."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recurra.functions import month_start, pg_round, ratio, to_money
from recurra.operators.sequence import lag_within
from recurra.sources.colocated import Colocated

ACTIVE, CHURNED, PAID = "Active", "Churned", "Paid"


def q01_scorecard(s: DataFrame) -> DataFrame:
    """Subscribers, active MRR, ARR, ARPU (mean active price), churned count."""
    active = F.col("status") == ACTIVE
    active_price = F.when(active, to_money("monthly_price"))
    mrr = F.coalesce(F.sum(active_price), F.lit(0).cast("decimal(38,2)"))
    return s.agg(
        F.countDistinct("user_id").alias("total_registered_subscribers"),
        pg_round(mrr, 2).alias("active_mrr"),
        pg_round(mrr * 12, 2).alias("annual_recurring_revenue_arr"),
        pg_round(ratio(F.sum(active_price), F.count(active_price)), 2).alias("arpu"),
        F.sum(F.when(F.col("status") == CHURNED, 1).otherwise(0)).cast("long")
        .alias("total_churned_subscribers"),
    )


def paid_by_month(p: DataFrame, month_col: str = "record_month") -> DataFrame:
    """Month -> net paid amount (0 for months with only failed attempts)."""
    paid = F.when(F.col("payment_status") == PAID, to_money("amount")).otherwise(F.lit(0))
    return (p.groupBy(month_start("payment_date").alias(month_col))
            .agg(F.sum(paid).cast("decimal(38,2)").alias("net")))


def _with_mom(monthly: DataFrame, month_col: str) -> DataFrame:
    # A global window, but over one row per month (already aggregated): tiny.
    prev = F.lag("net").over(W.orderBy(month_col))
    return monthly.select(
        month_col,
        pg_round("net", 2).alias("net_monthly_mrr"),
        pg_round(F.col("net") - prev, 2).alias("mom_variance"),
        pg_round(ratio(F.col("net") - prev, prev) * 100, 2).alias("mom_growth_percent"),
    )


def q02_mrr_mom(p: DataFrame) -> DataFrame:
    """Paid revenue per month with month-over-month variance and growth %."""
    return _with_mom(paid_by_month(p), "record_month").orderBy("record_month")


def q04_expansion(p: DataFrame, skew_safe: bool = True) -> DataFrame:
    """Expansion / contraction / net from each subscription's previous Paid amount."""
    paid = p.where(F.col("payment_status") == PAID).select(
        "subscription_id", "payment_date", "payment_id", to_money("amount").alias("amount"))
    seq = lag_within(paid, "subscription_id", ["payment_date", "amount", "payment_id"],
                     "amount", out="prev_amount", skew_safe=skew_safe)
    a, b = F.col("amount"), F.col("prev_amount")
    up = F.sum(F.when(a > b, a - b).otherwise(F.lit(0)))
    down = F.sum(F.when(a < b, b - a).otherwise(F.lit(0)))
    return (seq.where(b.isNotNull())
            .groupBy(month_start("payment_date").alias("payment_month"))
            .agg(up.alias("up"), down.alias("down"))
            .select("payment_month",
                    pg_round("up", 2).alias("expansion_mrr"),
                    pg_round("down", 2).alias("contraction_mrr"),
                    pg_round(F.col("up") - F.col("down"), 2).alias("net_expansion_mrr"))
            .orderBy("payment_month"))


def monthly_subscription_revenue(p: DataFrame) -> DataFrame:
    """(month, subscription) -> Paid total; one row per pair, so bounded per key."""
    return (p.where(F.col("payment_status") == PAID)
            .groupBy(month_start("payment_date").alias("payment_month"), "subscription_id")
            .agg(F.sum(to_money("amount")).alias("total_paid")))


def q10_nrr(p: DataFrame) -> DataFrame:
    """Monthly NRR over subscriptions paying this month vs the same ones last month."""
    msr = monthly_subscription_revenue(p)
    prev = msr.select(
        "subscription_id",
        F.add_months("payment_month", 1).alias("payment_month"),
        F.col("total_paid").alias("previous_mrr"))
    moves = msr.join(prev, ["subscription_id", "payment_month"], "left")
    return _retention(moves.groupBy("payment_month")
                      .agg(F.sum("previous_mrr").alias("start"), F.sum("total_paid").alias("end")))


def q10_nrr_colocated(payments: Colocated) -> DataFrame:
    """``q10_nrr`` over payments stored in buckets by subscription, each part by itself: the
    monthly totals and the month before (by LAG over a subscription's months) come from the
    buckets without a shuffle; only totals per month are shuffled. Subscriptions with very many
    payments, stored apart, are combined before they are shuffled."""
    totals = None
    for part in (payments.bucketed, payments.hot):
        months = W.partitionBy("subscription_id").orderBy("payment_month")      # a row per month
        follows = (F.col("subscription_id").isNotNull()
                   & (F.lag("payment_month").over(months) == F.add_months("payment_month", -1)))
        moves = monthly_subscription_revenue(part).withColumn(
            "previous_mrr", F.when(follows, F.lag("total_paid").over(months)))
        one = moves.groupBy("payment_month").agg(F.sum("previous_mrr").alias("start"),
                                                 F.sum("total_paid").alias("end"))
        totals = one if totals is None else totals.unionByName(one)
    return _retention(totals.groupBy("payment_month").agg(F.sum("start").alias("start"), F.sum("end").alias("end")))


def _retention(months: DataFrame) -> DataFrame:
    start = F.coalesce(F.col("start"), F.lit(0))
    return (months.select("payment_month",
                          pg_round(start, 2).alias("starting_mrr"),
                          pg_round("end", 2).alias("ending_mrr"),
                          pg_round(ratio(F.col("end") * 100, start), 2).alias("net_revenue_retention_percent"))
            .orderBy("payment_month"))


def q11_rolling7(p: DataFrame, rows: int = 7) -> DataFrame:
    """Paid inflow per sales day and its mean over the last ``rows`` sales days."""
    daily = (p.where(F.col("payment_status") == PAID)
             .groupBy(F.to_date("payment_date").alias("sale_day"))
             .agg(F.sum(to_money("amount")).alias("inflow")))
    w = W.orderBy("sale_day").rowsBetween(-(rows - 1), 0)   # one row per day: tiny
    return daily.select(
        "sale_day",
        pg_round("inflow", 2).alias("daily_inflow"),
        pg_round(ratio(F.sum("inflow").over(w), F.count("inflow").over(w)), 2)
        .alias("rolling_7day_average_inflow"),
    ).orderBy("sale_day")


def q19_arr_forecast(s: DataFrame, u: DataFrame, growth: float | str = "1.15") -> DataFrame:
    """Active subscriptions per region: MRR, ARR and ARR grown by ``growth``."""
    per_user = (s.where(F.col("status") == ACTIVE).groupBy("user_id")
                .agg(F.count("subscription_id").alias("n"),
                     F.sum(to_money("monthly_price")).alias("mrr")))
    g = F.lit(Decimal(str(growth)))
    return (per_user.join(u.select("user_id", "region"), "user_id")
            .groupBy("region").agg(F.sum("n").alias("n"), F.sum("mrr").alias("mrr"))
            .select("region",
                    F.col("n").cast("long").alias("active_subscriptions"),
                    pg_round("mrr", 2).alias("current_mrr"),
                    pg_round(F.col("mrr") * 12, 2).alias("current_arr"),
                    pg_round(F.col("mrr") * 12 * g, 2)
                    .alias("projected_1year_arr_with_15percent_growth"))
            .orderBy(F.desc_nulls_first("current_arr")))


def k1_monthly_records(p: DataFrame) -> DataFrame:
    """Month: payment records and total amount (all statuses)."""
    return (p.groupBy(month_start("payment_date").alias("month"))
            .agg(F.count(F.lit(1)).alias("records"),
                 F.sum(to_money("amount")).cast("double").alias("total_value"))
            .orderBy("month"))


def k3_mom_growth(p: DataFrame) -> DataFrame:
    """Month value (all statuses), absolute change and growth ratio value/prev - 1."""
    monthly = (p.groupBy(month_start("payment_date").alias("month"))
               .agg(F.sum(to_money("amount")).alias("v")))
    prev = F.lag("v").over(W.orderBy("month"))
    return monthly.select(
        "month",
        F.col("v").cast("double").alias("value"),
        (F.col("v") - prev).cast("double").alias("absolute_change"),
        (ratio("v", prev) - 1).alias("growth_rate"),
    ).orderBy("month")
