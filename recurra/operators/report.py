"""Executive report blocks: scorecard, SLA summary, plan table, last months, display strings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from recurra.functions import pg_round, ratio
from recurra.operators import revenue


def py_round(c, digits: int):
    """Python-style round(x, n) of a ratio: half-even on the decimal value."""
    return F.bround(c.cast(DecimalType(38, 12)), digits).cast("double")


def r1_scorecard(s: DataFrame) -> DataFrame:
    """Scorecard plus churn_pct = churned / (subscribers + churned) x 100 (1 decimal).

    The denominator adds churned subscriptions to distinct subscribers, as the
    report does; kept as written.
    """
    sc = revenue.q01_scorecard(s)
    t, c = F.col("total_registered_subscribers"), F.col("total_churned_subscribers")
    return sc.select(
        t.alias("total_subscribers"), "active_mrr",
        F.col("annual_recurring_revenue_arr").alias("arr"), "arpu",
        c.alias("total_churned"),
        py_round(ratio(c, t + c) * 100, 1).alias("churn_pct"))


def r2_sla_overall(t: DataFrame, *, sla_hours: float = 24) -> DataFrame:
    """Overall mean first response, mean resolution and SLA compliance %, 1 decimal."""
    hit = F.sum(F.when(F.col("resolution_hours") <= sla_hours, 1).otherwise(0))
    g = t.agg(F.sum(F.col("first_response_hours").cast("decimal(38,2)")).alias("fr"),
              F.count("first_response_hours").alias("fr_n"),
              F.sum(F.col("resolution_hours").cast("decimal(38,2)")).alias("res"),
              F.count("resolution_hours").alias("res_n"),
              hit.alias("hits"), F.count(F.lit(1)).alias("n"))
    return g.select(pg_round(ratio("fr", "fr_n"), 1).alias("avg_first_response"),
                    pg_round(ratio("res", "res_n"), 1).alias("avg_resolution"),
                    pg_round(ratio(F.col("hits") * 100, F.col("n")), 1).alias("sla_compliance"))


def r3_plan_table(s: DataFrame, pl: DataFrame) -> DataFrame:
    """Plan: active logos, MRR, ARPU (Active subscriptions), MRR descending."""
    per_plan = (s.where(F.col("status") == "Active").groupBy("plan_id")
                .agg(F.count("user_id").alias("logos"),
                     F.sum(F.col("monthly_price").cast("decimal(38,2)")).alias("m"),
                     F.count("monthly_price").alias("m_n")))
    by_name = (per_plan.join(pl.select("plan_id", "plan_name"), "plan_id")
               .groupBy("plan_name")
               .agg(F.sum("logos").alias("logos"), F.sum("m").alias("m"), F.sum("m_n").alias("m_n")))
    return by_name.select(F.col("plan_name").alias("plan"),
                          F.col("logos").cast("long").alias("active_logos"),
                          pg_round("m", 2).alias("mrr"),
                          pg_round(ratio("m", "m_n"), 2).alias("arpu")).orderBy(F.desc_nulls_first("mrr"))


def r4_last_months(p: DataFrame, *, n: int = 6) -> DataFrame:
    """Latest ``n`` months of paid MRR; variance/growth use the month before even
    when it falls outside the shown months (LAG before LIMIT)."""
    full = revenue.q02_mrr_mom(p)
    return full.select(F.col("record_month").alias("month"),
                       F.col("net_monthly_mrr").alias("mrr"), "mom_variance",
                       "mom_growth_percent").orderBy(F.desc("month")).limit(n)


def _money(c):
    return F.concat(F.lit("$"), F.format_number(c, 2))


def r5_format_plans(plans: DataFrame) -> DataFrame:
    """Display strings for the plan table."""
    return plans.select("plan",
                        F.format_number("active_logos", 0).alias("active_logos_text"),
                        _money(F.col("mrr")).alias("mrr_text"),
                        _money(F.col("arpu")).alias("arpu_text"))


def r5_format_months(months: DataFrame) -> DataFrame:
    """Display strings for the monthly block: '+' sign and 'up' flag when the
    variance is >= 0, '0.0%' when growth is unknown; a missing variance shows as
    '$nan' with a 'down' flag, as the report renders it."""
    up = F.coalesce(F.col("mom_variance") >= 0, F.lit(False))
    sign = F.when(up, F.lit("+")).otherwise(F.lit(""))
    variance = F.when(F.col("mom_variance").isNull(), F.lit("$nan")) \
        .otherwise(_money(F.col("mom_variance")))
    pct = F.when(F.col("mom_growth_percent").isNull(), F.lit("0.0%")) \
        .otherwise(F.concat(sign, F.col("mom_growth_percent").cast("string"), F.lit("%")))
    return months.select(F.col("month").cast("string").alias("month"),
                         _money(F.col("mrr")).alias("mrr_text"),
                         F.concat(sign, variance).alias("variance_text"),
                         pct.alias("growth_text"),
                         F.when(up, F.lit("up")).otherwise(F.lit("down")).alias("trend"))


def report_blocks(s: DataFrame, t: DataFrame, pl: DataFrame, p: DataFrame) -> dict[str, DataFrame]:
    return {"scorecard": r1_scorecard(s), "sla": r2_sla_overall(t),
            "plans": r3_plan_table(s, pl), "last_months": r4_last_months(p)}
