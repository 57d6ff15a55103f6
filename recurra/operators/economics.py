"""Unit economics: LTV vs CAC, spend deciles, tier metrics, price outliers, lifespans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from recurra.functions import pg_round, ratio, tenure_days, to_money
from recurra.operators.ranking import exact_ntile

REFERENCE_AS_OF = "2026-01-01"


def _days(as_of: str):
    return tenure_days("status", "start_date", "end_date", as_of)


def _per_key_sums(s: DataFrame, key: str, as_of: str | None = None) -> DataFrame:
    """Pre-aggregate subscriptions by ``key`` (map-side combined) before any join."""
    aggs = [F.count(F.lit(1)).alias("n"),
            F.count("user_id").alias("user_n"),
            F.sum(to_money("monthly_price")).alias("price_sum"),
            F.count("monthly_price").alias("price_n")]
    if as_of is not None:
        aggs.append(F.sum(_days(as_of)).alias("days_sum"))
    return s.groupBy(key).agg(*aggs)


def _resum(df: DataFrame, key: str, with_days: bool) -> DataFrame:
    cols = [F.sum("n").alias("n"), F.sum("user_n").alias("user_n"),
            F.sum("price_sum").alias("price_sum"),
            F.sum("price_n").alias("price_n")]
    if with_days:
        cols.append(F.sum("days_sum").alias("days_sum"))
    return df.groupBy(key).agg(*cols)


def _avg_price():
    return ratio("price_sum", "price_n")


def _avg_tenure_months():
    return ratio(F.col("days_sum"), F.col("n") * 30)


def q05_ltv_cac(m: DataFrame, u: DataFrame, s: DataFrame, *,
                as_of: str = REFERENCE_AS_OF) -> DataFrame:
    """Channel: CAC = spend / conversions, LTV = rounded avg price x rounded avg tenure."""
    cac = (m.groupBy("channel")
           .agg(F.sum(to_money("spend")).alias("spend"),
                F.sum("paid_conversions").alias("conv"))
           .select("channel",
                   F.round(ratio("spend", "conv").cast(DecimalType(38, 6)), 2)
                   .cast(DecimalType(18, 2)).alias("cac")))
    per_user = _per_key_sums(s, "user_id", as_of)
    ltv = (_resum(per_user.join(u.select("user_id", "acquisition_channel"), "user_id"),
                  "acquisition_channel", True)
           .select("acquisition_channel",
                   F.round(_avg_price().cast(DecimalType(38, 6)), 2)
                   .cast(DecimalType(18, 2)).alias("spend_avg"),
                   F.round(_avg_tenure_months().cast(DecimalType(38, 6)), 1)
                   .cast(DecimalType(18, 1)).alias("tenure_avg")))
    value = F.col("spend_avg") * F.col("tenure_avg")        # exact decimal product
    return (cac.join(ltv, F.lower(cac.channel) == F.lower(ltv.acquisition_channel))
            .select(F.col("channel").alias("acquisition_channel"),
                    F.col("cac").cast("double").alias("average_cac"),
                    pg_round(value, 2, 6).alias("estimated_customer_ltv"),
                    pg_round(ratio(value, F.col("cac")), 2, 6).alias("ltv_to_cac_ratio"))
            .orderBy(F.desc_nulls_first("ltv_to_cac_ratio")))


def user_lifetime_spend(s: DataFrame, as_of: str = REFERENCE_AS_OF) -> DataFrame:
    """user_id -> sum of price x whole 30-day months (rounded up) of each subscription."""
    months = F.ceil(_days(as_of).cast("double") / F.lit(30.0))
    return s.groupBy("user_id").agg(
        F.sum(to_money("monthly_price") * months).cast(DecimalType(38, 2)).alias("ltv"))


def q06_ltv_deciles(s: DataFrame, *, as_of: str = REFERENCE_AS_OF, n: int = 10) -> DataFrame:
    """Spend deciles (NTILE over all users by lifetime spend, desc; ties by user_id)."""
    per_user = user_lifetime_spend(s, as_of)
    tiles = exact_ntile(per_user, n, [F.desc_nulls_first("ltv"), F.asc("user_id")], out="spend_decile")
    by_tile = tiles.groupBy("spend_decile").agg(
        F.count("user_id").alias("subscriber_count"),
        F.sum("ltv").alias("rev"), F.count("ltv").alias("rev_n"))
    total = F.sum("rev").over(W.partitionBy(F.lit(1)))     # over <= n rows
    return by_tile.select(
        "spend_decile", "subscriber_count",
        pg_round("rev", 2).alias("decile_combined_revenue"),
        pg_round(ratio(F.col("rev") * 100, total), 2).alias("revenue_contribution_percent"),
        pg_round(ratio("rev", "rev_n"), 2).alias("average_ltv_in_decile"),
    ).orderBy("spend_decile")


def q08_tier_metrics(s: DataFrame, pl: DataFrame, *, as_of: str = REFERENCE_AS_OF) -> DataFrame:
    """Plan tier (Active only): subscriptions, revenue, ARPU, mean tenure in 30-day months."""
    per_plan = _per_key_sums(s.where(F.col("status") == "Active"), "plan_id", as_of)
    tiers = _resum(per_plan.join(pl.select("plan_id", "plan_name"), "plan_id"), "plan_name", True)
    return tiers.select(
        F.col("plan_name").alias("subscription_tier"),
        F.col("user_n").cast("long").alias("active_subscribers"),
        pg_round("price_sum", 2).alias("tier_monthly_revenue"),
        pg_round(_avg_price(), 2).alias("tier_arpu"),
        pg_round(_avg_tenure_months(), 1).alias("average_tenure_months"),
    ).orderBy(F.desc_nulls_first("tier_monthly_revenue"))


def q12_outliers(s: DataFrame, pl: DataFrame, *, z: float = 2.0) -> DataFrame:
    """Active subscriptions whose price z-score exceeds ``z`` (sample standard deviation)."""
    active = s.where(F.col("status") == "Active")
    # one-row aggregate used as an uncorrelated scalar subquery (no join at all)
    stats = active.agg(F.struct(
        ratio(F.sum(to_money("monthly_price")), F.count("monthly_price")).alias("mu"),
        F.stddev_samp(F.col("monthly_price").cast("double")).alias("sd"))).scalar()
    score = ratio(F.col("monthly_price").cast("double") - stats["mu"], stats["sd"])
    return (active.where(score > z)
            .join(pl.select("plan_id", "plan_name"), "plan_id")
            .select("subscription_id", "user_id",
                    F.col("plan_name").alias("subscription_tier"),
                    pg_round("monthly_price", 2).alias("monthly_price"),
                    pg_round(stats["mu"], 2).alias("average_price_benchmark"),
                    pg_round(score, 2).alias("price_z_score"))
            .orderBy(F.desc_nulls_first("monthly_price")))


def q15_segment_ltv(s: DataFrame, pl: DataFrame, *, as_of: str = REFERENCE_AS_OF) -> DataFrame:
    """Target segment: subscriptions, mean price, mean lifespan, their product (LTV)."""
    per_plan = _per_key_sums(s, "plan_id", as_of)
    seg = _resum(per_plan.join(pl.select("plan_id", "target_segment"), "plan_id"),
                 "target_segment", True)
    return seg.select(
        "target_segment",
        F.col("n").cast("long").alias("subscription_sample"),
        pg_round(_avg_price(), 2, 6).alias("average_monthly_spend"),
        pg_round(_avg_tenure_months(), 1).alias("average_lifespan_months"),
        pg_round(_avg_price() * _avg_tenure_months(), 2, 6).alias("calculated_ltv"),
    ).orderBy(F.desc_nulls_first("calculated_ltv"))


def q20_size_tenure(s: DataFrame, u: DataFrame, *, as_of: str = REFERENCE_AS_OF) -> DataFrame:
    """Company size: subscriptions, mean tenure (30-day months), mean price."""
    per_user = _per_key_sums(s, "user_id", as_of)
    size = _resum(per_user.join(u.select("user_id", "company_size"), "user_id"),
                  "company_size", True)
    return size.select(
        "company_size",
        F.col("n").cast("long").alias("subscription_sample"),
        pg_round(_avg_tenure_months(), 1).alias("average_tenure_months"),
        pg_round(_avg_price(), 2).alias("average_monthly_price"),
    ).orderBy(F.desc_nulls_first("average_tenure_months"))


def q22_region_matrix(s: DataFrame, u: DataFrame) -> DataFrame:
    """Region: active subscriptions, active MRR, ARPU, churned subscriptions."""
    active = F.col("status") == "Active"
    per_user = s.groupBy("user_id").agg(
        F.count(F.when(active, 1)).alias("n_active"),
        F.sum(F.when(active, to_money("monthly_price"))).alias("mrr"),
        F.count(F.when(active, F.col("monthly_price"))).alias("mrr_n"),
        F.count(F.when(F.col("status") == "Churned", 1)).alias("n_churned"))
    region = (per_user.join(u.select("user_id", "region"), "user_id")
              .groupBy("region")
              .agg(F.sum("n_active").alias("a"), F.sum("mrr").alias("mrr"),
                   F.sum("mrr_n").alias("mrr_n"), F.sum("n_churned").alias("c")))
    return region.select(
        "region",
        F.col("a").cast("long").alias("active_subscribers"),
        pg_round(F.coalesce("mrr", F.lit(0)), 2).alias("total_active_mrr"),
        pg_round(ratio("mrr", "mrr_n"), 2).alias("arpu"),
        F.col("c").cast("long").alias("cumulative_churn_loss"),
    ).orderBy(F.desc_nulls_first("total_active_mrr"))
