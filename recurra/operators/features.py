"""Customer feature engineering: tenure, usage/ticket/payment features, feature matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions import notebook_tenure_months, ratio
from recurra.session import freeze

REFERENCE_BASELINE = "2026-01-01"


def n3_tenure(s: DataFrame, *, baseline: str = REFERENCE_BASELINE) -> DataFrame:
    """Tenure in months (days / 30.4368, 1 decimal, at least 0.1) of every subscription."""
    return s.select("subscription_id", "start_date", "status",
                    notebook_tenure_months("start_date", "end_date", baseline).alias("tenure_months"))


def n3_usage_feat(pu: DataFrame) -> DataFrame:
    """Per user: distinct features, total events, total minutes, mean minutes per log row."""
    return pu.groupBy("user_id").agg(
        F.countDistinct("feature").alias("total_features_used"),
        F.sum("events").cast("long").alias("total_usage_events"),
        F.sum("active_minutes").cast("long").alias("total_active_minutes"),
        ratio(F.sum("active_minutes"), F.count("active_minutes")).alias("avg_active_minutes_per_event"))


def n3_ticket_feat(t: DataFrame) -> DataFrame:
    """Per user: tickets, mean first-response hours, mean resolution hours (NULLs skipped)."""
    return t.groupBy("user_id").agg(
        F.count("ticket_id").alias("total_support_tickets"),
        ratio(F.sum(F.col("first_response_hours").cast("decimal(38,2)")),
              F.count("first_response_hours")).alias("avg_first_response_hours"),
        ratio(F.sum(F.col("resolution_hours").cast("decimal(38,2)")),
              F.count("resolution_hours")).alias("avg_resolution_hours"))


def n3_payment_feat(p: DataFrame) -> DataFrame:
    """Per user: payment attempts, failed attempts, failure rate (0 when no attempts)."""
    g = p.groupBy("user_id").agg(
        F.count("payment_id").alias("total_payment_attempts"),
        F.sum(F.when(F.col("payment_status") == "Failed", 1).otherwise(0)).cast("long")
        .alias("failed_payment_attempts"))
    return g.withColumn("payment_failure_rate",
                        F.coalesce(ratio("failed_payment_attempts", "total_payment_attempts"),
                                   F.lit(0.0)))


def n3_feature_matrix(s: DataFrame, u: DataFrame, pu: DataFrame, t: DataFrame, p: DataFrame, *,
                      baseline: str = REFERENCE_BASELINE) -> DataFrame:
    """One row per subscription with user attributes and the per-user features.

    Every feature table is aggregated per user, and the aggregates are joined with each
    other (one row per user on every side) and stored. The subscriptions then meet them in
    a single join of two exchanges, the shape in which adaptive execution splits a hot user.
    Defaults for users without rows: counts 0, response 24.0 h, resolution 48.0 h.
    """
    base = s.select("user_id", "subscription_id", "plan_id",
                    F.col("monthly_price").cast("double").alias("monthly_price"), "status",
                    notebook_tenure_months("start_date", "end_date", baseline).alias("tenure_months"))
    m = _with_user_features(base, [
        u.select("user_id", "company_size", "region", "acquisition_channel"),
        n3_usage_feat(pu), n3_ticket_feat(t), n3_payment_feat(p)])
    m = m.fillna({"total_features_used": 0, "total_usage_events": 0, "total_active_minutes": 0,
                  "avg_active_minutes_per_event": 0.0, "total_support_tickets": 0,
                  "avg_first_response_hours": 24.0, "avg_resolution_hours": 48.0,
                  "total_payment_attempts": 0, "failed_payment_attempts": 0,
                  "payment_failure_rate": 0.0})
    return m.withColumn("is_churned", (F.col("status") == "Churned").cast("int"))


def _with_user_features(base: DataFrame, per_user: list[DataFrame]) -> DataFrame:
    """``base`` left-joined with tables of one row per user, in one join."""
    together = per_user[0]
    for features in per_user[1:]:
        together = together.join(features, "user_id", "full")
    return base.join(freeze(together.where(F.col("user_id").isNotNull())), "user_id", "left")


FEATURE_MATRIX_NUMERIC = (
    "user_id", "subscription_id", "plan_id", "monthly_price", "tenure_months",
    "total_features_used", "total_usage_events", "total_active_minutes",
    "avg_active_minutes_per_event", "total_support_tickets", "avg_first_response_hours",
    "avg_resolution_hours", "total_payment_attempts", "failed_payment_attempts",
    "payment_failure_rate", "is_churned")


def n5_model_matrix(s: DataFrame, pu: DataFrame, t: DataFrame) -> DataFrame:
    """Per subscription: price, total events, active minutes, tickets (NULL -> 0), label."""
    usage = pu.groupBy("user_id").agg(F.sum("events").cast("long").alias("total_events"),
                                      F.sum("active_minutes").cast("long").alias("active_minutes"))
    tickets = t.groupBy("user_id").agg(F.count("ticket_id").alias("total_tickets"))
    base = s.select("user_id", "subscription_id",
                    F.col("monthly_price").cast("double").alias("monthly_price"),
                    (F.col("status") == "Churned").cast("int").alias("is_churned"))
    # whole-frame fill, as in the notebook
    return _with_user_features(base, [usage, tickets]).fillna(0)
