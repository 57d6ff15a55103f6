"""Support SLA operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions import month_start, pg_round, ratio


def _sla_aggs(sla_hours: float):
    hit = F.when(F.col("resolution_hours") <= sla_hours, 1).otherwise(0)
    return [F.count(F.lit(1)).alias("total_tickets"),
            F.sum(F.col("first_response_hours").cast("decimal(38,2)")).alias("fr_sum"),
            F.count("first_response_hours").alias("fr_n"),
            F.sum(F.col("resolution_hours").cast("decimal(38,2)")).alias("res_sum"),
            F.count("resolution_hours").alias("res_n"),
            F.sum(hit).alias("hits")]


def q17_sla(t: DataFrame, *, sla_hours: float = 24) -> DataFrame:
    """Priority x category: tickets, mean response/resolution hours, SLA hits and rate.

    NULL resolution counts in the denominator but never as a hit. Order is the
    reference's: priority descending as text, then mean resolution descending.
    """
    g = t.groupBy("priority", "category").agg(*_sla_aggs(sla_hours))
    return g.select(
        "priority", "category", "total_tickets",
        pg_round(ratio("fr_sum", "fr_n"), 2).alias("avg_first_response_hours"),
        pg_round(ratio("res_sum", "res_n"), 2).alias("avg_resolution_hours"),
        F.col("hits").cast("long").alias("resolved_within_24h"),
        pg_round(ratio(F.col("hits") * 100, F.col("total_tickets")), 2)
        .alias("sla_resolution_rate_percent"),
    ).orderBy(F.desc("priority"), F.desc_nulls_first("avg_resolution_hours"))


def q18_sla_trend(t: DataFrame, *, sla_hours: float = 24) -> DataFrame:
    """Ticket month: tickets, mean resolution hours, SLA rate %."""
    g = t.groupBy(month_start("created_date").alias("ticket_month")).agg(*_sla_aggs(sla_hours))
    return g.select(
        "ticket_month", "total_tickets",
        pg_round(ratio("res_sum", "res_n"), 2).alias("avg_resolution_hours"),
        pg_round(ratio(F.col("hits") * 100, F.col("total_tickets")), 2)
        .alias("sla_resolution_rate_percent"),
    ).orderBy("ticket_month")
