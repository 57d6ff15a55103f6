"""Joins of intervals that overlap, without a range join.

Of two closed intervals that share a day, one contains the day on which the later of them begins.
So the join is one of beginnings with intervals, in both directions: intervals are cut into bins
of months, beginnings fall into one bin of each width, and both are joined on (key, bin), an
equi-join that Spark shuffles, spills and splits at skewed keys as any other. A short interval
takes narrow bins, a long one wide bins, so an interval adds a few rows however long it runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.functions import subscription_end

#: Widths of the bins in months. An interval takes the first width of which it touches few bins.
BIN_MONTHS = (1, 6, 36)
_FEW = 6


def _month(day: str) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def _bin(day: str, months: int) -> Column:
    return F.floor(_month(day) / months).cast("int")


def _proper(df: DataFrame, on: tuple[str, str]) -> DataFrame:
    return df.where(F.col(on[0]) <= F.col(on[1]))             # empty intervals and NULL borders overlap nothing


def _spans(df: DataFrame, on: tuple[str, str]) -> DataFrame:
    """One row per bin that a row's interval touches, in bins of the width that fits it."""
    start, end = on
    bins = None
    for w in reversed(BIN_MONTHS):
        first, last = _bin(start, w), _bin(end, w)
        here = F.struct(F.lit(w).alias("_width"), first.alias("_first"), last.alias("_last"))
        bins = here if bins is None else F.when(last - first < _FEW, here).otherwise(bins)
    return (df.withColumn("_at", bins).withColumn("_bin", F.explode(F.sequence("_at._first", "_at._last")))
            .withColumn("_width", F.col("_at._width")).drop("_at"))


def _beginnings(df: DataFrame, start: str) -> DataFrame:
    """One row per bin width, with the bin in which a row's interval begins."""
    bins = F.array(*[F.struct(F.lit(w).alias("_width"), _bin(start, w).alias("_bin")) for w in BIN_MONTHS])
    return df.withColumn("_at", F.explode(bins)).select("*", "_at.*").drop("_at")


def overlap_join(left: DataFrame, right: DataFrame, key: str, left_on: tuple[str, str],
                 right_on: tuple[str, str]) -> DataFrame:
    """Inner join of the rows with equal ``key`` whose closed intervals share a day.

    ``left_on`` and ``right_on`` name the first and the last date of an interval (the same
    column twice for a point). Column names other than ``key`` must differ between the sides. A
    row whose interval ends before it starts, or has a NULL border or key, joins nothing.

    A pair comes out once, where the later interval begins (the left one, if both begin on one
    day). Both sides are shuffled: Spark's size estimates do not see that a row becomes several,
    so a side that it takes for small enough to broadcast may not fit into the driver.
    """
    shared = (set(left.columns) & set(right.columns)) - {key}
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    a, b = _proper(left, left_on), _proper(right, right_on)
    (a_from, a_to), (b_from, b_to) = [[F.col(c) for c in on] for on in (left_on, right_on)]
    by = [key, "_width", "_bin"]
    joined = (_beginnings(a, left_on[0]).join(_spans(b, right_on).hint("merge"), by)
              .where((b_from <= a_from) & (a_from <= b_to)))
    if left_on[0] != left_on[1]:                              # nothing begins inside a point and after it
        b_begins = (_spans(a, left_on).join(_beginnings(b, right_on[0]).hint("merge"), by)
                    .where((a_from < b_from) & (b_from <= a_to)))
        joined = joined.unionByName(b_begins)
    return joined.drop("_width", "_bin")


def subscription_intervals(s: DataFrame, as_of: str, *extra: Column | str) -> DataFrame:
    """(subscription_id, user_id, from_date, to_date, ...): a churned subscription ends on its
    end date, any other runs to ``as_of``."""
    return s.select("subscription_id", "user_id", F.col("start_date").alias("from_date"),
                    subscription_end("status", "start_date", "end_date", as_of).alias("to_date"), *extra)


def activity_within(s: DataFrame, pu: DataFrame, t: DataFrame, *, as_of: str) -> DataFrame:
    """(subscription_id, usage_days, active_minutes, tickets): what a subscription's user did while
    it ran. Usage is reduced to one row per user and day, tickets likewise, before the join."""
    runs = subscription_intervals(s, as_of)
    usage = (pu.groupBy(F.col("user_id"), F.col("event_date").alias("day"))
             .agg(F.sum("active_minutes").alias("minutes"))
             .withColumn("tickets", F.lit(0).cast("long")))
    ticket = (t.groupBy(F.col("user_id"), F.to_date("created_date").alias("day"))
              .agg(F.count(F.lit(1)).alias("tickets")).withColumn("minutes", F.lit(None).cast("long")))
    days = usage.unionByName(ticket)
    hit = overlap_join(runs, days, "user_id", ("from_date", "to_date"), ("day", "day"))
    return hit.groupBy("subscription_id").agg(
        F.count("minutes").alias("usage_days"), F.coalesce(F.sum("minutes"), F.lit(0)).cast("long").alias("active_minutes"),
        F.sum("tickets").cast("long").alias("tickets"))


def plan_overlaps(s: DataFrame, pl: DataFrame, *, as_of: str) -> DataFrame:
    """(plan_a, plan_b, pairs, overlap_days): subscriptions of one user that ran at the same
    time, by their plans (each pair once, the smaller subscription id first)."""
    a = subscription_intervals(s, as_of, "plan_id").select(
        "user_id", *[F.col(c).alias(f"a_{c}") for c in ("subscription_id", "from_date", "to_date", "plan_id")])
    b = subscription_intervals(s, as_of, "plan_id").select(
        "user_id", *[F.col(c).alias(f"b_{c}") for c in ("subscription_id", "from_date", "to_date", "plan_id")])
    both = overlap_join(a, b, "user_id", ("a_from_date", "a_to_date"), ("b_from_date", "b_to_date"))
    days = F.datediff(F.least("a_to_date", "b_to_date"), F.greatest("a_from_date", "b_from_date")) + 1
    per = (both.where(F.col("a_subscription_id") < F.col("b_subscription_id"))
           .groupBy("a_plan_id", "b_plan_id").agg(F.count(F.lit(1)).alias("pairs"), F.sum(days).alias("overlap_days")))
    name = pl.select("plan_id", "plan_name")
    return (per.join(name.select(F.col("plan_id").alias("a_plan_id"), F.col("plan_name").alias("plan_a")), "a_plan_id")
            .join(name.select(F.col("plan_id").alias("b_plan_id"), F.col("plan_name").alias("plan_b")), "b_plan_id")
            .select("plan_a", "plan_b", "pairs", F.col("overlap_days").cast("long").alias("overlap_days")))
