"""Exact distinct counts that merge: id bitmaps per group and bucket.

``COUNT(DISTINCT user)`` per month cannot be added up to quarters, plans or totals, and cannot be
refreshed without reading everything again. A state of bitmaps can: a group's ids are split
into buckets of 32,768 neighbouring ids, and a bucket's ids are the bits of one 4 KB bitmap.
States of the same grouping merge by OR, and a coarser grouping is the OR over the columns that
are left out; a hot group is spread over its buckets. Ids are integers; NULL ids count nowhere,
as in SQL. Bitmaps pay off for dense ids (a bucket with a single id takes 4 KB too).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.functions import month_start


def distinct_state(df: DataFrame, by: Sequence[str | Column], id_col: str) -> DataFrame:
    """(by..., bucket, ids): the distinct ``id_col`` of every group as bitmaps."""
    return (df.where(F.col(id_col).isNotNull())
            .groupBy(*by, F.bitmap_bucket_number(F.col(id_col)).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(id_col))).alias("ids")))


def merge_state(state: DataFrame, by: Sequence[str]) -> DataFrame:
    """States (also of several inputs, with ``unionByName``) merged to the grouping ``by``,
    which may be coarser than the state's own."""
    return state.groupBy(*by, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))


def distinct_counts(state: DataFrame, by: Sequence[str], out: str = "n") -> DataFrame:
    """(by..., out): the distinct count of every group; one row of 0 for an empty state
    under the empty grouping."""
    merged = merge_state(state, by)
    return merged.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("ids")), F.lit(0)).alias(out))


def paying_state(p: DataFrame) -> DataFrame:
    """The state of paying customers per month and plan."""
    paid = p.where(F.col("payment_status") == "Paid")
    return distinct_state(paid, [month_start("payment_date").alias("month"), "plan_id"], "user_id")


def paying_rollup(state: DataFrame) -> DataFrame:
    """(month, plan_id, paying_customers) at every level: month and plan, month, plan, total
    (NULL stands for "all"). Each level is merged from the next finer one, never from payments."""
    by_month = merge_state(state, ["month"])
    by_plan = merge_state(state, ["plan_id"])
    month, plan = F.col("month"), F.col("plan_id")
    no_month, no_plan = F.lit(None).cast("date").alias("month"), F.lit(None).cast("int").alias("plan_id")
    n = "paying_customers"
    levels = [distinct_counts(state, ["month", "plan_id"], n).select(month, plan, n),
              distinct_counts(by_month, ["month"], n).select(month, no_plan, n),
              distinct_counts(by_plan, ["plan_id"], n).select(no_month, plan, n),
              distinct_counts(by_plan, [], n).select(no_month, no_plan, n)]
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out
