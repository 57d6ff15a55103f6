"""Order-dependent operators that stay distributed.

A global window (``ntile``/``row_number`` over the whole table) runs in one
task. These helpers compute the same numbers with a range-partitioned sort:
rows are split into ordered ranges across all tasks (hot keys included, as the
order is total), each range is numbered locally, and a tiny per-partition
offset table (one row per partition -> a proven size bound) is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recurra.session import freeze

_POS_MASK = (1 << 33) - 1  # monotonically_increasing_id keeps the in-partition row position in the low 33 bits


def global_row_number(df: DataFrame, order: list[Column], num_partitions: int | None = None,
                      out: str = "_rank") -> DataFrame:
    """1-based position of every row in the total order ``order`` (must be a total order)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK))))
    # The partition ids/positions are read twice (counts and rows). Two planned
    # range exchanges could sample different bounds, so freeze them once in the
    # shared checkpoint dir (also cuts lineage for executor-loss recovery).
    ranged = freeze(ranged)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    before = W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(W.partitionBy(F.lit(1))).alias("_total"),
    )
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_off") + F.col("_pos") + 1)
            .drop("_pid", "_pos", "_off"))


def ntile_of_rank(rank: Column, total: Column, buckets: int) -> Column:
    """SQL NTILE(buckets) from a 1-based rank and the row count: the first
    ``total % buckets`` tiles hold one row more than the others."""
    q = F.floor(total / buckets)
    r = total % buckets
    big = r * (q + 1)
    return F.when(rank <= big, F.floor((rank - 1) / (q + 1)) + 1) \
        .otherwise(r + F.floor((rank - big - 1) / q) + 1).cast("int")


def exact_ntile(df: DataFrame, buckets: int, order: list[Column], out: str = "tile",
                num_partitions: int | None = None) -> DataFrame:
    ranked = global_row_number(df, order, num_partitions, out="_rank")
    return ranked.withColumn(out, ntile_of_rank(F.col("_rank"), F.col("_total"), buckets)) \
        .drop("_rank", "_total")


def running_sums(df: DataFrame, order: list[str], values: list[str], num_partitions: int | None = None) -> DataFrame:
    """``df`` with ``before_<value>``: the sum of each value over all rows earlier in ``order``
    (columns that make a total order). Distributed as ``global_row_number`` is: local windows
    over ordered ranges, and one broadcast row of offsets per range."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = freeze(df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()))
    before = W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    totals = ranged.groupBy("_pid").agg(*[F.sum(v).alias(v) for v in values])
    offsets = totals.select("_pid", *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_off_{v}") for v in values])
    local = W.partitionBy("_pid").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    summed = ranged.select("*", *[F.coalesce(F.sum(v).over(local), F.lit(0)).alias(f"before_{v}") for v in values])
    joined = summed.join(F.broadcast(offsets), "_pid")
    for v in values:
        joined = joined.withColumn(f"before_{v}", F.col(f"before_{v}") + F.col(f"_off_{v}"))
    return joined.drop("_pid", *[f"_off_{v}" for v in values])
