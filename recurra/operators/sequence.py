"""Sequential (previous-row) logic per key that survives hot keys.

``LAG(v) OVER (PARTITION BY key ORDER BY ...)`` puts every row of a key in one
task. ``lag_within`` computes the same column over range partitions:

1. the rows are range-partitioned by (key, full order), so a hot key spreads over as
   many partitions as it needs, also where its rows share one leading value. The
   layout comes from a sample, so it is checkpointed: both passes below must see the
   same partitions;
2. a window per (partition, key) computes the local LAG;
3. the first row of a partition takes the last value of the previous non-empty
   partition if the keys agree, from a carry table with one row per partition
   (broadcast).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recurra.session import freeze


def lag_within(df: DataFrame, key: str, order: list[str], value: str, out: str = "prev",
               num_partitions: int | None = None, skew_safe: bool = True) -> DataFrame:
    """Add ``out`` = previous row's ``value`` within ``key`` in ``order`` (a total order)."""
    if not skew_safe:
        return df.withColumn(out, F.lag(value).over(W.partitionBy(key).orderBy(*order)))
    n_parts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = freeze(df.repartitionByRange(n_parts, key, *order)
                    .withColumn("_part", F.spark_partition_id()))
    run = W.partitionBy("_part", key).orderBy(*order)
    local = (placed.withColumn(out, F.lag(value).over(run))
             .withColumn("_first", F.row_number().over(run) == 1))
    last = F.max_by(F.struct(F.col(key).alias("key"), F.col(value).alias("value")), F.struct(key, *order))
    tails = placed.groupBy("_part").agg(last.alias("_last"))
    carry = tails.select("_part", F.lag("_last").over(W.orderBy("_part")).alias("_carry"))  # one row per partition
    over = F.col("_first") & F.col("_carry").isNotNull() & F.col("_carry.key").eqNullSafe(F.col(key))
    return (local.join(F.broadcast(carry), "_part", "left")
            .withColumn(out, F.when(over, F.col("_carry.value")).otherwise(F.col(out)))
            .drop("_part", "_first", "_carry"))
