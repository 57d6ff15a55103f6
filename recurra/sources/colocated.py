"""Tables stored in buckets by a key and sorted inside them, so that work per key needs no shuffle.

A key with as many rows as an average bucket would make its bucket grow with it. The rows of
such keys are stored apart, without buckets: operators work on both parts, which share no key,
and put their per-key results together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Colocated:
    """The two parts of a stored table; no key is in both."""
    bucketed: DataFrame
    hot: DataFrame


def store_colocated(df: DataFrame, table: str, key: str, order: list[str], *, buckets: int,
                    root: str) -> Colocated:
    """Write ``df`` as the catalog tables ``table`` (in ``buckets`` files by ``key``, sorted by
    key and ``order``) and ``table``_hot (keys with more rows than rows / buckets, so fewer
    than ``buckets`` keys) under the shared folder ``root``; NULL is a key like others.
    Existing tables of these names are overwritten."""
    per_key = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    share = df.agg((F.count(F.lit(1)) / F.lit(buckets)).alias("n")).scalar()
    big = F.broadcast(per_key.where(F.col("_n") > share).select("_key"))     # fewer than buckets rows
    same = F.col(key).eqNullSafe(F.col("_key"))
    # one task per bucket writes one file; rows of one key come sorted
    (df.join(big, same, "left_anti").repartition(buckets, key).write.mode("overwrite")
     .bucketBy(buckets, key).sortBy(key, *order).option("path", f"{root.rstrip('/')}/{table}").saveAsTable(table))
    (df.join(big, same, "left_semi").write.mode("overwrite")
     .option("path", f"{root.rstrip('/')}/{table}_hot").saveAsTable(f"{table}_hot"))
    return read_colocated(df.sparkSession, table)


def read_colocated(spark: SparkSession, table: str) -> Colocated:
    return Colocated(spark.table(table), spark.table(f"{table}_hot"))
