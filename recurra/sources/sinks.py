"""Sinks: typed appends, CSV/Parquet layer writes, report blocks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions import month_start

# Fact tables are laid out by month so date filters prune whole directories.
PARTITION_COLUMNS = {
    "payments": ("payment_date", "payment_month"),
    "product_usage": ("event_date", "event_month"),
    "support_tickets": ("created_date", "created_month"),
}


def clustered(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows brought together by the partition columns of a write, so that it does not make a
    file per task and partition. The rebalancing shuffle is adaptive: a large partition is
    split over several tasks and files, small ones share a task."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def snk_append(df: DataFrame, table: str, *, path: str | None = None,
               partition_by: list[str] | None = None) -> None:
    """Append rows to a table (catalog table, or a Parquet directory when ``path``); with
    ``partition_by`` the rows are clustered by those columns first."""
    w = (clustered(df, partition_by) if partition_by else df).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w.parquet(path)
    else:
        w.saveAsTable(table)


def snk_csv(df: DataFrame, path: str) -> None:
    """Overwrite a CSV directory with a header row."""
    df.write.mode("overwrite").option("header", True) \
        .option("dateFormat", "yyyy-MM-dd").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss") \
        .csv(path)


def snk_parquet(df: DataFrame, path: str, name: str | None = None) -> None:
    """Overwrite a Parquet directory; known fact tables are clustered and partitioned by month."""
    spec = PARTITION_COLUMNS.get(name or "")
    if spec:
        src, part = spec
        (clustered(df.withColumn(part, month_start(src)), [part]).sortWithinPartitions(part, src)
         .write.mode("overwrite").partitionBy(part).parquet(path))
    else:
        df.write.mode("overwrite").parquet(path)


def materialize_model(tables: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """Write every table under ``root`` (Parquet, facts partitioned by month)."""
    out = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}"
        snk_parquet(df, path, name)
        out[name] = path
    return out


def snk_report(blocks: Mapping[str, DataFrame], path: str) -> dict[str, str]:
    """Write each report block (a few rows each) as one JSON file per block."""
    out = {}
    for name, df in blocks.items():
        target = f"{path.rstrip('/')}/{name}"
        df.coalesce(1).write.mode("overwrite").json(target)   # blocks are tiny by design
        out[name] = target
    return out


def with_month(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, month_start(F.col(col)))
