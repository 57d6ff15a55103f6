"""Cleaning operators: generic keep-first dedupe + 'missing' filter, typed subscription cleaner."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_id_column(df: DataFrame) -> str | None:
    ids = [c for c in df.columns if c.endswith("_id")]
    return ids[0] if ids else None


def keep_first(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """One row per ``key``: the first in ``order``, then in the order of all its columns, so
    that rows tied on ``order`` give the same row on every run.

    Spark pushes the limit of one row per key below the shuffle: a task sends one row of a key
    at most, so a key with very many copies never gathers in a single task.
    """
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in df.columns if c not in keys]
    first = W.partitionBy(*keys).orderBy(*order, *[c for c in rest if c not in order])
    return df.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")


def cln_generic(df: DataFrame, order_col: str = "ingest_seq", issue_col: str = "quality_issue",
                word: str = "missing", aside_col: str | None = None) -> DataFrame:
    """If ``issue_col`` exists: keep the first row per first ``*_id`` column (by
    ``order_col``), then drop rows whose issue mentions ``word`` (case-insensitive,
    NULL-safe). Tables without the column pass through unchanged, and so do, in the same
    scan, rows that have a value in ``aside_col``."""
    if issue_col not in df.columns:
        return df
    keep = ~F.lower(F.coalesce(F.col(issue_col), F.lit(""))).contains(word.lower())
    key = first_id_column(df)
    if aside_col is None:
        return (df if key is None else keep_first(df, key, [order_col])).where(keep)
    if key is not None:                                       # a row set aside is a group of its own
        own = F.when(F.col(aside_col).isNotNull(), F.monotonically_increasing_id())
        df = keep_first(df.withColumn("_own", own), [key, "_own"], [order_col]).drop("_own")
    return df.where(F.col(aside_col).isNotNull() | keep)


def cln_subs(df: DataFrame) -> DataFrame:
    """Typed subscription cleaner: dates as date, price/mrr coerced to numbers (bad
    values -> NULL), ``quality_issue`` NULL -> 'None' when the column exists."""
    out = df.withColumn("start_date", F.to_date("start_date"))
    if "end_date" in out.columns:
        out = out.withColumn("end_date", F.to_date("end_date"))
    for c in ("monthly_price", "mrr"):
        out = out.withColumn(c, F.col(c).cast("string").try_cast("double"))
    if "quality_issue" in out.columns:
        out = out.withColumn("quality_issue", F.coalesce(F.col("quality_issue"), F.lit("None")))
    return out
