"""The layer chain: read a CSV layer, clean each table, write the cleaned layer, validate it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recurra.operators.cleaning import cln_generic, cln_subs
from recurra.operators.quality import val_status, val_tables
from recurra.operators.rejects import CORRUPT, split_write
from recurra.sources.readers import list_files, src_csv, table_name_of
from recurra.sources.schema import TABLES
from recurra.sources.sinks import snk_csv


def clean_layer(spark: SparkSession, source_dir: str, target_dir: str,
                schemas: Mapping[str, StructType] | None = None) -> dict[str, DataFrame]:
    """Clean every CSV table of ``source_dir`` into ``target_dir`` and return the cleaned
    tables as read back. Subscriptions get their typed cleaner, every other table the
    generic one. ``schemas`` gives the columns of the source tables (inferred if absent)."""
    out: dict[str, DataFrame] = {}
    for path in list_files(spark, source_dir):
        name = table_name_of(path)
        raw = src_csv(spark, path, (schemas or {}).get(name))
        cleaned = cln_subs(raw) if name == "subscriptions" else cln_generic(raw)
        target = f"{target_dir.rstrip('/')}/{name}.csv"
        snk_csv(cleaned, target)
        out[name] = src_csv(spark, target, cleaned.schema)
    return out


def validate_layer(tables: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(per-table counts of rows and duplicate rows, one-row overall status)."""
    return val_tables(dict(tables)), val_status(dict(tables))


def _subs_cleaned(raw: DataFrame) -> DataFrame:
    """Subscriptions by their typed cleaner with the types of ``raw``; unreadable records as they are."""
    fields = raw.schema.fields
    both = cln_subs(raw.select("*", *[F.col(f.name).alias(f"_raw_{f.name}") for f in fields]))
    return both.select(*[F.when(F.col(f"_raw_{CORRUPT}").isNull(), F.col(f.name).try_cast(f.dataType))
                         .otherwise(F.col(f"_raw_{f.name}")).alias(f.name) for f in fields])


def load_layer(spark: SparkSession, source_dir: str, target_dir: str,
               schemas: Mapping[str, StructType] | None = None,
               overrides: Mapping[str, dict] | None = None) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The whole chain over a CSV layer: read (unreadable records kept), clean, and store every
    canonical table with the rows that break its rules set aside: ({name: good}, {name: rejected}).

    An unreadable record is rejected before cleaning can drop, merge or change it; a table is
    read once for both kinds of records. ``schemas`` gives the
    columns of source tables that have more than the canonical ones, ``overrides`` other rules
    per table (domains, ranges). Tables that are not canonical are left out.
    """
    good, bad = {}, {}
    for path in list_files(spark, source_dir):
        name = table_name_of(path)
        if name not in TABLES:
            continue
        raw = src_csv(spark, path, (schemas or {}).get(name, TABLES[name].schema), corrupt_col=CORRUPT)
        cleaned = _subs_cleaned(raw) if name == "subscriptions" else cln_generic(raw, aside_col=CORRUPT)
        good[name], bad[name] = split_write(cleaned, TABLES[name],
                                            f"{target_dir.rstrip('/')}/{name}", **(overrides or {}).get(name, {}))
    return good, bad


def layer_status(good: Mapping[str, DataFrame], bad: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, loaded_rows, duplicate_full_rows, rejected_rows, unreadable_rows, passed) per
    table: a table passes if rows were loaded and none is there twice."""
    counts = None
    for name, df in bad.items():
        unreadable = F.array_contains("broken_rules", "readable:record").cast("int")
        one = df.agg(F.count(F.lit(1)).alias("rejected_rows"),
                     F.coalesce(F.sum(unreadable), F.lit(0)).cast("long").alias("unreadable_rows")) \
            .select(F.lit(name).alias("table_name"), "rejected_rows", "unreadable_rows")
        counts = one if counts is None else counts.unionByName(one)
    return (val_tables(dict(good)).join(counts, "table_name")
            .select("table_name", F.col("row_count").alias("loaded_rows"), "duplicate_full_rows",
                    "rejected_rows", "unreadable_rows",
                    (~F.col("is_empty") & (F.col("duplicate_full_rows") == 0)).alias("passed")))
