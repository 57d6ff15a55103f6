"""Rows that break their table's rules: shown, and set aside when a table is loaded.

Every row rule of a table (NOT NULL, domain, range, length, end after start, and "the record could
be read") is one bit of a mask, computed once per row without a shuffle. A load writes each row
once, under ``rejected=false`` or ``rejected=true``; rejected rows keep their values, the names of
the rules they break and, for unreadable records, the raw text.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.operators.quality import constraint_rules

CORRUPT = "_corrupt_record"
UNREADABLE = "readable:record"


def rule_names(spec, *, corrupt: bool = False, **overrides) -> list[str]:
    """Names ``rule:column`` of the bits of ``rule_mask``, lowest first."""
    names = [f"{rule}:{column}" for rule, column, _ in constraint_rules(spec, **overrides)]
    return [*names, UNREADABLE] if corrupt else names


def rule_mask(spec, *, corrupt_col: str | None = None, **overrides) -> Column:
    """Bits of the rules that a row breaks; a rule whose value is NULL is not broken, as in a
    SQL CHECK. ``overrides`` are those of ``constraint_rules`` (domains, ranges)."""
    broken = [pred for _, _, pred in constraint_rules(spec, **overrides)]
    if corrupt_col:
        broken.append(F.col(corrupt_col).isNotNull())
    mask = F.lit(0).cast("long")
    for bit, pred in enumerate(broken):
        mask = mask.bitwiseOR(F.when(pred, F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return mask


def names_of(mask: Column, names: list[str]) -> Column:
    """The names of a mask's bits as an array."""
    flagged = [F.when(mask.bitwiseAND(F.lit(1 << bit).cast("long")) != 0, F.lit(name)) for bit, name in enumerate(names)]
    return F.filter(F.array(*flagged), lambda x: x.isNotNull())


def offending_rows(df: DataFrame, spec, **overrides) -> DataFrame:
    """The rows that break a rule, with ``broken_rules``."""
    names = rule_names(spec, **overrides)
    mask = rule_mask(spec, **overrides)
    return df.withColumn("_mask", mask).where("_mask <> 0").withColumn(
        "broken_rules", names_of(F.col("_mask"), names)).drop("_mask")


def split_write(df: DataFrame, spec, path: str, **overrides) -> tuple[DataFrame, DataFrame]:
    """Write every row of ``df`` once, good and rejected ones apart; (good, rejected) as read back.

    ``df`` may have columns beyond the table's; its ``_corrupt_record``, if there, makes
    unreadable records rejected ones. Rejected rows have ``broken_rules`` as well.
    """
    corrupt = CORRUPT in df.columns
    names = rule_names(spec, corrupt=corrupt, **overrides)
    mask = rule_mask(spec, corrupt_col=CORRUPT if corrupt else None, **overrides)
    out = (df.withColumn("_mask", mask).withColumn("rejected", F.col("_mask") != 0)
           .withColumn("broken_rules", F.when(F.col("rejected"), names_of(F.col("_mask"), names))).drop("_mask"))
    out.write.mode("overwrite").partitionBy("rejected").parquet(path)
    back = df.sparkSession.read.schema(out.schema).parquet(path)
    good = back.where(~F.col("rejected")).drop("rejected", "broken_rules", *([CORRUPT] if corrupt else []))
    return good, back.where("rejected").drop("rejected")


def reject_counts(rejected: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, broken_rule, rows) over rejected rows; a row counts under each rule it breaks."""
    out = None
    for name, df in rejected.items():
        one = (df.select(F.explode("broken_rules").alias("broken_rule")).groupBy("broken_rule")
               .agg(F.count(F.lit(1)).alias("rows"))
               .select(F.lit(name).alias("table_name"), "broken_rule", "rows"))
        out = one if out is None else out.unionByName(one)
    return out


def load_checked(spark: SparkSession, tables: Mapping[str, DataFrame], target_dir: str,
                 overrides: Mapping[str, dict] | None = None
                 ) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """``split_write`` of every canonical table under ``target_dir``: ({name: good}, {name: rejected})."""
    from recurra.sources.schema import TABLES
    good, bad = {}, {}
    for name, df in tables.items():
        good[name], bad[name] = split_write(df, TABLES[name], f"{target_dir.rstrip('/')}/{name}",
                                            **(overrides or {}).get(name, {}))
    return good, bad
