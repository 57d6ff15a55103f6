"""Sources: CSV/Parquet scans with the canonical schemas, a whole model, SQL text."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructType, TimestampNTZType, TimestampType

from recurra.operators.ranking import global_row_number
from recurra.sources.schema import TABLES, TableSpec

log = logging.getLogger(__name__)

DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
CORRUPT = "_corrupt_record"


def _schema(schema: StructType | TableSpec | None) -> StructType | None:
    return schema.schema if isinstance(schema, TableSpec) else schema


def src_csv(spark: SparkSession, path: str, schema: StructType | TableSpec | None = None,
            header: bool = True, corrupt_col: str | None = None) -> DataFrame:
    """Scan CSV with a header; with a schema the types are exact (PERMISSIVE: bad
    values become NULL), without one the types are inferred. With ``corrupt_col`` (and a
    schema) the raw text of every record with an unreadable value is kept in that
    column, so that a bad value can be told from a missing one."""
    reader = (spark.read.option("header", header).option("mode", "PERMISSIVE")
              .option("dateFormat", DATE_FORMAT).option("timestampFormat", TIMESTAMP_FORMAT)
              .option("timestampNTZFormat", TIMESTAMP_FORMAT))
    st = _schema(schema)
    if st is not None:
        # declared NOT NULL columns must still load rows with gaps (audits count them)
        st = StructType([f.__class__(f.name, f.dataType, True) for f in st.fields])
        if corrupt_col is not None:
            st = st.add(corrupt_col, StringType())
            reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
        reader = reader.schema(st)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def corrupt_rows(tables: Mapping[str, DataFrame], corrupt_col: str = "_corrupt_record") -> DataFrame:
    """(table_name, corrupt_rows) of tables read with ``corrupt_col``."""
    out = None
    for name, df in tables.items():
        # a record is only parsed, and found unreadable, if its columns are used: hash them all
        parsed = F.xxhash64(*[c for c in df.columns if c != corrupt_col]) >= F.lit(-(1 << 63))
        bad = F.count(F.when(parsed, F.col(corrupt_col)))
        one = df.agg(bad.alias("corrupt_rows"), F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "corrupt_rows", "rows")
        out = one if out is None else out.unionByName(one)
    return out


def list_files(spark: SparkSession, directory: str, glob: str = "*.csv") -> list[str]:
    """Table paths of a layer directory on any Hadoop-compatible store, sorted.

    A table is either a file matching ``glob`` directly in the directory, or a
    directory of part files named like one (as Spark writes CSV). Listing goes
    through Spark's file index (only the path column is read), so it works for
    HDFS/S3 layers, not just the driver's disk.
    """
    root = directory.rstrip("/")
    suffix = glob.lstrip("*")
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
               .option("recursiveFileLookup", True).load(root).select("path"))
    # the part files become their tables on the executors: only table paths are collected
    marker = root.split(":", 1)[-1] + "/"
    end = F.locate(marker, F.col("path")) + len(marker)
    rel = F.substring(F.col("path"), end, F.length("path"))
    top = F.substring_index(rel, "/", 1)
    tables = listing.where(~rel.contains("/") | top.endswith(suffix)).select(
        F.concat(F.substring(F.col("path"), F.lit(1), end - 1), top).alias("t")).distinct()
    return sorted(r.t for r in tables.collect())


def table_name_of(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[0]


def src_dir(spark: SparkSession, directory: str, glob: str = "*.csv", *,
            rejects_dir: str | None = None) -> dict[str, DataFrame]:
    """Every CSV table of a layer directory, keyed by file stem (sorted).
    Known canonical tables get their schema; others are inferred. With ``rejects_dir``
    each canonical table is stored there, unreadable records and rows that break the table's
    rules apart (``operators.rejects``), and the good rows are returned."""
    out: dict[str, DataFrame] = {}
    for path in list_files(spark, directory, glob):
        name = table_name_of(path)
        if rejects_dir is not None and name in TABLES:
            out[name] = _checked(spark, src_csv(spark, path, TABLES[name], corrupt_col=CORRUPT), name, rejects_dir)
        else:
            out[name] = src_csv(spark, path, TABLES.get(name))
    return out


def _checked(spark: SparkSession, df: DataFrame, name: str, rejects_dir: str) -> DataFrame:
    from recurra.operators.rejects import split_write
    return split_write(df, TABLES[name], f"{rejects_dir.rstrip('/')}/{name}")[0]


def src_table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    return spark.table(f"{database}.{name}" if database else name)


def src_model(spark: SparkSession, directory: str, fmt: str = "csv", *,
              rejects_dir: str | None = None) -> dict[str, DataFrame]:
    """Load the canonical tables in dependency order; a table whose path does not exist is
    skipped with a warning, any other fault is raised. ``rejects_dir`` as in ``src_dir``."""
    present = {table_name_of(p) for p in list_files(spark, directory, f"*.{fmt}")} \
        if fmt == "csv" else None
    out: dict[str, DataFrame] = {}
    for name, spec in TABLES.items():
        path = f"{directory.rstrip('/')}/{name}.{fmt}"
        if present is not None and name not in present:
            log.warning("table %s: %s not found, skipped", name, path)
            continue
        try:
            corrupt = CORRUPT if rejects_dir is not None else None
            df = src_csv(spark, path, spec, corrupt_col=corrupt) if fmt == "csv" else spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":     # any other fault is the caller's to see
                raise
            log.warning("table %s: %s not found, skipped", name, path)
            continue
        df = src_coerce(df, LOAD_COERCIONS.get(name, {}))
        out[name] = _checked(spark, df, name, rejects_dir) if rejects_dir is not None else df
    return out


# columns re-typed at load (timestamps / dates written as text)
LOAD_COERCIONS: dict[str, dict[str, str]] = {
    "payments": {"payment_date": "timestamp_ntz"},
    "support_tickets": {"created_date": "timestamp_ntz"},
    "marketing_campaigns": {"campaign_month": "date"},
}


def src_coerce(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the given columns; text dates/timestamps are parsed with the load formats."""
    for c, t in types.items():
        if c not in df.columns:
            continue
        col = F.col(c)
        current = df.schema[c].dataType
        if t == "date" and not isinstance(current, DateType):
            col = F.to_date(col.cast("string"), DATE_FORMAT) if current.simpleString() == "string" \
                else F.to_date(col)
        elif t in ("timestamp", "timestamp_ntz") and not isinstance(
                current, (TimestampType, TimestampNTZType)):
            col = F.to_timestamp_ntz(col.cast("string"), F.lit(TIMESTAMP_FORMAT))
        else:
            col = col.cast(t)
        df = df.withColumn(c, col)
    return df


def src_defaults(df: DataFrame, defaults: Mapping[str, object], id_col: str | None = None,
                 order: list[str] | None = None) -> DataFrame:
    """Fill column defaults and number rows into ``id_col`` when it is missing/NULL.

    With ``order`` the numbers are dense 1..n in that (total) order, computed with a
    range-partitioned numbering; without it they are unique but not dense.
    """
    for c, v in defaults.items():
        if c in df.columns:
            df = df.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)))
        else:
            df = df.withColumn(c, F.lit(v))
    if id_col:
        if order:
            df = global_row_number(df, [F.col(c) for c in order], out="_n") \
                .drop("_total").withColumnRenamed("_n", "_new_id")
        else:
            df = df.withColumn("_new_id", F.monotonically_increasing_id() + 1)
        new_id = F.coalesce(F.col(id_col), F.col("_new_id")) if id_col in df.columns \
            else F.col("_new_id")
        df = df.withColumn(id_col, new_id.cast("long")).drop("_new_id")
    return df


PRODUCT_USAGE_DEFAULTS = {"feature": "Dashboard", "active_minutes": 0, "events": 0}


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Expose DataFrames as temp views so SQL text can refer to them by name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def src_sql_df(spark: SparkSession, text: str) -> DataFrame:
    return spark.sql(text)


def src_sql_row(spark: SparkSession, text: str) -> Row:
    """First row of a SQL text; meant for one-row aggregates (a scorecard)."""
    return spark.sql(text).first()
