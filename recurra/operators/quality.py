"""Data-quality audits: null/duplicate/date checks and rule-driven constraint audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.session import freeze


def _flag_sum(cond) -> F.Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def q13_nulls(s: DataFrame) -> DataFrame:
    """Subscriptions: total, NULL user_id, NULL plan_id, churned without end_date."""
    return s.agg(
        F.count(F.lit(1)).alias("total_logged_subscriptions"),
        _flag_sum(F.col("user_id").isNull()).alias("null_user_ids"),
        _flag_sum(F.col("plan_id").isNull()).alias("null_plan_ids"),
        _flag_sum((F.col("status") == "Churned") & F.col("end_date").isNull())
        .alias("anomalous_churn_dates"),
    )


# ---- notebook / script audits -------------------------------------------------------

def aud_null_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, column, null_count) for every column of every given table.

    One aggregation pass per table (a row of conditional sums), unpivoted with
    ``stack`` -- no per-column jobs.
    """
    out = None
    for name, df in tables.items():
        sums = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns])
        pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
        long = sums.selectExpr(
            f"stack({len(df.columns)}, {pairs}) as (column_name, null_count)"
        ).select(F.lit(name).alias("table_name"), "column_name",
                 F.coalesce(F.col("null_count"), F.lit(0)).cast("long").alias("null_count"))
        out = long if out is None else out.unionByName(long)
    return out


def aud_dup_key(df: DataFrame, key: str = "payment_id") -> DataFrame:
    """Key values that occur more than once, with their counts."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1))


def aud_dup_count(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table, key, duplicate_rows): rows beyond the first per key value."""
    out = None
    for name, (df, key) in tables.items():
        one = df.agg((F.count(F.lit(1)) - F.countDistinct(key)).alias("duplicate_rows")).select(
            F.lit(name).alias("table_name"), F.lit(key).alias("key_column"),
            F.col("duplicate_rows").cast("long"))
        out = one if out is None else out.unionByName(one)
    return out


def aud_missing_dates(p: DataFrame, col: str = "payment_date") -> DataFrame:
    return p.agg(_flag_sum(F.col(col).isNull()).alias("missing_dates"))


def aud_start_before_signup(s: DataFrame, u: DataFrame) -> DataFrame:
    """Subscriptions (joined to their user) that start before the user's signup."""
    per_user_day = s.groupBy("user_id", "start_date").agg(F.count(F.lit(1)).alias("n"))
    joined = per_user_day.join(u.select("user_id", "signup_date"), "user_id")
    return joined.agg(
        F.coalesce(F.sum(F.when(F.col("start_date") < F.col("signup_date"), F.col("n"))),
                   F.lit(0)).cast("long").alias("start_before_signup"))


def aud_end_before_start(s: DataFrame) -> DataFrame:
    churned = s.where(F.col("status") == "Churned")
    return churned.agg(_flag_sum(F.col("end_date") < F.col("start_date"))
                       .alias("end_before_start"))


def aud_payment_before_start(p: DataFrame, s: DataFrame) -> DataFrame:
    """Payments dated before their subscription's start (payments pre-aggregated by
    subscription and day, so a hot subscription adds at most one row per day)."""
    per_day = p.groupBy("subscription_id", F.to_date("payment_date").alias("pay_day")) \
        .agg(F.count(F.lit(1)).alias("n"))
    joined = per_day.join(s.select("subscription_id", "start_date"), "subscription_id")
    return joined.agg(
        F.coalesce(F.sum(F.when(F.col("pay_day") < F.col("start_date"), F.col("n"))),
                   F.lit(0)).cast("long").alias("payment_before_start"))


# ---- rule-driven constraint audit ---------------------------------------------------

def constraint_rules(spec, *, domains: dict | None = None, ranges: dict | None = None):
    """(rule, column, violation predicate) for a TableSpec; ``domains``/``ranges``
    override the declared IN-lists / bounds by column (pass None to drop a rule)."""
    from recurra.sources.schema import Range
    rules = []
    for c in spec.not_null:
        rules.append(("not_null", c, F.col(c).isNull()))
    dom = dict(spec.domains)
    dom.update(domains or {})
    for c, values in dom.items():
        if values is not None:
            rules.append(("domain", c, ~F.col(c).isin(list(values))))
    rng = {r.column: r for r in spec.ranges}
    for c, r in (ranges or {}).items():
        rng[c] = r if (r is None or isinstance(r, Range)) else Range(c, r[0], r[1])
    for c, r in rng.items():
        if r is None:
            continue
        bound = F.lit(r.bound).cast(spec.schema[c].dataType)
        ok = F.col(c) >= bound if r.op == ">=" else F.col(c) > bound
        rules.append((f"range{r.op}{r.bound}", c, ~ok))
    for c, n in spec.lengths.items():
        rules.append((f"length<={n}", c, F.length(c) > n))
    if spec.end_after_start:
        a, b = spec.end_after_start
        rules.append(("end_after_start", b, F.col(b) < F.col(a)))
    return rules


def _kind_of(rule: str) -> str:
    return "range" if rule == "end_after_start" else rule.split("<")[0].split(">")[0]


def audit(df: DataFrame, spec, *, domains: dict | None = None,
          ranges: dict | None = None, kinds: tuple[str, ...] | None = None) -> DataFrame | None:
    """All row rules of a table in ONE aggregation pass (a conditional sum per rule),
    plus key uniqueness; returns (table_name, rule, column_name, violations).

    SQL CHECK semantics: a NULL predicate is not a violation. ``kinds`` limits the
    rules evaluated (not_null, unique, domain, range, length); None if none apply.
    """
    rules = constraint_rules(spec, domains=domains, ranges=ranges)
    if kinds is not None:
        rules = [r for r in rules if any(_kind_of(r[0]).startswith(k) for k in kinds)]
    aggs = [F.sum(F.when(pred, 1).otherwise(0)).cast("long").alias(f"r{i}")
            for i, (_, _, pred) in enumerate(rules)]
    keys = list(spec.primary_key) + list(spec.unique)
    if kinds is not None and "unique" not in kinds:
        keys = []
    if not rules and not keys:
        return None
    for j, k in enumerate(keys):
        aggs.append((F.count(F.lit(1)) - F.countDistinct(k)).cast("long").alias(f"u{j}"))
    row = df.agg(*aggs)
    labels = [(r, c, f"r{i}") for i, (r, c, _) in enumerate(rules)]
    labels += [("unique", k, f"u{j}") for j, k in enumerate(keys)]
    pairs = ", ".join(f"'{r}', '{c}', `{a}`" for r, c, a in labels)
    return row.selectExpr(f"stack({len(labels)}, {pairs}) as (rule, column_name, violations)") \
        .select(F.lit(spec.name).alias("table_name"), "rule", "column_name",
                F.coalesce(F.col("violations"), F.lit(0)).cast("long").alias("violations"))


def audit_model(tables: dict[str, DataFrame], kinds: tuple[str, ...] | None = None,
                **overrides) -> DataFrame:
    """``audit`` over every canonical table; ``overrides`` maps table -> kwargs."""
    from recurra.sources.schema import TABLES
    out = None
    for name, df in tables.items():
        one = audit(df, TABLES[name], kinds=kinds, **overrides.get(name, {}))
        if one is None:
            continue
        out = one if out is None else out.unionByName(one)
    return out


def aud_fk(tables: dict[str, DataFrame]) -> DataFrame:
    """Orphan counts for every declared foreign key: (child, column, parent, orphans).

    One pass for all edges: each child table is scanned once, its FK values are
    tagged by edge and reduced to distinct (edge, parent, key) -> count (map-side
    combined, so hot keys collapse); parent keys are reduced to distinct
    (parent, key); a single left join on (parent, key) finds the orphans.
    """
    from recurra.sources.schema import TABLES
    edges = [(child, fk.column, fk.parent, fk.parent_column)
             for child, spec in TABLES.items() if child in tables
             for fk in spec.foreign_keys if fk.parent in tables]
    if not edges:
        return None
    child_keys = None
    for child in dict.fromkeys(e[0] for e in edges):
        mine = [(i, e) for i, e in enumerate(edges) if e[0] == child]
        tagged = tables[child].select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("edge"), F.lit(e[2]).alias("parent"),
                     F.col(e[1]).cast("long").alias("k")) for i, e in mine])).alias("t"))
        one = (tagged.select("t.edge", "t.parent", "t.k").where(F.col("k").isNotNull())
               .groupBy("edge", "parent", "k").agg(F.count(F.lit(1)).alias("n")))
        child_keys = one if child_keys is None else child_keys.unionByName(one)
    parent_keys = None
    for parent, pk in dict.fromkeys((e[2], e[3]) for e in edges):
        one = tables[parent].select(F.lit(parent).alias("parent"),
                                    F.col(pk).cast("long").alias("k")).distinct()
        parent_keys = one if parent_keys is None else parent_keys.unionByName(one)
    found = parent_keys.withColumn("found", F.lit(True))
    orphans = (child_keys.join(found, ["parent", "k"], "left")
               .groupBy("edge")
               .agg(F.sum(F.when(F.col("found").isNull(), F.col("n")).otherwise(0)).alias("o")))
    spark = child_keys.sparkSession
    meta = spark.createDataFrame([(i, c, col, par) for i, (c, col, par, _) in enumerate(edges)],
                                 "edge int, child_table string, column_name string, parent_table string")
    return (meta.join(orphans, "edge", "left")
            .select("child_table", "column_name", "parent_table",
                    F.coalesce(F.col("o"), F.lit(0)).cast("long").alias("orphans")))


# ---- validation gates (empty / duplicate full rows / overall status) -----------------

def _fingerprints(df: DataFrame) -> tuple:
    """Two 64-bit hashes over all columns (the second chain starts from another value)."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return F.xxhash64(*columns).alias("_fp_1"), F.xxhash64(F.lit(1), *columns).alias("_fp_2")


def val_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows, is_empty, duplicate_full_rows).

    Rows are counted by a 128-bit fingerprint, so 16 bytes a row are shuffled and not the
    row, for all tables at once; copies combine map-side, however many. Whole rows are
    compared only where a fingerprint occurs more than once, so the counts are exact. Runs
    when called: the counts are stored, a second pass reads only tables with such rows.
    """
    prints = None
    for i, df in enumerate(tables.values()):
        one = df.select(F.lit(i).alias("t"), *_fingerprints(df))
        prints = one if prints is None else prints.unionByName(one)
    groups = prints.groupBy("t", "_fp_1", "_fp_2").agg(F.count(F.lit(1)).alias("n"))
    again = F.col("n") > 1
    counts = freeze(groups.groupBy("t", F.when(again, F.col("_fp_1")).alias("_fp_1"),
                                   F.when(again, F.col("_fp_2")).alias("_fp_2")).agg(F.sum("n").alias("n")))
    repeated = counts.where(F.col("_fp_1").isNotNull())
    spark = counts.sparkSession
    found = {r.t for r in repeated.select("t").distinct().collect()}       # at most one row per table
    copies = spark.createDataFrame([], "t int, duplicate_full_rows long")
    for i, df in enumerate(tables.values()):
        if i in found:
            suspects = repeated.where(F.col("t") == i).select("_fp_1", "_fp_2")
            rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *_fingerprints(df)) \
                .join(suspects, ["_fp_1", "_fp_2"], "left_semi")
            groups = rows.groupBy("_fp_1", "_fp_2", "row").agg(F.count(F.lit(1)).alias("n"))
            copies = copies.unionByName(groups.agg(F.sum(F.col("n") - 1).alias("duplicate_full_rows"))
                                        .select(F.lit(i).alias("t"), "duplicate_full_rows"))
    meta = spark.createDataFrame(list(enumerate(tables)), "t int, table_name string")
    rows = F.coalesce(F.col("row_count"), F.lit(0))
    return (meta.join(counts.groupBy("t").agg(F.sum("n").alias("row_count")), "t", "left")
            .join(copies, "t", "left")
            .select("table_name", rows.alias("row_count"), (rows == 0).alias("is_empty"),
                    F.coalesce(F.col("duplicate_full_rows"), F.lit(0)).alias("duplicate_full_rows")))


def val_empty(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows, is_empty) by plain counts."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", (F.col("row_count") == 0).alias("is_empty"))
        out = one if out is None else out.unionByName(one)
    return out


def val_status(tables: dict[str, DataFrame]) -> DataFrame:
    """One row: number of failing tables and the overall pass flag."""
    v = val_tables(tables)
    failing = (F.col("is_empty") | (F.col("duplicate_full_rows") > 0)).cast("int")
    return v.agg(F.sum(failing).cast("long").alias("failures")) \
        .select("failures", (F.col("failures") == 0).alias("passed"))
