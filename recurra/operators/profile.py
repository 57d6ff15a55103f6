"""Profiles from the notebooks: value counts, plan/tier profiles, crosstab, describe, shapes."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recurra.functions import pg_round, ratio
from recurra.session import freeze


def n1_value_counts(u: DataFrame, cols: Sequence[str] = ("acquisition_channel", "region",
                                                         "company_size")) -> DataFrame:
    """(column, value, count) for several columns in one pass (unpivot, then one group-by)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                         F.col(c).cast("string").alias("value")) for c in cols]))
    return (u.select(pairs.alias("kv")).select("kv.column_name", "kv.value")
            .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("column_name", F.desc("count"), "value"))


def _plan_price_stats(s: DataFrame, pl: DataFrame) -> DataFrame:
    per_plan = s.groupBy("plan_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("monthly_price").cast("decimal(38,2)")).alias("total"),
        F.count("monthly_price").alias("price_n"))
    return (per_plan.join(pl.select("plan_id", "plan_name"), "plan_id")
            .groupBy("plan_name")
            .agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("price_n").alias("price_n")))


def n1_plan_profile(s: DataFrame, pl: DataFrame) -> DataFrame:
    """Plan: count, mean and sum of the subscription's own monthly price."""
    g = _plan_price_stats(s, pl)
    return g.select("plan_name", F.col("price_n").cast("long").alias("count"),
                    ratio("total", "price_n").alias("mean"),
                    F.col("total").cast("double").alias("sum")).orderBy("plan_name")


def n4_tier_stats(s: DataFrame, pl: DataFrame) -> DataFrame:
    """Plan: subscriptions, mean price, share of all subscriptions (for the tier pie)."""
    g = _plan_price_stats(s, pl)
    total = F.sum("n").over(W.partitionBy(F.lit(1)))   # over the few plan rows
    return g.select("plan_name", F.col("n").cast("long").alias("subscriber_count"),
                    ratio("total", "price_n").alias("avg_price"),
                    ratio(F.col("n"), total).alias("share")).orderBy("plan_name")


TICKET_PRIORITY_COLUMNS = ("High", "Low", "Medium")   # crosstab column order (sorted)


def n4_ticket_xtab(t: DataFrame, priorities: Sequence[str] = TICKET_PRIORITY_COLUMNS) -> DataFrame:
    """Category x priority ticket counts, 0 where absent (explicit pivot values: one pass).

    A ticket with a NULL priority or one outside ``priorities`` counts under "other"; that
    column is only there when such tickets exist.
    """
    listed = F.when(F.col("priority").isin(*priorities), F.col("priority")).otherwise("other")
    wide = (t.withColumn("priority", listed).groupBy("category")
            .pivot("priority", [*priorities, "other"]).count().fillna(0))
    unlisted = t.where(F.col("priority").isNull() | ~F.col("priority").isin(*priorities))
    return (wide.drop("other") if unlisted.isEmpty() else wide).orderBy("category")


def prof_shape(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows, columns) for each table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count",
            F.lit(len(df.columns)).alias("column_count"))
        out = one if out is None else out.unionByName(one)
    return out


def cat_rowcounts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table, ordered by table name."""
    return prof_shape(tables).select("table_name", "row_count").orderBy("table_name")


# Values inside one quantile's bracket that the last step may order in one task.
REFINED_VALUES = 1_000_000


def _brackets(values: list[float] | None, probes: list[float], q: float, width: float) -> tuple[float, float]:
    """Approximate values at q -/+ width; the ends of the range reach to infinity."""
    low = float("-inf") if q - width <= 0 else values[probes.index(q - width)]
    high = float("inf") if q + width >= 1 else values[probes.index(q + width)]
    return low, high


def _probes(probs: Sequence[float], width: float) -> list[float]:
    return sorted({max(0.0, q - width) for q in probs} | {min(1.0, q + width) for q in probs})


def _exact(m: DataFrame, counts: dict[str, int], sketch: dict[str, list[float] | None],
           probs: Sequence[float], accuracy: int) -> dict[tuple[str, float], float | None]:
    """Exact linear-interpolated quantiles of the columns of ``m`` (a stored table).

    A sketch's values around a quantile bracket its exact ranks. One wide aggregate counts
    the values below and inside each bracket; while some bracket holds more than
    ``REFINED_VALUES`` values, a sketch of the values inside narrows it. Then only the
    values inside are unpivoted and counted by value, and a running count per bracket
    finds the two ranks. The same steps run at every size; a bracket that misses its
    ranks is an error, never a wrong number.
    """
    width = 5.0 / accuracy
    probes = _probes(probs, width)
    box = {(c, q): _brackets(sketch[c], probes, q, width) for c in counts for q in probs if counts[c]}
    ranks = {(c, q): (counts[c] - 1) * q for c, q in box}
    if not box:
        return {}
    keys = list(box)

    def inside(k):
        v = F.col(k[0])
        return v.isNotNull() & (v >= F.lit(box[k][0])) & (v <= F.lit(box[k][1]))

    while True:
        row = m.agg(*[F.coalesce(F.sum((F.col(k[0]) < F.lit(box[k][0])).cast("long")), F.lit(0)).alias(f"b{i}")
                      for i, k in enumerate(keys)],
                    *[F.coalesce(F.sum(inside(k).cast("long")), F.lit(0)).alias(f"n{i}")
                      for i, k in enumerate(keys)]).first()
        below = {k: row[f"b{i}"] for i, k in enumerate(keys)}
        held = {k: row[f"n{i}"] for i, k in enumerate(keys)}
        wide = [k for k in keys if held[k] > REFINED_VALUES and box[k][0] < box[k][1]]
        if not wide:
            break
        at = {k: [min(1.0, max(0.0, (r - below[k]) / held[k] + s)) for r, s in (
            (math.floor(ranks[k]), -width), (math.ceil(ranks[k]), width))] for k in wide}
        narrow = m.agg(*[F.percentile_approx(F.when(inside(k), F.col(k[0])), at[k], accuracy).alias(f"p{i}")
                         for i, k in enumerate(wide)]).first()
        new = {k: (box[k][0] if at[k][0] == 0 else narrow[f"p{i}"][0],
                   box[k][1] if at[k][1] == 1 else narrow[f"p{i}"][1]) for i, k in enumerate(wide)}
        if all(new[k] == box[k] for k in wide):
            break                                   # ties: few distinct values inside
        box.update(new)

    picked = F.array(*[F.when(inside(k), F.struct(F.lit(i).alias("i"), F.col(k[0]).alias("v")))
                       for i, k in enumerate(keys)])
    values = (m.select(F.explode(F.filter(picked, lambda x: x.isNotNull())).alias("x"))
              .groupBy("x.i", "x.v").agg(F.count(F.lit(1)).alias("n")))
    base = F.element_at(F.array(*[F.lit(int(below[k])) for k in keys]), F.col("i") + 1)
    lo = F.element_at(F.array(*[F.lit(int(math.floor(ranks[k]))) for k in keys]), F.col("i") + 1)
    hi = F.element_at(F.array(*[F.lit(int(math.ceil(ranks[k]))) for k in keys]), F.col("i") + 1)
    run = W.partitionBy("i").orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    spans = (values.withColumn("end", base + F.sum("n").over(run)).withColumn("start", F.col("end") - F.col("n")))

    def at_rank(r):
        return F.max(F.when((F.col("start") <= r) & (r < F.col("end")), F.col("v")))

    found = {r.i: r for r in spans.groupBy("i").agg(at_rank(lo).alias("lo"), at_rank(hi).alias("hi")).collect()}
    out = {}
    for i, k in enumerate(keys):
        r = found.get(i)
        if r is None or r.lo is None or r.hi is None:
            raise RuntimeError(f"quantile bracket of {k} missed its ranks; raise accuracy")
        out[k] = r.lo + (r.hi - r.lo) * (ranks[k] - math.floor(ranks[k]))
    return out


def _one_pass(m: DataFrame, cols: Sequence[str], probes: Sequence[float], accuracy: int):
    """Moments and a quantile sketch of every column, as one wide aggregate (one row)."""
    return m.agg(*[F.struct(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                            F.min(c).alias("min"), F.max(c).alias("max"),
                            F.percentile_approx(c, list(probes), accuracy).alias("pa")).alias(c)
                   for c in cols]).first()


def exact_quantiles(df: DataFrame, cols: Sequence[str],
                    probs: Sequence[float] = (0.25, 0.5, 0.75), *,
                    accuracy: int = 10_000) -> DataFrame:
    """(column_name, q, value): exact linear-interpolated quantiles (as pandas /
    quantile_cont) per column, without a global sort of the values. The input's numeric
    columns are stored once and read once per step."""
    m = freeze(df.select(*[F.col(c).cast("double").alias(c) for c in cols]))
    row = _one_pass(m, cols, _probes(probs, 5.0 / accuracy), accuracy)
    got = _exact(m, {c: row[c]["n"] for c in cols}, {c: row[c]["pa"] for c in cols}, probs, accuracy)
    return df.sparkSession.createDataFrame([(c, float(q), got[c, q]) for c, q in got],
                                           "column_name string, q double, value double")


def n3_describe(df: DataFrame, cols: Sequence[str], digits: int = 6, *,
                exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """pandas-style describe(): count, mean, std (sample), min, 25/50/75 %, max per
    column (one row per column; values rounded to ``digits`` decimals).

    The numeric columns are stored once. exact=True (default, equals pandas) adds the
    refinement of ``_exact``; exact=False gives the sketch's quantiles. The result, one row
    per column, is computed when this is called.
    """
    probs = (0.25, 0.5, 0.75)
    m = freeze(df.select(*[F.col(c).cast("double").alias(c) for c in cols]))
    probes = _probes(probs, 5.0 / accuracy) if exact else list(probs)
    row = _one_pass(m, cols, probes, accuracy)
    if exact:
        got = _exact(m, {c: row[c]["n"] for c in cols}, {c: row[c]["pa"] for c in cols}, probs, accuracy)
    else:
        got = {(c, q): v for c in cols if row[c]["n"] for q, v in zip(probs, row[c]["pa"])}
    data = [(c, row[c]["n"], row[c]["mean"], row[c]["std"], row[c]["min"],
             *[got.get((c, q)) for q in probs], row[c]["max"]) for c in cols if row[c]["n"]]
    names = ("mean", "std", "min", "p25", "p50", "p75", "max")
    out = df.sparkSession.createDataFrame(
        data, "column_name string, count long, " + ", ".join(f"{n} double" for n in names))
    return out.select("column_name", "count", *[pg_round(n, digits).alias(n) for n in names])
