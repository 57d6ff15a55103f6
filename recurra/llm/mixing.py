"""Mixing sources to target weights, with DataFrame functions only.

One aggregate gives each source's size; a small window over the per-source rows gives the
targets; every document is then emitted floor(rate) times plus one hash-seeded Bernoulli
copy with the remaining fraction as its probability.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.llm.common import WORD_RE, freeze, text_of

#: Per-source plans of up to this many rows are broadcast; longer ones are joined by shuffle.
BROADCAST_SOURCES = 10_000


def text_size(col: str | Column) -> Column:
    """Number of words of a text (NULL: 0)."""
    return F.regexp_count(text_of(col), F.lit(WORD_RE)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[int], max_repeat: int) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Sources in code-point order, NULL last, take the weights in turn. All sizes together
    are shared by weight; a target stops at ``max_repeat`` times its source's size and the
    excess goes to the others by weight, until none is above. That fixed point is reached
    directly: with the sources ordered by cap / weight, the capped ones are a prefix, and
    the level (target per weight) of the rest is (total - caps of the prefix) / weights of
    the rest. The window holds one narrow row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    wts = F.array(*[F.lit(int(w)) for w in weights])
    turn = ((F.row_number().over(order) - 1) % len(weights)) + 1
    per = (per.withColumn("weight", F.element_at(wts, turn.cast("int")).cast("long"))
           .withColumn("cap", F.col("source_size") * max_repeat))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (per.withColumn("caps_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
           .withColumn("weights_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
           .withColumn("total", F.sum("source_size").over(whole))
           .withColumn("weights", F.sum("weight").over(whole)))
    level = ((F.col("total") - F.col("caps_before")).cast("double")
             / (F.col("weights") - F.col("weights_before")).cast("double"))
    per = per.withColumn("level", level)
    # the first source, in the order of the sums above, whose cap is not reached fixes the level
    # of itself and all after it (sources that tie on cap / weight are ordered by name)
    free = F.col("cap").cast("double") >= F.col("level") * F.col("weight")
    per = (per.withColumn("place", F.row_number().over(by_ratio))
           .withColumn("free_level", F.min_by("level", F.when(free, F.col("place"))).over(whole))
           .withColumn("target", F.least(F.col("cap").cast("double"),
                                         F.coalesce(F.col("free_level") * F.col("weight"),
                                                    F.col("cap").cast("double")))))
    return per.select("source", "source_size", "target")


def coin(seed: int, *cols: Column) -> Column:
    """Uniform number in [0, 1) from an MD5 of the seed and the columns (NULL as '~')."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("~")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def plan_copies(docs: DataFrame, *, weights: Sequence[int] = (5, 2, 1), max_repeat: int = 3,
                seed: int = 17, id_col: str = "doc_id", source_col: str = "source",
                text_col: str = "text") -> DataFrame:
    """One row per document: (row, size, source_size, target, copies); ``row`` is the input row.

    ``copies`` is floor(rate) plus one where the document's coin is below the fraction,
    rate = target / source_size (0 for a source without words). The coin comes from the id and
    the text, so reruns agree, rows without an id have coins of their own, and rows that repeat
    an id and its text are treated alike. Sources that tie on cap / weight are both capped or
    both share. Documents without words count 0 but are emitted at their
    source's rate. NULL sources form one source, the last. An empty table gives no rows.

    The text is read twice (sizes per source, then emission); between the two only the
    per-source table is stored. A hot source costs one combined row per task in the
    aggregate, and the emission needs no shuffle while the plan is small enough to be
    broadcast; beyond ``BROADCAST_SOURCES`` rows it is an ordinary join, where adaptive
    execution splits a hot source.
    """
    sized = docs.select(F.struct("*").alias("row"), F.col(source_col).alias("source"),
                        text_size(text_col).alias("size"))
    plan = freeze(source_targets(sized.select("source", "size"), weights, max_repeat)
                  .withColumnRenamed("source", "plan_source"))
    few = plan.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    joined = sized.join(F.broadcast(plan) if few else plan,
                        F.col("source").eqNullSafe(F.col("plan_source")))
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    whole = F.floor(rate)
    extra = (coin(seed, F.col(f"row.{id_col}"), F.md5(text_of(F.col(f"row.{text_col}")))) < rate - whole).cast("long")
    return joined.select("row", "size", "source_size", "target", (whole + extra).alias("copies"))


def mix(docs: DataFrame, **params) -> DataFrame:
    """The mixed corpus: each input row repeated by its number of copies, columns unchanged.

    Parameters and edge cases as in ``plan_copies``; a document with 0 copies is left out.
    """
    planned = plan_copies(docs, **params).filter("copies > 0")
    return (planned.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("row.*"))
