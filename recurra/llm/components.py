"""Connected components of a link table, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root): for every node of ``links`` (a, b), the smallest node it is linked to.

    Each round gives a node the smallest root among itself and its neighbours, then jumps
    to that root's root; rounds stop when no root changes. Every round is one combined
    aggregate over the links and is stored, so lineage stays short. A hub's links
    are reduced per task before they are shuffled, and the joins on a hub are plain joins
    that adaptive execution may split.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.filter("a <> b").distinct())
    # the first round needs no join: a node's root is its smallest neighbour or itself
    state = stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                   .select("node", F.least("node", "m").alias("root"), F.lit(True).alias("changed")))
    while not state.filter("changed").limit(1).isEmpty():
        near = (edges.join(state.select(F.col("node").alias("b"), "root"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        step = (state.select("node", F.col("root").alias("old")).join(near, "node")
                .withColumn("pick", F.least("old", "near")))
        jump = state.select(F.col("node").alias("pick"), F.col("root").alias("far"))
        state = stored(step.join(jump, "pick", "left")
                       .withColumn("root", F.least("pick", "far"))
                       .select("node", "root", (F.col("root") != F.col("old")).alias("changed")))
    return state.select("node", "root")
