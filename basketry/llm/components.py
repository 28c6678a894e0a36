"""Connected components of a large sparse graph, as a few rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b); equal roots mean one component.

    Every node hooks onto its smallest neighbour if that is smaller; two look-ups shorten the chains. Then each
    component counts as one node and the edges between them are all that is left, so the graph shrinks by at least
    half of its linked nodes a round. Each round is written, so a lost executor costs one round at most.
    """
    left = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .where("a <> b").distinct(), "edges")
    found = None
    while found is None or not left.isEmpty():
        both = left.union(left.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root"))
        hooks = stored(hooks, "hooks")
        for _ in range(2):
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("top"))
            hooks = hooks.join(up, "root").select("node", F.col("top").alias("root"))
        hooks = stored(hooks, "hooks")
        of = lambda c: hooks.select(F.col("node").alias(c), F.col("root").alias(f"r{c}"))
        left = left.join(of("a"), "a").join(of("b"), "b").where("ra <> rb")
        left = stored(left.select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct(), "edges")
        if found is None:
            found = hooks
        else:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("top"))
            found = found.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return stored(found, "components")
