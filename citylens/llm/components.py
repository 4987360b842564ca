"""Connected components of an edge table, as repeated joins and minimum aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylens.llm.common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of bigint -> ``(node, root)``, root the smallest node reachable.

    Every round hooks each node's parent, and the node, to the smallest
    grandparent among its neighbours and then shortcuts to the grandparent;
    parents only fall, and a round without change means that neighbours agree.
    The rounds needed grow with the logarithm of the longest path.  Hot roots:
    minima combine map-side, and the joins have one row per key on one side, so
    AQE may split the other.  Nothing is collected but one count per round.
    """
    both = materialise(edges.where("u <> v").selectExpr("inline(array(struct(u, v), struct(v as u, u as v)))")
                       .distinct(), "edges")
    parent = materialise(both.groupBy("u").agg(F.min("v").alias("m"))
                         .select(F.col("u").alias("node"), F.least("u", "m").alias("p")), "parent")
    while True:
        up = parent.select(F.col("node").alias("p"), F.col("p").alias("g"))
        grand = materialise(parent.join(up, "p").select("node", "p", "g"), "grand")
        least = (both.join(grand.select(F.col("node").alias("v"), "g"), "v")
                 .groupBy("u").agg(F.min("g").alias("m")))
        hooked = grand.join(least.select(F.col("u").alias("node"), "m"), "node")
        offers = (hooked.select(F.col("p").alias("node"), F.col("m").alias("x"))
                  .union(hooked.select("node", F.least("m", "g").alias("x"))))
        lowest = offers.groupBy("node").agg(F.min("x").alias("x"))
        step = materialise(parent.join(lowest, "node")
                           .select("node", F.least("p", "x").alias("p"), (F.col("x") < F.col("p")).alias("fell")),
                           "parent")
        parent = step.select("node", "p")
        if step.where("fell").isEmpty():
            return parent.select("node", F.col("p").alias("root"))
