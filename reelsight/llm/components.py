"""Connected components of an edge table, by alternating stars.

Large-star links every larger neighbour of a node to the node's smallest
neighbour, small-star does the same for the smaller ones; the table shrinks
to one star per component after a number of rounds that grows with the
logarithm of the largest component.  Each round is two grouped minima and
two joins back; no component is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsight.llm.tables import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    if not large:
        both = both.where("v < u")
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    side = both.where("v > u") if large else both
    linked = side.join(low, "u")
    hung = linked.select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        # the node itself hangs under its smallest neighbour, too
        hung = hung.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return hung.where("a <> b").distinct()


def components(edges: DataFrame, tag: str = "cc", max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``edges`` (columns a, b; any order,
    repeats and loops allowed); root is the smallest node reachable.

    Empty edges give no rows.  Nulls in either column are left out.  Raises
    if the stars have not settled after ``max_rounds``."""
    e = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .where("a is not null and b is not null and a <> b").distinct(), f"{tag}-0")
    mark = None
    for i in range(1, max_rounds + 1):
        e = staged(_star(_star(e, True), False), f"{tag}-{i}")
        # settled: every node hangs under one node that hangs nowhere
        new = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(new) == mark:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        mark = tuple(new)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
