"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lienflow.llm.common import stored


def connected(edges: DataFrame) -> DataFrame:
    """node and component (its least node) of every node of ``edges`` (a, b).

    Large stars and small stars take turns: every node is tied to the least node near it, until each component
    is one star.  The rows never outnumber the edges, and a node with many edges is only ever aggregated or joined,
    with a stored table, so that the runtime can split it.
    """
    pairs = stored(edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").filter("a != b").distinct(), "edges")
    seen = None
    while True:
        # Large star: the larger neighbours of a node are tied to its least neighbour.
        both = pairs.unionByName(pairs.selectExpr("b AS a", "a AS b"))
        least = both.groupBy("a").agg(F.min("b").alias("least")).selectExpr("a", "least(a, least) AS least")
        least = stored(least, "least")
        large = both.join(least, "a").filter("b > a").selectExpr("b AS a", "least AS b")
        # Small star: the smaller neighbours and the node itself are tied to the least of them.
        down = large.filter("a > b")
        least = stored(down.groupBy("a").agg(F.min("b").alias("least")), "least")
        small = down.join(least, "a").filter("b != least").selectExpr("b AS a", "least AS b")
        pairs = stored(small.unionByName(least.selectExpr("a", "least AS b")).distinct(), "edges")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    members = pairs.selectExpr("a AS node", "b AS component")
    return members.unionByName(pairs.selectExpr("b AS node", "b AS component").distinct())
