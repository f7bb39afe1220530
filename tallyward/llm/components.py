"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.session import materialize


def _linked_to_least(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Link each node's neighbours to the least node around it.

    Large-star looks at all neighbours and relinks those larger than the node,
    small-star looks at the smaller ones and relinks these and the node.
    """
    if larger_only:
        around = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = around.join(least, "a")
    if larger_only:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edge frame (a, b); component is the least node.

    Each step is two aggregations and joins on node ids, so a node with very
    many links is pre-aggregated before its shuffle and AQE may split its join.
    Every round is written to the shared folder. Ends when a round changes
    nothing: then every node points at the least node of its component.
    Null ends and loops are ignored; an empty frame gives an empty frame.
    """
    now = materialize(edges.select("a", "b").where("a != b").distinct(), "edges")
    state = None
    while True:
        stars = materialize(_linked_to_least(_linked_to_least(now, True), False), "stars")
        mark = stars.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if tuple(mark) == state:
            break
        now, state = stars, tuple(mark)
    members = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.union(stars.select("b", "b").distinct())
