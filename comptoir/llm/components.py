"""Connected components of a graph that stays distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.llm.shared import checkpointed
from comptoir.operators.joins import lookup


def components(links: DataFrame) -> DataFrame:
    """`node, component`, the smallest node that is reachable, for every node of a link between two nodes.

    `links` has `a, b` (long); order, repeats and links of a node to itself do not matter. Every round
    maps each node to the neighbour that comes first in a random order, this one's own first neighbour
    that is, and contracts the graph along the map: a hub is one node after two rounds, and a chain
    loses a share of its nodes in each. The maps are then followed from first to last. Each round is
    stored in the shared folder.
    """
    rest = checkpointed(links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    maps = []
    while not rest.isEmpty():
        both = rest.select("a", "b").union(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("id")))
        own = F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("id"))
        step = checkpointed(both.groupBy(F.col("a").alias("node")).agg(first.alias("first")).select(
            "node", F.least("first", own)["id"].alias("to")))
        near = checkpointed(step.join(step.select(F.col("node").alias("to"), F.col("to").alias("then")), "to").select(
            "node", F.col("then").alias("to")))
        maps.append(near)
        left = rest.join(near.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
        moved = left.join(near.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        rest = checkpointed(moved.where("x <> y").select(
            F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if not maps:
        return links.sparkSession.createDataFrame([], "node long, component long")
    out = maps[0].select("node", F.col("to").alias("component"))
    for later in maps[1:]:
        then = later.select(F.col("node").alias("component"), "to")
        out = out.join(then, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    least = out.groupBy("component").agg(F.min("node").alias("least"))
    return lookup(out, least, "component", "inner").select("node", F.col("least").alias("component"))
