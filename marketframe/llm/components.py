"""Connected components of a distributed list of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import spill


def _nearest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = _nearest(both).select("u", F.least("u", "m").alias("m"))
    return both.join(near, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    near = _nearest(links)
    moved = links.join(near, "u").filter("v <> m")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        near.select("u", F.col("m").alias("v"))
    )


def _state(links: DataFrame) -> tuple:
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(links.agg(F.count("*"), mark).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the smallest node it reaches.

    Alternating large and small stars. A hub is aggregated before it is joined, and its joined rows
    are one per link, so no neighbour list is ever gathered; each round is a written table. Links
    to itself and repeated links count once; no links give no rows.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links = spill(links.filter("u <> v").distinct(), "links")
    state = _state(links)
    while state[0]:
        links = spill(_small_star(_large_star(links).distinct()).distinct(), "links")
        before, state = state, _state(links)
        if state == before:
            break
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(links.select("v", F.col("v").alias("w")).distinct().toDF("node", "root"))
