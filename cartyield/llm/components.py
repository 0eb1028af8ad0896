"""Connected components of links between numbered nodes, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.workspace import Workspace


def _signature(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
    )


def components(edges: DataFrame, workspace: Workspace) -> DataFrame:
    """(node, root) of every node with a link; ``edges`` has bigint columns u and v.

    ``root`` is the smallest node reachable. Each round links the larger neighbours of a node, then
    its smaller ones, to the smallest neighbour, until only stars are left. Minima are aggregated and
    joined back, so a node with very many links is neither gathered nor windowed. Of the rounds' tables
    only the last is kept.
    """
    larger, smaller = F.greatest("u", "v"), F.least("u", "v")
    links = edges.filter("u <> v").select(larger.alias("u"), smaller.alias("v")).distinct()
    links = workspace.store(links, "links")
    before = _signature(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("_low"))
        low = F.least("_low", "u")
        stars = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), low.alias("v"))
        stars = workspace.store(stars.distinct(), "stars")
        workspace.discard("links")
        lowest = stars.groupBy("u").agg(F.min("v").alias("_low"))
        others = stars.join(lowest, "u").filter("v <> _low").select(F.col("v").alias("u"), F.col("_low").alias("v"))
        shrunk = others.unionByName(lowest.select("u", F.col("_low").alias("v"))).distinct()
        links = workspace.store(shrunk, "links")
        workspace.discard("stars")
        after = _signature(links)
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
