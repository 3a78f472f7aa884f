"""Connected components of a graph given as a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardstream.llm.common import pin


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component is named by its smallest node.

    Every round links each node's larger neighbours to its smallest one, then each node's smaller neighbours to the
    smallest of them, until nothing changes; the rounds grow with the logarithm of a component's diameter. Each
    round's links are written to the shared folder. Minima are taken before rows are shuffled, and the joins that
    follow them can be split where a node has very many links.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct()
    edges = pin(edges, "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.selectExpr("low as high", "high as low"))  # node, neighbour
        least = both.groupBy("high").agg(F.min("low").alias("least"))
        least = least.select("high", F.least("high", "least").alias("least"))
        large = both.join(least, "high").filter("low > high").selectExpr("low as high", "least as low")
        large = pin(large.filter("high <> low").distinct(), "stars")
        least = large.groupBy("high").agg(F.min("low").alias("least"))
        joined = large.join(least, "high")
        small = joined.filter("low <> least").selectExpr("low as high", "least as low")
        small = small.unionByName(least.selectExpr("high", "least as low")).distinct()
        edges, before = pin(small, "links"), state
        state = _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("low").alias("node")).distinct().selectExpr("node", "node as component")
    return edges.selectExpr("high as node", "low as component").unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    """A count and a checksum of the links: equal if nothing changed."""
    mixed = F.xxhash64("high", "low")
    return tuple(edges.agg(F.count("*"), F.sum(mixed.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftright(mixed, 32))).first())
