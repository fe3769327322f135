"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import cut_lineage


def _lowest(links: DataFrame) -> DataFrame:
    """(u, v, m): each link with the least of u and its neighbours. A node's
    links are counted down map-side first; the join back may be split by AQE,
    so a node with very many links is no single task's work."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
    return links.join(least, F.col("u") == F.col("n")).select("u", "v", "m")


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that ``links`` names; root is the least node
    of its component. Each round is cut by a checkpoint in the shared folder;
    the driver sees two numbers a round. Loops and repeated links are harmless;
    an empty table gives no rows."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges, seen = cut_lineage(edges), None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _lowest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        small = _lowest(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        stars = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            small.select("u", F.col("m").alias("v"))
        )
        edges = cut_lineage(stars.filter("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = now
