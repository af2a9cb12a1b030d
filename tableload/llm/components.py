"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the links ``a``-``b`` (integers); root is the smallest
    node reachable.  Self links and repeated links are allowed; nulls are ignored; no links
    give an empty result.

    Each round points every node at the smallest neighbour it knows (first over larger
    neighbours, then over smaller ones), which halves paths; the links never multiply.
    Rounds go through the checkpoint folder, and only a count and a sum reach the driver.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")) \
        .where("u IS NOT NULL AND v IS NOT NULL AND u != v").distinct()
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    pairs = cut_lineage(pairs)
    nodes_seen = cut_lineage(nodes)
    before = _signature(pairs)
    while before[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(low.select("u", F.least("u", "m").alias("m")), "u").where("v > u AND v != m") \
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m") \
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = cut_lineage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        after = _signature(pairs)
        if after == before:
            break
        before = after
    return nodes_seen.join(pairs.groupBy("u").agg(F.min("v").alias("v")), nodes_seen["node"] == F.col("u"), "left") \
        .select("node", F.coalesce("v", "node").alias("root"))
