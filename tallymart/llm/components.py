"""Connected components of a graph of links, by alternating stars.

Each round points every node's neighbours at the least of them; the rounds end
when the links no longer change, each node then pointing at the least node of
its component.  Every round is written to the shared folder, so a lost executor
costs one round, and only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import forget, store


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """One row (node, root) per node with a link to another; root is the least node reachable.

    Rows with a null end or with equal ends are no links.  No links give no rows.
    """
    links = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u") != F.col("v"))
    links = store(links.distinct(), "links")
    seen = None
    while True:
        state = links.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("sum")
        ).first()
        if state == seen or not state["n"]:
            break
        seen = state
        before, links = links, store(_small_star(_large_star(links)), "links")
        forget(before)
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _large_star(links: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the least of the node and its neighbours."""
    both = links.union(links.select("v", "u")).distinct()
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (
        joined.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
    )
