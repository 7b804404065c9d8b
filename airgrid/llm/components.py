"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.session import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (u, v); root is the least node reached.

    Each round every node takes the least root among its neighbours, then its root's root.
    Rounds are written, so a lost executor costs one round at most; they end when nothing
    changes. A node with very many links is summed map-side.
    """
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    edges = stored(both.where("u <> v").distinct(), "links")
    roots = stored(
        edges.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("root")), "roots"
    )
    while True:
        seen = edges.join(roots.select(F.col("node").alias("v"), "root"), "v")
        near = seen.groupBy(F.col("u").alias("node")).agg(F.min("root").alias("near"))
        lower = roots.join(near, "node").select("node", "root", F.least("root", "near").alias("low"))
        lower = stored(lower, "roots")
        jump = lower.select(F.col("node").alias("low"), F.col("low").alias("lowest"))
        new = stored(lower.join(jump, "low").select("node", F.col("lowest").alias("root"), (F.col("lowest") != F.col("root")).alias("moved")), "roots")
        roots = new.select("node", "root")
        if not new.where("moved").limit(1).count():
            return roots
