"""Connected components by alternating large and small stars.

Every step is an aggregate of minima (partial before the shuffle) and a join
that adaptive execution can split, so a node with a third of all links stays
spread. Each round is written to the shared folder; only its row count and
checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.llm.common import remove, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every greater neighbour of a node to the node's smallest neighbour or itself."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    """Row count and checksum of a set of links."""
    checked = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), checked).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) for every node that has a link.

    ``edges`` has columns u and v of one ordered type, in any direction, with
    repeats and self links allowed. Null ends and self links are no links. No
    links, no rows.
    """
    edges, old = written(edges.where("u != v").select("u", "v"), "links")
    before = None
    while True:
        edges, path = written(_small_star(_large_star(edges)), "links")
        # Nothing reads the round before any more.
        remove(edges.sparkSession, old)
        old, now = path, _state(edges)
        if now == before or now[0] == 0:
            break
        before = now
    # At rest every link leads from a node straight to its root.
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
