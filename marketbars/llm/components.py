"""Connected components of an edge list that may have any size, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars.llm.common import stored
from marketbars.session import ensure_checkpoint_dir, work_dir


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and an order-free digest of them."""
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())


def _least(edges: DataFrame) -> DataFrame:
    """Each node's smallest neighbour; stored, so that a hub's edges can be split in the join."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    return stored(least, work_dir(edges.sparkSession, "components"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both)
    return (
        both.filter("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.least("least", "u").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = _least(edges)
    others = edges.join(least, "u").filter("v != least").select(F.col("v").alias("u"), "least")
    return least.unionByName(others).withColumnRenamed("least", "v")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (u, v); the root is the component's least node.

    Each round is a few partially aggregated minima and joins, written to the checkpoint folder.
    The number of rounds grows with the logarithm of the longest path. Only a count and a digest
    of the edges reach the driver.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    down = edges.filter("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    held = down.distinct().checkpoint()
    mark = _mark(held)
    while mark[0]:
        held = _small_star(_large_star(held).distinct()).distinct().checkpoint()
        before, mark = mark, _mark(held)
        if mark == before:
            break
    stars = held.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(held.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
