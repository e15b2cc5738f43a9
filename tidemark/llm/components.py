"""Connected components of an undirected graph by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


# A node's least neighbour is written before it meets the node's edges again: both sides of the
# join are then plain shuffles, whose large pieces Spark splits at run time, so the hub of a
# large component needs no single task.


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node points to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = staged(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    return (
        down.join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .filter("a <> b")
    )


def components(edges: DataFrame) -> DataFrame:
    """``node`` and the ``root`` (smallest node) of its component, for columns ``a``, ``b``.

    Nodes without an edge to another node are left out; loops, doubled and null edges are
    ignored. Large and small stars alternate until the edges no longer change; each round is
    written to the shared folder. Only two sums per round reach the driver.
    """
    edges = staged(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    seen = None
    while True:
        sums = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(sums) == seen:
            break
        seen = tuple(sums)
        large = staged(_large_star(edges).filter("a <> b").distinct(), "stars")
        edges = staged(_small_star(large).distinct(), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
