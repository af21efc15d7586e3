"""Connected components of an edge table, by alternating star contractions; no neighbour list is ever gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, name: str = "components", most: int = 40) -> DataFrame:
    """(node, root) of every node with an edge; root is the least node of its component. edges: (u, v), any direction.

    Rounds end when an edge set repeats; each is written to the shared folder. Self-links and repeats are ignored.
    """
    now = stored(_small(edges), name)
    size = _mark(now)
    for _ in range(most):
        now = stored(_small(_large(now)), name)
        seen, size = size, _mark(now)
        if seen == size:
            break
    else:
        raise RuntimeError("the components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """Count and an order-free digest, two numbers."""
    row = edges.select(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
