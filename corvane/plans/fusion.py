"""Reciprocal-rank fusion of two ranked tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def candidates(k: int, fusion_k: int | None = None) -> int:
    """How deep each side is searched."""
    if fusion_k is not None and fusion_k <= 0:
        raise ValueError("fusion_k must be positive")
    return max(5 * k, 50) if fusion_k is None else fusion_k


def fuse(dense: DataFrame, sparse: DataFrame, k: int = 5, rrf_k: int = 60, dense_weight: float = 1.0, sparse_weight: float = 1.0, digits: int | None = None) -> DataFrame:
    """(query_id, uid, score, dense_rank, sparse_rank, dense_score, sparse_score, rank); sides: query_id, uid, rank, score.

    A union and one aggregation in place of a full outer join. A uid that repeats in a list adds up and shows its last
    rank. Order: score, dense rank, sparse rank (absent ones last), uid.
    """
    if k <= 0 or rrf_k <= 0:
        raise ValueError("k and rrf_k must be positive")
    if min(dense_weight, sparse_weight) < 0 or dense_weight + sparse_weight <= 0:
        raise ValueError("weights must not be negative, nor both zero")
    sides = [side.where("uid is not null and trim(cast(uid as string)) != ''").select("query_id", "uid", "rank", "score", F.lit(name).alias("side"), F.lit(float(w)).alias("w")) for name, side, w in (("d", dense, dense_weight), ("s", sparse, sparse_weight))]
    both = sides[0].unionByName(sides[1])
    total = F.sum(F.col("w") / (F.lit(rrf_k) + F.col("rank")))
    last = lambda name: F.max(F.when(F.col("side") == name, F.struct("rank", "score")))
    summed = both.groupBy("query_id", "uid").agg((total if digits is None else F.round(total, digits)).alias("score"), last("d").alias("d"), last("s").alias("s"))
    order = (F.desc("score"), F.coalesce(F.col("d.rank"), F.lit(10**9)), F.coalesce(F.col("s.rank"), F.lit(10**9)), F.col("uid"))
    ranked = summed.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("query_id", "uid", "score", F.col("d.rank").alias("dense_rank"), F.col("s.rank").alias("sparse_rank"), F.col("d.score").alias("dense_score"), F.col("s.score").alias("sparse_score"), "rank")
