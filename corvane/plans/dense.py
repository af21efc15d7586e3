"""Exact vector search over a table of queries: cosine, inner product, squared L2.

Blocks of queries of a bounded size are sent to the corpus; every task keeps its k best of each query, so only those are
shuffled. More than one block means more than one pass over the corpus, and each pass is written down before the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vector as V
from .storage import stored

METRICS = ("cosine", "ip", "l2")
#: Bytes of query vectors sent to the tasks at once, and of scores made at once.
QUERY_BYTES, SCORE_BYTES = 32 << 20, 64 << 20


def _matrix(column: pa.Array, dim: int | None = None) -> np.ndarray:
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(sizes) and ((sizes != sizes[0]).any() or dim not in (None, sizes[0])):
        raise ValueError("vectors are not all of one size")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(sizes), -1)


def _best(which: np.ndarray, names: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k best of each query, ties to the lower name."""
    order = np.lexsort((names, -scores, which))
    new = np.flatnonzero(np.concatenate([[True], which[order][1:] != which[order][:-1]]))
    place = np.arange(len(order)) - np.repeat(new, np.diff(np.append(new, len(order))))
    return order[place < k]


def search_blocks(corpus: DataFrame, queries: DataFrame, k: int = 5, metric: str = "cosine", normalize_query: bool = False, digits: int = 6) -> DataFrame:
    """(query_id, row_id, score, rank). corpus: row_id, embedding; queries: query_id, vector; ids are numbers.

    Scores are rounded to `digits`, ties go to the lower row_id. For l2 the score is the negative squared distance.
    Null vectors are left out; vectors of different sizes end the job.
    """
    if metric not in METRICS or k <= 0:
        raise ValueError("metric must be cosine, ip or l2, and k positive")
    q = queries.where("vector is not null").select(F.col("query_id").cast("long").alias("query_id"), (V.l2_normalize(F.col("vector")) if normalize_query and metric != "cosine" else F.col("vector")).alias("vector"))
    spark = corpus.sparkSession
    rows = corpus.where("embedding is not null").select(F.col("row_id").cast("long").alias("row_id"), "embedding")
    found, held, block, names = None, None, [], []

    def run_for(ids: np.ndarray, shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matrix = shared.value
            norms = (matrix * matrix).sum(1)
            which, kept, best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
            least = np.full(len(ids), -np.inf)
            for batch in batches:
                step = max(1, SCORE_BYTES // (8 * max(1, len(ids))))
                for a in range(0, batch.num_rows, step):
                    x, name = _matrix(batch.column(1).slice(a, step), matrix.shape[1]), batch.column(0).slice(a, step).to_numpy()
                    scores = x @ matrix.T
                    if metric == "cosine":
                        scores /= np.maximum(np.linalg.norm(x, axis=1), 1e-12)[:, None] * np.maximum(np.sqrt(norms), 1e-12)[None]
                    elif metric == "l2":
                        scores = 2 * scores - (x * x).sum(1)[:, None] - norms[None]
                    scores = np.round(scores, digits) + 0.0
                    floor = least if len(x) <= k else np.maximum(least, np.partition(scores, len(x) - k, axis=0)[len(x) - k])
                    at, col = np.nonzero(scores >= floor[None])
                    which, kept, best = np.concatenate([which, col]), np.concatenate([kept, name[at]]), np.concatenate([best, scores[at, col]])
                    chosen = _best(which, kept, best, k)
                    which, kept, best = which[chosen], kept[chosen], best[chosen]
                    full = np.bincount(which, minlength=len(ids)) >= k
                    low = np.full(len(ids), np.inf)
                    np.minimum.at(low, which, best)
                    least = np.where(full, low, -np.inf)
            yield pa.RecordBatch.from_arrays([pa.array(ids[which]), pa.array(kept), pa.array(best)], ["query_id", "row_id", "score"])

        return rows.mapInArrow(run, "query_id long, row_id long, score double")

    def flush() -> None:
        nonlocal found, held, block, names
        if held is not None:
            found = stored(found, "dense")
            held.unpersist()
        held = spark.sparkContext.broadcast(np.array(block, float).reshape(len(block), -1))  # of QUERY_BYTES at most
        part = run_for(np.array(names, np.int64), held)
        found = part if found is None else found.unionByName(part)
        block, names = [], []

    for row in q.toLocalIterator():
        if block and len(row[1]) != len(block[0]):
            raise ValueError("vectors are not all of one size")
        names.append(row[0])
        block.append(row[1])
        if len(block) * 8 * max(1, len(row[1])) >= QUERY_BYTES:
            flush()
    if block:
        flush()
    if found is None:
        return spark.createDataFrame([], "query_id long, row_id long, score double, rank int")
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "row_id"))).where(F.col("rank") <= k)


search = search_blocks


def last_token_pool(states: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The last token's state of each row: the last place if all rows are padded on the left, else by their lengths."""
    if mask[:, -1].all():
        return states[:, -1]
    return states[np.arange(len(states)), mask.sum(1) - 1]
