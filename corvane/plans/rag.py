"""From questions to answers: search by mode, contexts, prompts, generator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import classify
from . import bm25, dense, fusion

# Modes and templates.
MODES = ("dense", "sparse", "hybrid", "closed_book")
CONTEXT = "[{rank}] (title: {title}; source: {url})\n{passage}"
PROMPT = "Question: {question}\n\nContext passages:\n{context_passages}\n\nAnswer:"
NO_CONTEXT = "[No retrieved context]"


def search(questions: DataFrame, k: int, mode: str, sparse_index: bm25.Bm25Index | None = None, corpus: DataFrame | None = None, vectors: DataFrame | None = None, fusion_k: int | None = None, rrf_k: int = 60, weights: tuple[float, float] = (1.0, 1.0), metric: str = "cosine", digits: int = 6) -> DataFrame:
    """(query_id, row_id, score, rank, dense_rank, sparse_rank, dense_score, sparse_score). questions: query_id, text;
    corpus: row_id, embedding; vectors: query_id, vector.

    Sparse lists are filled up to k with rows that no term matched, as a full ranking would be. Blank questions find
    nothing. A missing index or corpus is a ValueError.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if k <= 0:
        raise ValueError("k must be positive")
    if mode in ("sparse", "hybrid") and sparse_index is None:
        raise ValueError(f"{mode} search needs a sparse index")
    if mode in ("dense", "hybrid") and (corpus is None or vectors is None):
        raise ValueError(f"{mode} search needs vectors of the corpus and of the questions")
    none = [F.lit(None).cast(t).alias(n) for n, t in (("dense_rank", "int"), ("sparse_rank", "int"), ("dense_score", "double"), ("sparse_score", "double"))]
    asked = questions.where("trim(text) != ''")
    if mode == "closed_book":
        return questions.sparkSession.createDataFrame([], "query_id long, row_id long, score double, rank int").select("*", *none)
    if mode == "sparse":
        return bm25.search(sparse_index, asked, k, pad_zero_scores=True, digits=digits).select("query_id", "row_id", "score", "rank", *none)
    mine = vectors.join(asked.select("query_id"), "query_id", "left_semi")
    if mode == "dense":
        return dense.search_blocks(corpus, mine, k, metric, digits=digits).select("query_id", "row_id", "score", "rank", *none)
    deep = fusion.candidates(k, fusion_k)
    sides = (dense.search_blocks(corpus, mine, deep, metric, digits=digits), bm25.search(sparse_index, asked, deep, pad_zero_scores=True, digits=digits))
    return fusion.fuse(*(s.withColumnRenamed("row_id", "uid") for s in sides), k, rrf_k, *weights, digits=12).withColumnRenamed("uid", "row_id")


def retrieved(found: DataFrame, store: DataFrame) -> DataFrame:
    """(query_id, docs): each question's passages in order of rank: rank, chunk_uid, title, text, url, score, metadata.

    store: row_id and any of chunk_uid, title, text, url, metadata; what it lacks is null, a missing text is empty.
    """
    names = ("chunk_uid", "title", "text", "url", "metadata")
    filled = store.select("row_id", *(F.col(n).cast("string").alias(n) if n in store.columns else F.lit(None).cast("string").alias(n) for n in names))
    rows = found.join(filled, "row_id", "left")
    entry = F.struct("rank", F.coalesce(F.trim("chunk_uid"), F.lit("")).alias("chunk_uid"), "title", F.trim(F.coalesce("text", F.lit(""))).alias("text"), "url", F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("metadata", F.lit("{}")).alias("metadata"))
    return rows.groupBy("query_id").agg(F.array_sort(F.collect_list(entry)).alias("docs"))


def contexts(found: DataFrame, store: DataFrame, template: str = CONTEXT) -> DataFrame:
    """(query_id, context, passages): passages joined by blank lines, in order of rank. store: row_id, text, title, url."""
    rows = found.join(store, "row_id", "left")
    text, place = F.trim(F.coalesce("text", F.lit(""))), F.coalesce(F.nullif(F.trim("url"), F.lit("")), F.lit("unknown"))
    title = F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.lit("Untitled"))
    entry = T.fill(template, rank=F.col("rank").cast("string"), title=title, url=place, source=place, passage=text, text=text, chunk_uid=F.col("row_id").cast("string"), score=F.coalesce("score", F.lit(0.0)).cast("string"))
    listed = F.array_sort(F.collect_list(F.struct("rank", entry.alias("entry"), F.coalesce("text", F.lit("")).alias("text"))))
    return rows.groupBy("query_id").agg(listed.alias("x")).select("query_id", F.array_join(F.transform("x", lambda e: e["entry"]), "\n\n").alias("context"), F.transform("x", lambda e: e["text"]).alias("passages"))


def prompts(questions: DataFrame, found: DataFrame, store: DataFrame, template: str = PROMPT) -> DataFrame:
    """(query_id, prompt, passages) of every question; those without a passage get the placeholder."""
    joined = questions.join(contexts(found, store), "query_id", "left")
    context = F.coalesce(F.nullif(F.col("context"), F.lit("")), F.lit(NO_CONTEXT))
    return joined.select("query_id", T.fill(template, context_passages=context, question=F.col("text")).alias("prompt"), "passages")


def answer(questions: DataFrame, found: DataFrame, store: DataFrame, generator: Callable[[str, list[str]], str] = classify.first_sentence) -> DataFrame:
    return classify.generate(prompts(questions, found, store), generator).select("query_id", "answer")
