"""Okapi BM25: index tables and batch search.

Index: postings(row_id, term, tf, dl), doclen(row_id, dl), terms(term, df, idf), the number of rows and their mean
length, and the tokenizer's settings, which a search takes from the index. The texts are read and cut once: a row's
terms are counted where the row is, and all else is summed from that table. Search scores a table of queries at once;
a query's own terms are few, so they are joined to terms and postings by term, and Spark picks a broadcast only if
their measured size allows it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..batches import bounded_batches, freed
from ..functions import text as T
from .storage import stored


@dataclass(frozen=True)
class Settings:
    """How texts and queries are cut, and the weights of the score."""

    k1: float = 1.5
    b: float = 0.75
    epsilon: float = 0.25
    pattern: str = T.TOKEN
    lowercase: bool = True
    min_length: int = 1
    dedup_repeated_lines: bool = False

    def __post_init__(self):
        if self.k1 < 0 or not 0 <= self.b <= 1 or self.epsilon < 0:
            raise ValueError("k1 and epsilon must not be negative, b must be within 0 and 1")
        if self.min_length <= 0:
            raise ValueError("min_length must be positive")
        try:
            re.compile(self.pattern)
        except re.error as error:
            raise ValueError(f"invalid token pattern {self.pattern!r}: {error}") from None

    def tokens(self, text: Column, query: bool = False) -> Column:
        return T.tokens(T.normalize_text(text, self.dedup_repeated_lines and not query), self.pattern, self.lowercase, self.min_length)


@dataclass(frozen=True)
class Bm25Index:
    postings: DataFrame
    doclen: DataFrame
    terms: DataFrame
    n: int
    avgdl: float
    settings: Settings = Settings()

    @property
    def meta(self) -> DataFrame:
        """One row: n, avgdl and the settings."""
        row = {"n": self.n, "avgdl": self.avgdl, **asdict(self.settings)}
        return self.postings.sparkSession.createDataFrame([tuple(row.values())], "n long, avgdl double, k1 double, b double, epsilon double, pattern string, lowercase boolean, min_length int, dedup_repeated_lines boolean")

    def write(self, path: str) -> None:
        for name in ("postings", "doclen", "terms", "meta"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    @staticmethod
    def read(spark, path: str) -> Bm25Index:
        tables = {name: spark.read.parquet(f"{path}/{name}") for name in ("postings", "doclen", "terms", "meta")}
        row = tables.pop("meta").first()
        if row is None:
            raise ValueError(f"{path} holds no index")
        row = row.asDict()
        return Bm25Index(**tables, n=row.pop("n"), avgdl=row.pop("avgdl"), settings=Settings(**row))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row_id, term, tf, dl) of rows of tokens, and a row without a term for each row that has tokens."""
    for batch in batches:
        lists = batch.column(1)
        sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        rows = np.repeat(np.arange(batch.num_rows), sizes)
        counted = pa.table([pa.array(rows), lists.flatten()], ["row", "term"]).group_by(["row", "term"]).aggregate([([], "count_all")])
        some = np.flatnonzero(sizes)
        at = np.concatenate([counted["row"].to_numpy(), some])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(at)), pa.concat_arrays([*counted["term"].cast(pa.string()).chunks, pa.nulls(len(some), pa.string())]), pa.array(np.concatenate([counted["count_all"].to_numpy(), np.zeros(len(some), np.int64)])), pa.array(sizes[at])],
            ["row_id", "term", "tf", "dl"],
        )
    batch = lists = counted = None
    freed()


def build(rows: DataFrame, key: str = "row_id", text: str = "text", k1: float = 1.5, b: float = 0.75, epsilon: float = 0.25, pattern: str = T.TOKEN, lowercase: bool = True, min_length: int = 1, dedup_repeated_lines: bool = False) -> Bm25Index:
    """Index of rows with unique keys; rows without tokens are left out of every count."""
    settings = Settings(k1, b, epsilon, pattern, lowercase, min_length, dedup_repeated_lines)
    bounded_batches(rows.sparkSession)
    kind = rows.schema[key].dataType.simpleString()
    counted = stored(rows.select(F.col(key).alias("row_id"), settings.tokens(F.col(text)).alias("tokens")).mapInArrow(_counted, f"row_id {kind}, term string, tf long, dl long"), "bm25")
    postings, doclen = counted.where("term is not null"), counted.where("term is null").select("row_id", "dl")
    n, avgdl = doclen.agg(F.count(F.lit(1)), F.avg("dl")).first()
    frequency = stored(postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select("term", "df", (F.log(F.lit(n) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)).alias("raw")), "bm25-terms")
    floor = (frequency.agg(F.avg("raw")).first()[0] or 0.0) * epsilon
    terms = frequency.select("term", "df", F.when(F.col("raw") >= 0, F.col("raw")).otherwise(F.lit(floor)).alias("idf"))
    return Bm25Index(postings, doclen, terms, n, avgdl or 0.0, settings)


def build_counts(rows: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row: input_rows, indexed_rows, skipped_empty_text, skipped_empty_tokens."""
    clean = T.normalize_text(F.coalesce(F.col(text), F.lit("")), settings.dedup_repeated_lines)
    tokens = F.size(T.tokens(clean, settings.pattern, settings.lowercase, settings.min_length))
    return rows.select((clean == "").alias("bare"), tokens.alias("n")).agg(F.count(F.lit(1)).alias("input_rows"), F.count_if(F.col("n") > 0).alias("indexed_rows"), F.count_if("bare").alias("skipped_empty_text"), F.count_if(~F.col("bare") & (F.col("n") == 0)).alias("skipped_empty_tokens"))


def search(index: Bm25Index, queries: DataFrame, k: int = 5, pad_zero_scores: bool = False, digits: int | None = None) -> DataFrame:
    """(query_id, row_id, score, rank): the k best rows of each query. queries: query_id, text.

    Repeated terms count again. pad_zero_scores fills up to k with the lowest row_ids that no term matched, for queries
    that have a token. digits: scores are rounded before they are ranked, for ties that do not hang on the order of a sum.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    settings = index.settings
    cut = queries.select("query_id", settings.tokens(F.col("text"), True).alias("tokens"))
    asked = cut.select("query_id", F.explode("tokens").alias("term")).groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qf"))
    # written down, so that its true size decides whether it is broadcast to the postings, which then stay where they are
    weighted = stored(asked.join(index.terms.select("term", "idf"), "term"), "asked")
    scored = index.postings.join(weighted, "term")
    tf, length = F.col("tf"), F.lit(1 - settings.b) + F.lit(settings.b) * F.col("dl") / F.lit(index.avgdl)
    gain = F.col("qf") * F.col("idf") * tf * (settings.k1 + 1) / (tf + settings.k1 * length)
    total = F.sum(gain)
    best = scored.groupBy("query_id", "row_id").agg((total if digits is None else F.round(total, digits)).alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "row_id"))
    top = best.withColumn("rank", rank).where(F.col("rank") <= k)
    if not pad_zero_scores:
        return top
    # the 2k lowest row_ids, a list in every query's row, are enough: at most k of them are matched
    lowest = [r[0] for r in index.doclen.select("row_id").orderBy("row_id").limit(2 * k).collect()]
    kind = index.doclen.schema["row_id"].dataType
    listed = F.array(*(F.lit(x).cast(kind) for x in lowest)) if lowest else F.array().cast(f"array<{kind.simpleString()}>")
    padding = cut.where(F.size("tokens") > 0).select("query_id", F.explode(listed).alias("row_id")).distinct()
    missing = padding.join(best.select("query_id", "row_id"), ["query_id", "row_id"], "left_anti")
    padded = top.select("query_id", "row_id", "score").unionByName(missing.select("query_id", "row_id", F.lit(0.0).alias("score")))
    return padded.withColumn("rank", rank).where(F.col("rank") <= k)


def with_payload(found: DataFrame, store: DataFrame, key: str = "row_id") -> DataFrame:
    """Left join of ranked rows with their payload; a missing payload leaves nulls."""
    return found.join(store, key, "left")


def results(found: DataFrame, store: DataFrame, metric: str = "bm25") -> DataFrame:
    """Ranked rows with their metric, for l2 the distance too, and their payload. store: row_id, chunk_uid, …"""
    named = found.withColumn("metric", F.lit(metric))
    if metric == "l2":
        named = named.withColumn("distance", -F.col("score"))
    return with_payload(named, store)
