"""The corpus pipeline: language ID, SimHash near-dedup, benchmark decontamination, PII, byte-level BPE.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written as Parquet and read again as the next
stage's docs. All stages but the last return the columns of docs, extra ones too, whatever their names.

Null texts: no language, so the first stage drops them. Empty texts likewise. Rows without a doc_id: kept by the first
four stages, which judge a row by its text; the last one leaves them out. Repeated rows: all but one of a group of
copies go in the second stage, the smallest doc_id stays; rows that share a doc_id go or stay together there. Very long
texts are read whole. Empty tables give empty results. Ties: by name of language, by doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvane.llm import bpe, decontam, langid, pii, simhash
from corvane.llm.common import stored, table
from corvane.llm.queries import pattern, vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; the labels of all documents teach it."""
    return langid.keep_identified(docs, langid.learn(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of ids and of the decoded bytes."""
    return bpe.digests(docs, vocabulary("byte_bpe_50k.tiktoken"), pattern())


STAGES = [("language_id", language), ("simhash_near_dedup", near_copies), ("benchmark_decontamination", decontaminate), ("pii", personal_data), ("byte_bpe", tokens)]
#: SQL expresses neither fingerprint keys, tagger nor merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
