"""spark-submit entry: crawl, chunk, index, embed, search, answer and ask."""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import config
from .functions import hashing as H
from .functions import text as T
from .operators import chunking, classify
from .plans import bm25, crawl as crawling, dense, rag
from .plans.storage import stored
from .session import session
from .sources import readers
from .sources.crawl_store import CrawlStore, write_json

TASK = "Given a web search query, retrieve relevant passages that answer the query"
#: Words that end the loop of `ask`.
EXIT = ("exit", "quit", ":q")


def _lines(rows: DataFrame, path: str) -> None:
    """JSON lines, nulls included, keys in order."""
    rows.select(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def domain_specs(specs: Iterable[str]) -> list[dict]:
    """DOMAIN or DOMAIN=BACKEND."""
    out = []
    for spec in filter(None, map(str.strip, specs)):
        name, _, backend = spec.partition("=")
        if backend and backend.strip().lower() not in config.BACKENDS:
            raise ValueError(f"{spec}: a backend is one of {config.BACKENDS}")
        out.append({"domain": name.strip()} | ({"backend": backend.strip().lower()} if backend else {}))
    return out


def crawl_config(a) -> config.CrawlConfig:
    """The configuration file with the options laid over it; caps below one are none."""
    value = config.load_mapping(a.config) if a.config else {}
    if a.seed:
        value["seeds"] = list(a.seed)
        value.pop("seed_settings", None)
    if a.domain:
        value["domains"] = domain_specs(a.domain)
    for key in ("max_depth", "max_pages", "concurrency", "timeout_seconds", "retries", "retry_backoff_seconds", "rate_limit_seconds", "user_agent", "respect_robots"):
        if getattr(a, key) is not None:
            value[key] = getattr(a, key)
    for key in ("per_domain_cap", "per_seed_cap"):
        if getattr(a, key) is not None:
            value[key] = getattr(a, key) if getattr(a, key) > 0 else None
    for key in ("force_download", "force_parse"):
        if getattr(a, key):
            value[key] = True
    found = config.CrawlConfig.load(value)
    if not found.seeds:
        raise ValueError("a crawl needs a seed")
    return found


def crawl(a, fetcher=None) -> dict:
    """Fetch, parse and store pages from seeds on."""
    spark, settings = session("crawl"), crawl_config(a)
    store = CrawlStore(spark, a.output)
    store.save_config(config.to_mapping(settings))
    seeds, domains, policy = settings.tables(spark)
    network = {"timeout": settings.timeout_seconds, "retries": settings.retries, "backoff": settings.retry_backoff_seconds, "pause": settings.rate_limit_seconds, "respect_robots": settings.respect_robots, "agent": settings.user_agent, "headers": settings.default_headers}
    done = crawling.run(store, domains, seeds, a.mode, fetcher=fetcher, max_depth=settings.max_depth, global_cap=settings.max_pages, domain_cap=settings.per_domain_cap, seed_cap=settings.per_seed_cap, seed_policy=policy, force_download=settings.force_download, force_parse=settings.force_parse, network=network)
    core = {k: v for k, v in done["stats"].items() if not isinstance(v, dict)}
    return done if a.print_stats_json else {"mode": done["mode"], "paths": done["paths"], **core}


def chunk(a) -> dict:
    """Documents to chunks, rejects and statistics."""
    spark, began = session("chunk"), crawling.utc_now()
    value = config.load_mapping(a.config) if a.config else {}
    for key, given in (("max_block_words", a.split_max_block_words), ("overlap_sentences", a.split_overlap_sentences)):
        if given is not None:
            value = {k: v for k, v in value.items() if config.CHUNK_ALIASES.get(k, k) != key} | {key: given}
    settings = config.chunk_config(value)
    docs = readers.number_rows(readers.read_documents(spark, a.input, not a.strict), "doc_id", "doc_seq")
    predict = classify.label_column(classify.learn_labels(spark.read.parquet(a.labels))) if a.labels else None
    done = chunking.run_pipeline(stored(docs, "docs"), settings, predict, a.max_docs, stored)
    _lines(done.chunks, f"{a.output}/chunks.jsonl")
    _lines(chunking.reject_records(done.judged, done.marked, done.docs, settings, crawling.utc_now()), f"{a.output}/rejected.jsonl")
    stats = chunking.summary(done.docs, done.judged, done.marked, settings, began, crawling.utc_now())
    paths = {k: f"{a.output}/{n}" for k, n in (("chunks", "chunks.jsonl"), ("rejected", "rejected.jsonl"), ("stats", "stats.json"))}
    write_json(spark, stats | {"paths": paths}, paths["stats"])
    kept = ("docs_input", "docs_kept", "docs_rejected", "blocks_input", "blocks_kept", "blocks_rejected")
    return {"chunks_count": stats["chunks_output"], "rejected_count": stats["blocks_rejected"] + stats["chunks_rejected"], **{k: stats[k] for k in kept}, "paths": paths}


CHUNK = "chunk_id string, chunk_uid string, doc_id string, url string, title string, source_domain string, text string, metadata string"


def _chunks(spark, path: str, dedup_repeated_lines: bool, max_chunks: int | None) -> DataFrame:
    """Rows of chunks with row_id, chunk_uid and normalised text; rows without text are left out."""
    if max_chunks is not None and max_chunks <= 0:
        raise ValueError("max_chunks must be positive")
    rows = readers.read_jsonl(spark, path, CHUNK)
    uid = H.chunk_uid(F.col("chunk_uid"), F.col("chunk_id"), F.trim(F.coalesce("doc_id", F.lit(""))), F.trim("text"), F.trim(F.coalesce("title", F.lit(""))), F.trim(F.coalesce("url", F.lit(""))))
    clean = rows.withColumn("text", T.normalize_text(F.coalesce("text", F.lit("")), dedup_repeated_lines)).where("text != ''").withColumn("chunk_uid", uid)
    numbered = readers.number_rows(clean.select("chunk_uid", "title", "text", "url", "doc_id", "source_domain", "metadata"), ["chunk_uid", "text"])
    return stored(numbered if max_chunks is None else numbered.where(F.col("row_id") < max_chunks), "chunks")


def index(a) -> dict:
    """A sparse index over chunks, with its chunk store."""
    spark = session("index")
    settings = bm25.Settings(a.k1, a.b, a.epsilon, a.token_pattern, not a.keep_case, a.min_token_len, a.dedup_repeated_lines)
    rows = _chunks(spark, a.input, a.dedup_repeated_lines, a.max_chunks)
    counts = bm25.build_counts(rows, settings=settings).first().asDict()
    if not counts["indexed_rows"]:
        raise ValueError("no chunk has a token")
    rows.write.mode("overwrite").parquet(f"{a.output}/store")
    bm25.build(rows, k1=a.k1, b=a.b, epsilon=a.epsilon, pattern=a.token_pattern, lowercase=not a.keep_case, min_length=a.min_token_len, dedup_repeated_lines=a.dedup_repeated_lines).write(f"{a.output}/bm25")
    summary = counts | {"max_chunks": a.max_chunks, "bm25_params": {"k1": a.k1, "b": a.b, "epsilon": a.epsilon}, "tokenizer": {"pattern": a.token_pattern, "lowercase": not a.keep_case, "min_token_len": a.min_token_len, "dedup_repeated_lines": a.dedup_repeated_lines}, "paths": {"index": f"{a.output}/bm25", "store": f"{a.output}/store", "stats": f"{a.output}/bm25_stats.json"}}
    write_json(spark, summary, summary["paths"]["stats"])
    return summary


def embed(a) -> dict:
    """Vectors of chunks, with their row map and chunk store."""
    spark = session("embed")
    before = readers.count_lines(spark, a.input, None)
    rows = _chunks(spark, a.input, a.dedup_repeated_lines, a.max_chunks)
    vectors = stored(classify.encode(rows, F.col("text")), "vectors")
    first = vectors.select(F.size("embedding")).first()
    storage = readers.write_embedded(vectors, a.output, first[0] if first else 0)
    summary = {"input_rows": before, "embedded_rows": storage["num_rows"], "skipped_empty_text": None if before is None or a.max_chunks else before - storage["num_rows"], "failed_rows": 0, "max_chunks": a.max_chunks, "storage": storage}
    write_json(spark, summary, f"{a.output}/embed_stats.json")
    return summary


def _find(spark, questions: DataFrame, a, mode: str) -> tuple[DataFrame, DataFrame]:
    """(found, store) of questions (query_id, text) in a mode; both sides' rows meet by chunk_uid in hybrid search."""
    sparse = bm25.Bm25Index.read(spark, f"{a.index}/bm25") if mode in ("sparse", "hybrid") else None
    store = spark.read.parquet(f"{a.index}/store") if mode != "dense" and mode != "closed_book" else None
    if mode not in ("dense", "hybrid"):
        found = rag.search(questions, a.top_k, mode, sparse)
        return found, store if store is not None else spark.createDataFrame([], "row_id long, chunk_uid string, text string, title string, url string, metadata string")
    if not a.vectors:
        raise ValueError(f"{mode} search needs --vectors")
    vectors, payload = readers.read_embedded(spark, a.vectors)
    asked = classify.encode(questions, T.normalize_text(F.col("text")), as_query_task=TASK).select("query_id", F.col("embedding").alias("vector"))
    if mode == "dense":
        return rag.search(questions, a.top_k, mode, None, vectors, asked, metric=a.metric), payload
    # one number for a chunk on both sides: that of the sparse store
    same = payload.select(F.col("row_id").alias("_dense"), "chunk_uid").join(store.select("row_id", "chunk_uid"), "chunk_uid")
    aligned = vectors.join(same, F.col("_dense") == vectors["row_id"]).select(same["row_id"].alias("row_id"), "embedding")
    return rag.search(questions, a.top_k, mode, sparse, aligned, asked, a.fusion_top_k, a.rrf_k, (a.dense_weight, a.sparse_weight), a.metric), store


def search(a) -> dict:
    """The best chunks for one query."""
    spark = session("search")
    asked = spark.createDataFrame([(0, a.query)], "query_id long, text string")
    found, store = _find(spark, asked, a, a.mode)
    metric = {"sparse": "bm25", "hybrid": "rrf"}.get(a.mode, a.metric)
    rows = bm25.results(found, store, metric).orderBy("rank")
    drop = ["query_id", *(["text"] if a.no_text else []), *([] if a.mode == "hybrid" else ["dense_rank", "sparse_rank", "dense_score", "sparse_score"])]
    results = [r.asDict(recursive=True) for r in rows.drop(*drop).collect()]  # top_k rows
    return {"query": a.query, "mode": a.mode, "top_k": a.top_k, "num_results": len(results), "results": results}


def _answered(spark, questions: DataFrame, a, generator=classify.first_sentence) -> DataFrame:
    found, store = _find(spark, questions, a, a.mode)
    whole = store.select("row_id", "text", *(F.col(c) if c in store.columns else F.lit(None).cast("string").alias(c) for c in ("title", "url")))
    return rag.answer(questions, found, whole, generator)


def answer(a) -> str:
    """Answers to a file of questions, as one JSON object behind the given heads."""
    spark = session("answer")
    if a.max_queries is not None and a.max_queries <= 0:
        raise ValueError("max_queries must be positive")
    if any("=" not in pair for pair in a.head):
        raise ValueError("a head is KEY=VALUE")
    asked = readers.read_queries(spark, a.queries)
    asked = stored(asked if a.max_queries is None else asked.orderBy("ord").limit(a.max_queries), "questions")
    questions = asked.select(F.col("ord").alias("query_id"), F.col("question").alias("text"))
    if a.closed_book:
        a.mode = "closed_book"
    done = _answered(spark, questions, a).join(asked.select(F.col("ord").alias("query_id"), "id"), "query_id").orderBy("query_id")
    head = dict(pair.split("=", 1) for pair in a.head)
    return readers.answers_json(((r.id, r.answer) for r in done.toLocalIterator()), **head)


def ask(a, lines: Iterable[str] | None = None) -> dict:
    """Answer questions from standard input, a line each, until a blank word of leave or the end."""
    spark, n = session("ask"), 0
    for line in lines if lines is not None else sys.stdin:
        question = line.strip()
        if question.lower() in EXIT:
            break
        if question:
            n += 1
            row = _answered(spark, spark.createDataFrame([(0, question)], "query_id long, text string"), a).first()
            print(json.dumps({"question": question, "answer": row.answer, "mode": a.mode}, ensure_ascii=False), flush=True)
    return {"answered": n}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="corvane")
    top.add_argument("--log-level", default="INFO", choices=("DEBUG", "INFO", "WARNING", "ERROR"))
    sub = top.add_subparsers(dest="command", required=True)

    def add(run, **options):
        one = sub.add_parser(run.__name__, help=run.__doc__)
        one.set_defaults(run=run)
        for name, default in options.items():
            flag = "--" + name.replace("_", "-")
            if default is False:
                one.add_argument(flag, action="store_true")
            elif default is bool:
                one.add_argument(flag, action=argparse.BooleanOptionalAction, default=None)
            elif isinstance(default, tuple):
                one.add_argument(flag, choices=default, default=default[0])
            elif isinstance(default, list):
                one.add_argument(flag, action="append", default=[])
            elif isinstance(default, type):
                one.add_argument(flag, type=default, default=None)
            elif default is ...:
                one.add_argument(flag, required=True)
            else:
                one.add_argument(flag, type=type(default), default=default)

    look = {"index": "", "vectors": "", "top_k": 5, "metric": dense.METRICS, "fusion_top_k": int, "rrf_k": 60, "dense_weight": 1.0, "sparse_weight": 1.0}
    add(crawl, output=..., config=str, mode=crawling.MODES, seed=[], domain=[], max_depth=int, max_pages=int, per_domain_cap=int, per_seed_cap=int, concurrency=int, timeout_seconds=float, retries=int, retry_backoff_seconds=float, rate_limit_seconds=float, user_agent=str, respect_robots=bool, force_download=False, force_parse=False, print_stats_json=False)
    add(chunk, input=..., output=..., config=str, labels=str, strict=False, max_docs=int, split_max_block_words=int, split_overlap_sentences=int)
    add(index, input=..., output=..., k1=1.5, b=0.75, epsilon=0.25, token_pattern=T.TOKEN, keep_case=False, min_token_len=1, dedup_repeated_lines=False, max_chunks=int)
    add(embed, input=..., output=..., dedup_repeated_lines=False, max_chunks=int)
    add(search, query=..., mode=("sparse", "dense", "hybrid"), no_text=False, **look)
    add(answer, queries=..., mode=("sparse", "dense", "hybrid", "closed_book"), closed_book=False, max_queries=int, head=[], **look | {"top_k": 3})
    add(ask, mode=("sparse", "dense", "hybrid", "closed_book"), **look | {"top_k": 3})
    return top


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    logging.basicConfig(level=getattr(logging, a.log_level), format="%(asctime)s %(levelname)s [%(name)s] %(message)s")
    try:
        done = a.run(a)
    except ValueError as error:
        print(error, file=sys.stderr)
        return 2
    print(done if isinstance(done, str) else json.dumps(done, ensure_ascii=False, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
