"""Run statistics: lengths, histograms, counts by key, keep rates, nested crawl counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bounds of the histograms of words in documents, blocks and chunks.
DOCUMENT_WORDS = (100, 250, 500, 1000, 2000, 4000, 8000)
BLOCK_WORDS = (20, 40, 80, 120, 150, 200, 300)
CHUNK_WORDS = (50, 100, 150, 200, 300, 400, 600)


def lengths(rows: DataFrame, **columns: Column) -> DataFrame:
    """(name, count, total, avg, min, max) of each numeric column in one pass; avg is 0 and min and max null if empty."""
    each = [F.struct(F.lit(n).alias("name"), F.count(c).alias("count"), F.coalesce(F.sum(c), F.lit(0)).cast("long").alias("total"), F.coalesce(F.avg(c), F.lit(0.0)).alias("avg"), F.min(c).cast("long").alias("min"), F.max(c).cast("long").alias("max")) for n, c in columns.items()]
    return rows.agg(F.array(*each).alias("x")).select(F.inline("x"))


def histogram_key(value: Column, bounds: Sequence[int]) -> Column:
    """Label of the first bound that is not exceeded, or the overflow."""
    out = F.when(value <= bounds[0], f"<= {bounds[0]}")
    for b in bounds[1:]:
        out = out.when(value <= b, f"<= {b}")
    return out.otherwise(f"> {bounds[-1]}")


def histogram(rows: DataFrame, value: Column, bounds: Sequence[int]) -> DataFrame:
    return rows.groupBy(histogram_key(value, bounds).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def domain_key(domain: Column) -> Column:
    return F.coalesce(F.nullif(F.lower(F.trim(domain)), F.lit("")), F.lit("unknown"))


def by_stage_and_domain(rows: DataFrame) -> DataFrame:
    """(stage, domain, n) for each stage, each domain and each pair, in one aggregation; the level not used is null."""
    return rows.groupingSets([["stage"], ["domain"], ["stage", "domain"]], "stage", "domain").agg(F.count(F.lit(1)).alias("n"))


def top_domains(rows: DataFrame, k: int = 10) -> DataFrame:
    return rows.groupBy(domain_key(F.col("domain")).alias("domain")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "domain").limit(k)


def rate(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def error_type(message: Column) -> Column:
    return F.when(F.instr(message, ":") > 0, F.nullif(F.trim(F.substring_index(message, ":", 1)), F.lit("")))


def crawl(rows: DataFrame) -> DataFrame:
    """Fetches by backend: ok, error, mean milliseconds, bytes. rows: backend, ok, elapsed_ms, content_length."""
    return rows.groupBy("backend").agg(
        F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("error"), F.coalesce(F.avg("elapsed_ms"), F.lit(0.0)).alias("avg_elapsed_ms"), F.coalesce(F.sum("content_length"), F.lit(0)).cast("long").alias("bytes"),
    )


def merge(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum of two tables of counters by key."""
    values = [c for c in first.columns if c not in keys]
    return first.unionByName(second).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in values))


def throughput(count: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, count / seconds).otherwise(F.lit(0.0))


#: How the frontier's statuses are folded into the counters of a crawl; the others are counted under their own names.
FOLDED = {"enqueued": "frontier_enqueued", "seen": "frontier_skipped_visited", "depth": "frontier_skipped_depth", "global_budget": "frontier_skipped_budget", "domain_budget": "frontier_skipped_budget", "seed_budget": "frontier_skipped_budget"}


def folded_status(status: Column) -> Column:
    """The counter that a frontier status is folded into."""
    out = F.when(F.lit(False), "")
    for name, counter in FOLDED.items():
        out = out.when(status == name, counter)
    return out.otherwise(status)


def failure_type(message: Column) -> Column:
    """What stands before the first colon of a message, or the message, or Unknown; null without a message."""
    head = F.trim(F.substring_index(message, ":", 1))
    return F.when(F.coalesce(message, F.lit("")) != "", F.coalesce(F.nullif(head, F.lit("")), F.lit("Unknown")))


def _tally(rows: DataFrame, key: Column) -> dict[str, int]:
    """Counts by key, nulls left out; keys are few."""
    return {str(r[0]): r[1] for r in rows.groupBy(key.cast("string").alias("k")).count().where("k is not null").collect()}


def _good_and_bad(rows: DataFrame, key: Column) -> dict[str, dict[str, int]]:
    return {str(r[0]): {"ok": r[1], "error": r[2]} for r in rows.groupBy(key.alias("k")).agg(F.count_if("ok"), F.count_if(~F.col("ok"))).collect()}


def _union(tables: Sequence[DataFrame]) -> DataFrame | None:
    out = None
    for t in tables:
        out = t if out is None else out.unionByName(t)
    return out


def fetch_totals(fetches: DataFrame) -> DataFrame:
    """One row of sums over fetches: ok, error, elapsed_ms total and samples, bytes."""
    return fetches.agg(
        F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("error"), F.coalesce(F.sum("elapsed_ms"), F.lit(0)).cast("long").alias("elapsed_ms_total"), F.count("elapsed_ms").alias("elapsed_ms_samples"), F.coalesce(F.sum("content_length"), F.lit(0)).cast("long").alias("bytes_total"),
    )


def parse_totals(parses: DataFrame) -> DataFrame:
    """One row of sums over parses: ok, error, characters, words, links."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return parses.agg(F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("error"), total("chars").alias("text_chars_total"), total("words").alias("text_words_total"), total("links").alias("links_total"))


def crawl_summary(everything: DataFrame | None, fetches: Sequence[DataFrame], parses: Sequence[DataFrame], stored_docs: int, error_rows: int, custom: Mapping[str, int], started_at: str, finished_at: str) -> dict[str, Any]:
    """Nested counters of a crawl.

    everything: the frontier's rows; fetches: backend, ok, status_code, error, kind, elapsed_ms, content_length; parses:
    kind, parser, ok, error, chars, words, links. Only counts by a few keys come to the driver.
    """
    from . import frontier

    statuses = _tally(everything, folded_status(F.col("status"))) if everything is not None else {}
    core = {name: statuses.pop(name, 0) for name in dict.fromkeys(FOLDED.values())}
    found, cut = _union(fetches), _union(parses)
    fetched = fetch_totals(found).first().asDict() if found is not None else {"ok": 0, "error": 0, "elapsed_ms_total": 0, "elapsed_ms_samples": 0, "bytes_total": 0}
    parsed = parse_totals(cut).first().asDict() if cut is not None else {"ok": 0, "error": 0, "text_chars_total": 0, "text_words_total": 0, "links_total": 0}
    seconds = max(0.0, (datetime.fromisoformat(finished_at) - datetime.fromisoformat(started_at)).total_seconds())
    per = lambda n: n / seconds if seconds > 0 else 0.0
    core |= {"fetched_ok": fetched.pop("ok"), "fetched_error": fetched.pop("error"), "parsed_ok": parsed.pop("ok"), "parsed_error": parsed.pop("error"), "stored_docs": stored_docs, "started_at": started_at, "finished_at": finished_at}
    return core | {
        "duration_seconds": seconds,
        "throughput": {"fetched_per_second": per(core["fetched_ok"] + core["fetched_error"]), "parsed_per_second": per(core["parsed_ok"] + core["parsed_error"]), "stored_docs_per_second": per(stored_docs)},
        "frontier": {"extra_status_counts": statuses, "snapshot": frontier.counters(everything).first().asDict() if everything is not None else {}},
        "fetch": {"by_backend": _good_and_bad(found, F.col("backend")) if found is not None else {}, "status_code_counts": _tally(found, F.col("status_code")) if found is not None else {}, "error_type_counts": _tally(found, failure_type(F.col("error"))) if found is not None else {}, "content_kind_counts": _tally(found, F.col("kind")) if found is not None else {}, **fetched, "elapsed_ms_avg": fetched["elapsed_ms_total"] / fetched["elapsed_ms_samples"] if fetched["elapsed_ms_samples"] else 0.0},
        "parse": {"by_content_kind": _good_and_bad(cut, F.col("kind")) if cut is not None else {}, "by_parser": _good_and_bad(cut, F.col("parser")) if cut is not None else {}, "error_type_counts": _tally(cut, failure_type(F.col("error"))) if cut is not None else {}, **parsed},
        "storage": {"error_rows": error_rows},
        "custom_counters": dict(custom),
    }


def merge_summaries(first: Mapping[str, Any], second: Mapping[str, Any]) -> dict[str, Any]:
    """The sum of two summaries, number by number; times, rates and means stay the first one's, a snapshot the last."""
    kept = {"started_at", "finished_at", "duration_seconds", "throughput", "elapsed_ms_avg"}
    out = dict(first)
    for key, value in second.items():
        if key in kept:
            continue
        if key == "snapshot":
            out[key] = dict(value) or out.get(key, {})
        elif isinstance(value, Mapping):
            out[key] = merge_summaries(out.get(key, {}), value)
        else:
            out[key] = out.get(key, 0) + value
    fetched = out.get("elapsed_ms_samples")
    if fetched is not None:
        out["elapsed_ms_avg"] = out["elapsed_ms_total"] / fetched if fetched else 0.0
    return out
