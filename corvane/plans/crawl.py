"""A crawl as a loop over levels: admit, fetch or take from the cache, parse, store once, follow links.

Every level is a few plans over all its URLs; what a level fetched and parsed is written down once and read by all that
needs it. Modes: `crawl`; `fetch_only`, which stores content and follows links without parsing; `parse_only`, which
parses what is stored and follows nothing. A later run over the same folder goes on where the earlier one ended.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import UTC, datetime
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions import text as T
from ..functions import url as U
from ..operators import fetch, frontier, html, pdf, stats
from ..operators.pdf_text import pages_of
from ..sources.crawl_store import CrawlStore
from .storage import stored

MODES = ("crawl", "fetch_only", "parse_only")
PARSED = "url string, title string, text string, error string, parser string, links array<string>, metadata map<string,string>"


def resolve_mode(mode: str) -> str:
    name = str(mode).strip().lower()
    if name not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    return name


def utc_now() -> str:
    return datetime.now(UTC).isoformat(timespec="seconds")


def parse_time(value: str | None) -> datetime:
    """ISO time as UTC; times without a zone are UTC, what is none is now."""
    try:
        found = datetime.fromisoformat(value or "")
    except ValueError:
        return datetime.now(UTC)
    return found.replace(tzinfo=UTC) if found.tzinfo is None else found.astimezone(UTC)


def _pdf_pages(content: DataFrame, extractor: Callable[[bytes], list[str]]) -> DataFrame:
    """(url, page, text, failure): the pages of each PDF; a file that can't be read is a row without a page."""

    def run(batches):
        for batch in batches:
            rows = []
            for url, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    pages = extractor(body or b"")
                    rows += [(url, k, t or "", None) for k, t in enumerate(pages)] or [(url, None, None, None)]
                except Exception as error:
                    rows.append((url, None, None, f"PDF extraction failed: {type(error).__name__}: {error}"))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int32(), pa.string(), pa.string()))], ["url", "page", "text", "failure"])

    return content.select("url", "body").mapInArrow(run, "url string, page int, text string, failure string")


def parse(content: DataFrame, extractor: Callable[[str], str] = html.default_extractor, pdf_pages: Callable[[bytes], list[str]] = pages_of, min_chars: int | None = 60, min_words: int | None = 20) -> DataFrame:
    """PARSED rows of content (url, final_url, content_type, kind, body), each kind by its parser.

    Links are those of HTML pages, canonical and without repeats, in their order.
    """
    none = F.lit(None).cast("string")
    no_links, base = F.array().cast("array<string>"), F.coalesce("final_url", "url")
    about = lambda **more: F.create_map(*(F.lit(x) if k == 0 else x.cast("string") for name, c in more.items() for k, x in enumerate((name, c))))

    pages = content.where("kind = 'html'").select("url", base.alias("base"), html.decoded(F.col("body")).alias("html"))
    found = html.parse(pages, extractor, min_chars, min_words)
    links = F.array_distinct(F.filter(F.transform(U.links(F.col("html")), lambda h: U.resolve(F.col("base"), h)), lambda x: x.isNotNull()))
    from_html = found.select("url", "title", "text", "error", F.lit("html").alias("parser"), links.alias("links"), about(raw_chars=F.char_length("html"), clean_chars=F.char_length("raw_text"), word_count=html.word_count(F.col("raw_text")), links_found=F.size(links)).alias("metadata"))

    cut = stored(_pdf_pages(content.where("kind = 'pdf'"), pdf_pages), "pdf-pages")
    filtered = pdf.parse(cut.where("page is not null").select(F.col("url").alias("doc_id"), "page", "text"))
    counters = ("pages_total", "chunks_input", "chunks_kept", "dropped_boilerplate", "dropped_repeated", "dropped_quality", "dropped_duplicate", "clean_chars", "clean_words")
    good = filtered.select(F.col("doc_id").alias("url"), none.alias("title"), "text", "error", F.lit("pdf").alias("parser"), no_links.alias("links"), about(quality_mode=F.col("quality_mode"), **{c: F.col(c) for c in counters}).alias("metadata"))
    bad = cut.where("page is null").select("url", none.alias("title"), F.lit("").alias("text"), F.coalesce("failure", F.lit(pdf.EMPTY_ERROR)).alias("error"), F.lit("pdf").alias("parser"), no_links.alias("links"), F.create_map().cast("map<string,string>").alias("metadata"))

    kind = about(content_type=F.coalesce("content_type", F.lit("")))
    plain = F.regexp_replace(html.decoded(F.col("body")), r"^(?U)[\s\x1c-\x1f]+|(?U)[\s\x1c-\x1f]+$", "")
    from_text = content.where("kind = 'text'").select("url", none.alias("title"), plain.alias("text"), F.when(plain == "", "Empty plain-text body").alias("error"), F.lit("text").alias("parser"), no_links.alias("links"), kind.alias("metadata"))
    other = content.where("kind not in ('html', 'pdf', 'text')").select("url", none.alias("title"), F.lit("").alias("text"), F.concat(F.lit("Unsupported content kind: "), "kind").alias("error"), F.lit("unsupported").alias("parser"), no_links.alias("links"), kind.alias("metadata"))
    out = from_html
    for more in (good, bad, from_text, other):
        out = out.unionByName(more)
    return out


def parse_ok(rows: DataFrame | None = None):
    """Whether a parse succeeded: no error, and a text that is not blank."""
    return F.col("error").isNull() & (T.collapse(F.coalesce("text", F.lit(""))) != "")


def documents(fetched: DataFrame, parsed: DataFrame) -> DataFrame:
    """Document records of fetch rows (url, final_url, content_type, kind, body, fetched_at) joined with parse rows."""
    rows = fetched.join(parsed.where(parse_ok()), "url")
    target, digest = F.coalesce("final_url", "url"), F.sha2("body", 256)
    added = F.create_map(F.lit("content_length"), F.octet_length("body").cast("string"), F.lit("raw_sha256"), digest, F.lit("parser"), F.col("parser"))
    merged = F.map_concat("metadata", F.map_filter(added, lambda k, _: ~F.map_contains_key("metadata", k)))
    return rows.select(
        H.document_id(target, digest, F.col("text")).alias("doc_id"), "url", "final_url", "title", "text", "content_type", F.col("kind").alias("content_kind"), F.col("fetched_at").alias("crawl_time"), U.host(target).alias("source_domain"), merged.alias("metadata"), "ord",
    )


def _errors(rows: DataFrame, stage: str, url, message, metadata, now: str) -> DataFrame:
    return rows.select(
        F.lit(stage).alias("stage"), url.alias("url"), message.alias("message"), stats.error_type(message).alias("error_type"), F.lit(None).cast("string").alias("doc_id"), F.lit(None).cast("string").alias("referrer"), F.col("status_code").cast("int").alias("status_code"), F.lit(now).alias("created_at"), metadata.alias("metadata"),
    )


class Crawl:
    """One run. domains: domain and settings; seeds: ord, url; seed_policy: seed_url and settings.

    fetcher: from rows (url, depth, seed_url) to fetch.SCHEMA rows, as `fetch.from_table` gives one; by default the
    network. backends: which backend a row is counted under, as a column of (url, depth, seed_url) rows' policies.
    """

    def __init__(self, store: CrawlStore, domains: DataFrame, seeds: DataFrame, fetcher: Callable[[DataFrame], DataFrame] | None = None, max_depth: int = 1, global_cap: int | None = None, domain_cap: int | None = None, seed_cap: int | None = None, seed_policy: DataFrame | None = None, extractor: Callable[[str], str] = html.default_extractor, pdf_pages: Callable[[bytes], list[str]] = pages_of, force_download: bool = False, force_parse: bool = False, network: Mapping[str, Any] | None = None, now: str | None = None):
        self.store, self.domains, self.seeds, self.seed_policy = store, domains, seeds, seed_policy
        self.caps = {"global_cap": global_cap, "domain_cap": domain_cap, "seed_cap": seed_cap}
        self.max_depth, self.extractor, self.pdf_pages = max_depth, extractor, pdf_pages
        self.force_download, self.force_parse, self.now = force_download, force_parse, now or utc_now()
        self.network = {"timeout": 25.0, "retries": 2, "backoff": 1.0, "pause": 0.2, "respect_robots": True, "agent": "corvane", "headers": {}} | dict(network or {})
        self.fetcher = fetcher or self._from_network
        self.fetches: list[DataFrame] = []
        self.parses: list[DataFrame] = []
        self.custom: dict[str, int] = {}
        self.saved = self.error_rows = 0

    def _policies(self, rows: DataFrame) -> DataFrame:
        n = self.network
        return fetch.policies(rows, self.domains, self.seed_policy, "requests", n["pause"], n["respect_robots"], n["headers"], n["agent"])

    def _from_network(self, rows: DataFrame) -> DataFrame:
        n = self.network
        return fetch.fetch(self._policies(rows), {"requests": fetch.http(n["timeout"])} | dict(n.get("transports", {})), n["retries"], n["backoff"], robots=fetch.http_robots(n["timeout"]), agent=n["agent"])

    def _count(self, name: str, n: int) -> None:
        if n:
            self.custom[name] = self.custom.get(name, 0) + n

    def content(self, rows: DataFrame) -> DataFrame:
        """Fetch rows with kind, backend, fetched_at, from_cache, ord, depth, seed_url of every URL, written down."""
        about = self._policies(rows).select("url", "backend").join(rows.select("url", "ord", "depth", "seed_url"), "url")
        names = ("url", "final_url", "status_code", "content_type", "body", "error", "elapsed_ms", "from_cache")
        hit = None
        if not self.force_download:
            hit = self.store.cached(rows).select("url", F.col("url").alias("final_url"), F.lit(200).alias("status_code"), "content_type", "body", F.lit(None).cast("string").alias("error"), F.lit(None).cast("int").alias("elapsed_ms"), F.lit(True).alias("from_cache"))
        missing = rows if hit is None else rows.join(hit.select("url"), "url", "left_anti")
        got = self.fetcher(missing.select("url", "depth", "seed_url")).withColumn("from_cache", F.lit(False)).select(*names)
        every = got if hit is None else got.unionByName(hit)
        kind = U.content_kind(F.col("content_type"), F.coalesce("final_url", "url"))
        whole = stored(every.join(about, "url").withColumns({"kind": kind, "fetched_at": F.lit(self.now), "ok": fetch.ok(F.col("error"), F.col("status_code"), F.col("body"))}), "content")
        fresh = whole.where("not from_cache")
        meta = fresh.select("url", "final_url", "status_code", "content_type", F.octet_length("body").cast("long").alias("content_length"), F.sha2("body", 256).alias("body_sha256"), "backend", "fetched_at", "error")
        self.store.append_lines(meta, "url_meta")
        target = F.coalesce("final_url", "url")
        keep = fresh.where("ok").groupBy(target.alias("url"), "kind").agg(F.min_by("body", "ord").alias("body"))
        self.store.save_raw(keep, self.force_download)
        self.fetches.append(fresh.withColumn("content_length", F.octet_length("body").cast("long")).drop("body"))
        return whole

    def _store(self, content: DataFrame) -> DataFrame:
        """Parse, save new documents and all errors; returns the parse rows."""
        parsed = stored(parse(content.where("ok"), self.extractor, self.pdf_pages), "parsed")
        found = documents(content.where("ok"), parsed).withColumn("_target", F.coalesce("final_url", "url"))
        first = found.groupBy("_target").agg(F.min("ord").alias("ord"))
        new = found.join(first, ["_target", "ord"])
        if not self.force_parse:
            new = new.join(self.store.parsed().withColumnRenamed("url", "_target"), "_target", "left_anti")
        else:
            new = found
        new = stored(new.drop("_target", "ord"), "documents")
        count, good = new.count(), found.count()
        self._count("parse_skipped_cached", good - count)
        self.saved += count
        if count:
            self.store.append_lines(new, "parsed_docs")
        failed = content.where("ok").join(parsed.where(~parse_ok()).select("url", F.col("error").alias("_e"), "parser"), "url")
        self._save_errors(_errors(failed, "parse", F.coalesce("final_url", "url"), F.coalesce("_e", F.lit("Unknown parse failure")), F.create_map(F.lit("content_kind"), F.col("kind"), F.lit("parser"), F.col("parser")), self.now))
        self.parses.append(parsed.join(content.select("url", "kind"), "url").select("kind", "parser", "error", parse_ok().alias("ok"), F.char_length("text").alias("chars"), T.word_count(F.col("text")).alias("words"), F.size("links").alias("links")))
        return parsed

    def _save_errors(self, rows: DataFrame) -> None:
        rows = stored(rows, "errors")
        n = rows.count()
        if n:
            self.store.append_lines(rows, "parsed_errors")
        self.error_rows += n

    def run(self, mode: str = "crawl") -> dict[str, Any]:
        """The mode, the places, and the statistics, which are also written down."""
        mode, began = resolve_mode(mode), utc_now()
        front = None
        if mode == "parse_only":
            self._parse_only()
        else:
            front = self._levels(mode)
        summary = self.summary(front, began, utc_now())
        self.store.save_stats(summary)
        return {"mode": mode, "paths": self.store.paths, "stats": summary}

    def _levels(self, mode: str) -> frontier.Frontier:
        before = None if self.force_download else self.store.visited()
        front = frontier.Frontier(self.domains, self.max_depth, stored, seed_policy=self.seed_policy, initial_seen=before, **self.caps)
        new = front.push(self.seeds.select("ord", "url", F.lit(0).alias("depth"), F.col("url").alias("seed_url"), F.lit(None).cast("string").alias("referrer")))
        while new.take(1):
            self.store.append_visited(new.select("url"))
            content = self.content(new)
            self._count("fetch_cache_hits", content.where("from_cache").count())
            bad = content.where("not ok")
            message = F.coalesce("error", F.when(F.col("status_code").isNotNull(), F.concat(F.lit("HTTP status "), F.col("status_code").cast("string"))), F.lit("Unknown fetch failure"))
            self._save_errors(_errors(bad, "fetch", F.col("url"), message, F.create_map(F.lit("backend"), F.col("backend"), F.lit("final_url"), F.col("final_url")), self.now))
            if mode == "crawl":
                links = self._store(content).where(parse_ok()).select("url", "links")
            else:
                pages = content.where("ok and kind = 'html' and octet_length(body) > 0").select("url", F.coalesce("final_url", "url").alias("base"), html.decoded(F.col("body")).alias("html"))
                links = pages.select("url", F.array_distinct(F.filter(F.transform(U.links(F.col("html")), lambda h: U.resolve(F.col("base"), h)), lambda x: x.isNotNull())).alias("links"))
            open_pages = new.where("depth < max_depth").select("url", "depth", "seed_url", F.col("ord").alias("parent_ord")).join(content.select("url", F.coalesce("final_url", "url").alias("referrer")), "url")
            offered = open_pages.join(links, "url").select("parent_ord", "depth", "seed_url", "referrer", F.posexplode("links").alias("position", "link"))
            inside = frontier.in_scope(offered, front.domains.select("domain", "prefixes"), "link").where("in_scope")
            new = front.push_links(inside.select("parent_ord", "position", F.col("link").alias("url"), (F.col("depth") + 1).alias("depth"), "seed_url", "referrer"))
        return front

    def _parse_only(self) -> None:
        urls = stored(self.store.candidates(), "candidates")
        self._count("parse_only_candidate_urls", urls.count())
        rows = urls
        if not self.force_parse:
            rows = urls.join(self.store.parsed(), "url", "left_anti")
            self._count("parse_skipped_cached", urls.count() - rows.count())
        have = self.store.cached(rows)
        self._count("parse_only_missing_raw", rows.count() - have.count())
        numbered = frontier.number_rows(have, "url", "ord")
        content = stored(numbered.select("url", F.col("url").alias("final_url"), F.lit(200).alias("status_code"), "content_type", "body", F.lit(None).cast("string").alias("error"), "ord", U.content_kind(F.col("content_type"), F.col("url")).alias("kind"), F.lit(self.now).alias("fetched_at"), F.lit(True).alias("ok")), "content")
        self._store(content)

    def summary(self, front: frontier.Frontier | None, started: str, finished: str) -> dict[str, Any]:
        """Nested counters of the run."""
        return stats.crawl_summary(front.everything if front is not None else None, self.fetches, self.parses, self.saved, self.error_rows, self.custom, started, finished)


def run(store: CrawlStore, domains: DataFrame, seeds: DataFrame, mode: str = "crawl", **options: Any) -> dict[str, Any]:
    return Crawl(store, domains, seeds, **options).run(mode)
