"""Fetching: pluggable transports, robots gate, retries with linear backoff, a pause for each host.

Rows are dealt by a salted host when hosts are few and large; a host's pause is then shared by its lanes. A row that
fails is a row with an error. Bodies leave the worker in batches of bounded size.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from urllib.parse import urlsplit
from urllib.robotparser import RobotFileParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import url as U
from .frontier import policy_of

SCHEMA = "url string, final_url string, status_code int, content_type string, body binary, error string, attempts int, elapsed_ms int"
_KINDS = (pa.string(), pa.string(), pa.int32(), pa.string(), pa.binary(), pa.string(), pa.int32(), pa.int32())
#: Bytes of bodies in one batch; a batch always holds at least one row.
BATCH_BYTES = 4 << 20

#: (final_url, status, content_type, body) of a URL and its request headers; raises on failure.
Transport = Callable[..., tuple[str, int, str, bytes]]


def http(timeout: float = 25.0) -> Transport:
    """The standard library's client; redirects are followed, error statuses are results."""

    def get(url: str, headers: Mapping[str, str] | None = None):
        from urllib.error import HTTPError
        from urllib.request import Request, urlopen

        try:
            with urlopen(Request(url, headers=dict(headers or {})), timeout=timeout) as found:
                return found.geturl(), found.status, found.headers.get("Content-Type"), found.read()
        except HTTPError as error:
            return error.geturl() or url, error.code, error.headers.get("Content-Type") if error.headers else None, error.read()

    return get


def http_robots(timeout: float = 25.0) -> Callable[[str], str | None]:
    """robots.txt of a scheme and host; None if there is none."""

    def get(site: str) -> str | None:
        _, status, _, body = http(timeout)(f"{site}/robots.txt")
        return body.decode("utf-8", "replace") if status == 200 else None

    return get


def is_terminal(status: int | None, error: str | None) -> bool:
    """No retry: a response that is neither an error nor 408, 429 or 5xx."""
    return not error and status is not None and status not in (408, 429) and status < 500


def ok(error: Column, status: Column, body: Column) -> Column:
    """Whether a fetch succeeded: no error, a status of 200 to 299, and a body."""
    return error.isNull() & F.coalesce(status.between(200, 299), F.lit(False)) & body.isNotNull()


def is_ok(rows: DataFrame) -> Column:
    return ok(rows["error"], rows["status_code"], rows["body"])


def robots_allow(robots: str | None, url: str, agent: str = "*") -> bool:
    """Open if there is no robots.txt or it can't be read."""
    if not robots:
        return True
    parser = RobotFileParser()
    try:
        parser.parse(robots.splitlines())
        return parser.can_fetch(agent, url)
    except Exception:
        return True


def _laid_over(below: Column, above: Column) -> Column:
    """One map over another."""
    return F.map_concat(F.map_filter(below, lambda k, _: ~F.map_contains_key(above, k)), above)


def policies(urls: DataFrame, domains: DataFrame, seeds: DataFrame | None = None, backend: str = "requests", pause: float = 0.2, respect_robots: bool = True, headers: Mapping[str, str] | None = None, agent: str = "*", keep: Sequence[str] = ()) -> DataFrame:
    """urls (url, depth, seed_url, and the columns to keep) with backend, pause, respect_robots, headers, wait_selector, wait_seconds in force.

    A seed's setting goes before its URL's domain's, that before the global one; headers are merged in the other order,
    and the agent's name is added if none is set. A browser backend with a greatest depth gives way to plain requests
    below it. domains: domain and any of the settings' columns; seeds: seed_url and any of them.
    """
    columns = {"backend": "string", "selenium_max_depth": "int", "rate_limit_seconds": "double", "respect_robots": "boolean", "headers": "map<string,string>", "selenium_wait_selector": "string", "selenium_wait_seconds": "double"}

    def whole(rows: DataFrame, key: str) -> DataFrame:
        return rows.select(key, *(F.col(c).cast(t).alias(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in columns.items()))

    own = whole(domains, "domain")
    found = policy_of(urls.select("url", "depth", "seed_url", *keep), own.select("domain", F.struct(*columns).alias("_d")))
    if seeds is not None:
        mine = whole(seeds, "seed_url").select(U.normalize(F.col("seed_url")).alias("seed_url"), F.struct(*columns).alias("_s"))
        found = found.join(mine.groupBy("seed_url").agg(F.first("_s").alias("_s")), "seed_url", "left")
    else:
        found = found.withColumn("_s", F.lit(None).cast(own.select(F.struct(*columns).alias("_d")).schema["_d"].dataType))
    d, s = F.col("_d"), F.col("_s")
    lowered = lambda p: F.when((p["backend"] == "selenium") & F.coalesce(F.col("depth") > p["selenium_max_depth"], F.lit(False)), "requests").otherwise(p["backend"])
    none = F.create_map().cast("map<string,string>")
    base = F.create_map(*(F.lit(x) for kv in (headers or {}).items() for x in kv)).cast("map<string,string>") if headers else none
    merged = base
    for more in (d["headers"], s["headers"]):
        merged = _laid_over(merged, F.coalesce(more, none))
    named = F.when(F.map_contains_key(merged, "User-Agent"), merged).otherwise(F.map_concat(merged, F.create_map(F.lit("User-Agent"), F.lit(agent))))
    return found.select(
        "url", "depth", "seed_url", "domain", F.coalesce(lowered(s), lowered(d), F.lit(backend)).alias("backend"), F.coalesce(s["rate_limit_seconds"], d["rate_limit_seconds"], F.lit(pause)).alias("pause"), F.coalesce(s["respect_robots"], d["respect_robots"], F.lit(respect_robots)).alias("respect_robots"),
        named.alias("headers"), F.coalesce(s["selenium_wait_selector"], d["selenium_wait_selector"]).alias("wait_selector"), F.coalesce(s["selenium_wait_seconds"], d["selenium_wait_seconds"]).alias("wait_seconds"), *keep,
    )


def fetch(urls: DataFrame, transport: Transport | Mapping[str, Transport], retries: int = 2, backoff: float = 1.0, pause: float = 0.0, robots: Callable[[str], str | None] | None = None, agent: str = "*", lanes: int = 1, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """A row for each URL, failures included. robots: text of robots.txt for a scheme and host.

    urls may carry backend, pause, respect_robots and headers, as `policies` gives them; transport is then looked up by
    backend. A backend without a transport is an error of the row.
    """
    by_backend = transport if isinstance(transport, Mapping) else None
    plain = not isinstance(transport, Mapping)

    def one(url: str, backend: str, wait: float, gate: bool, headers: dict, waits: dict, rules: dict):
        place = urlsplit(url or "")
        site = f"{place.scheme}://{place.netloc}"
        if not place.netloc:
            return url, None, None, None, None, "invalid_url: no host", 0, 0
        get = transport if plain else by_backend.get(backend)
        if get is None:
            return url, None, None, None, None, f"backend_unavailable: {backend}", 0, 0
        if robots and gate and site not in rules:
            try:
                rules[site] = robots(site)
            except Exception:
                rules[site] = None
        if robots and gate and not robots_allow(rules[site], url, headers.get("User-Agent", agent)):
            return url, None, None, None, None, "robots_denied: robots.txt", 0, 0
        for attempt in range(1, retries + 2):
            if wait and (left := waits.get(site, 0) - time.monotonic()) > 0:
                sleep(left)
            waits[site] = time.monotonic() + wait * lanes
            began = time.monotonic()
            try:
                final, status, kind, body = get(url, headers) if headers else get(url)
                row = (url, final, status, kind, body, None, attempt, int(1000 * (time.monotonic() - began)))
            except Exception as error:
                row = (url, None, None, None, None, f"{type(error).__name__}: {error}", attempt, int(1000 * (time.monotonic() - began)))
            if is_terminal(row[2], row[5]):
                break
            if attempt <= retries:
                sleep(backoff * attempt)
        return row

    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waits: dict = {}
        rules: dict = {}
        held, size = [], 0
        for batch in batches:
            for url, backend, wait, gate, headers in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                held.append(one(url, backend, wait, gate, dict(headers or ()), waits, rules))
                size += len(held[-1][4] or b"") + 200
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), _KINDS, strict=True)], names)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), _KINDS, strict=True)], names)

    given = lambda name, kind, value: (F.col(name) if name in urls.columns else F.lit(value)).cast(kind).alias(name)
    rows = urls.select("url", given("backend", "string", None), given("pause", "double", pause), given("respect_robots", "boolean", True), given("headers", "map<string,string>", None))
    dealt = rows.withColumns({"_host": U.host(F.col("url")), "_lane": F.pmod(F.xxhash64("url"), F.lit(lanes))}).repartition("_host", "_lane").drop("_host", "_lane")
    return dealt.mapInArrow(run, SCHEMA)


def from_table(pages: DataFrame, url: str = "url", body: str = "html", content_type: str = "text/html; charset=utf-8") -> Callable[[DataFrame], DataFrame]:
    """A fetcher that answers from a table instead of the network.

    A URL that no row has is sent on to its host's first URL in order; a host without rows gives status 404.
    """
    rows = pages.select(U.normalize(F.col(url)).alias("_url"), F.col(url).alias("_raw"), F.col(body).cast("binary").alias("_body"), U.host(F.col(url)).alias("_host")).where("_url is not null")
    known = rows.groupBy("_url").agg(F.min_by("_body", "_raw").alias("_body"))
    first = rows.groupBy("_host").agg(F.min("_url").alias("_to"))

    def get(urls: DataFrame) -> DataFrame:
        asked = urls.select("url").withColumn("_host", U.host(F.col("url")))
        aimed = asked.join(known.select(F.col("_url").alias("_exact")), F.col("url") == F.col("_exact"), "left").join(first, "_host", "left")
        found = aimed.select("url", F.coalesce("_exact", "_to").alias("_url")).join(known, "_url", "left")
        there = F.col("_url").isNotNull()
        return found.select("url", F.coalesce("_url", "url").alias("final_url"), F.when(there, 200).otherwise(404).alias("status_code"), F.when(there, content_type).alias("content_type"), "_body", F.lit(None).cast("string").alias("error"), F.lit(1).alias("attempts"), F.lit(0).alias("elapsed_ms")).withColumnRenamed("_body", "body")

    return get
