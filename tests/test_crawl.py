"""The crawl over a few pages held in a table: modes, resume, errors, PDF and text content, manifests, CLI."""

import json

import pytest
from pyspark.sql import functions as F

from corvane import cli
from corvane.operators import fetch
from corvane.plans import crawl
from corvane.sources.crawl_store import CrawlStore, read_json
from tests.test_operators import _pdf_file

NOW = "2024-05-06T07:08:09+00:00"
LONG = " ".join(f"word{k}" for k in range(30))
PAGES = {
    "http://a.com/": f"<title>Home</title><p>{LONG}</p><a href='/b'>b</a> <a href='b#x'>b again</a><a rel='nofollow' href='/no'>n</a><a href='/doc.pdf'>p</a><a href='/note.txt'>t</a><a href='http://z.org/'>out</a><a href='/gone'>g</a><a href='/pic.png'>i</a>",
    "http://a.com/b": f"<title>B</title><p>other {LONG}</p><a href='/'>home</a><a href='/c'>c</a><a href='/moved'>m</a>",
    "http://a.com/c": "<p>short</p>",
}


def fetcher(spark, asked=None):
    sentence = "a line of many words that goes on and on until it is long enough to be kept in the end."
    bodies = {
        **{u: (u, 200, "text/html; charset=utf-8", t.encode()) for u, t in PAGES.items()}, "http://a.com/doc.pdf": ("http://a.com/doc.pdf", 200, "application/pdf", _pdf_file([f"{n} {sentence}" for n in ("First", "Second", "Third")])),
        "http://a.com/note.txt": ("http://a.com/note.txt", 200, "text/plain", b"  plain text \n"), "http://a.com/pic.png": ("http://a.com/pic.png", 200, "image/png", b"\x89PNG"), "http://a.com/moved": ("http://a.com/b", 200, "text/html", PAGES["http://a.com/b"].encode()),
    }

    def get(rows):
        if asked is not None:
            asked.extend(r.url for r in rows.select("url").collect())
        known = spark.createDataFrame([(u, *x, None, 1, 5) for u, x in bodies.items()], fetch.SCHEMA)
        other = rows.select("url").join(known.select("url"), "url", "left_anti").select("url", "url", F.lit(404), F.lit("text/html"), F.lit(None).cast("binary"), F.lit(None).cast("string"), F.lit(1), F.lit(3)).toDF(*known.columns)
        return known.join(rows.select("url"), "url", "left_semi").unionByName(other)

    return get


def setup(spark, folder, **more):
    domains = spark.createDataFrame([("a.com", [])], "domain string, prefixes array<string>")
    seeds = spark.createDataFrame([(0, "http://A.com"), (1, "not a url")], "ord long, url string")
    return crawl.Crawl(CrawlStore(spark, str(folder)), domains, seeds, **{"max_depth": 2, "now": NOW} | more)


def test_crawl_and_resume(spark, tmp_path):
    asked: list[str] = []
    run = setup(spark, tmp_path / "w", fetcher=fetcher(spark, asked))
    done = run.run()
    stats, store = done["stats"], run.store
    docs = {r.final_url: r for r in store.documents().collect()}
    assert set(docs) == {"http://a.com/", "http://a.com/b", "http://a.com/doc.pdf", "http://a.com/note.txt"} and stats["stored_docs"] == 4
    assert docs["http://a.com/"].title == "Home" and docs["http://a.com/note.txt"].text == "plain text" and docs["http://a.com/doc.pdf"].text.startswith("First a line") and docs["http://a.com/b"].crawl_time == NOW
    assert docs["http://a.com/"].metadata["parser"] == "html" and len(docs["http://a.com/"].metadata["raw_sha256"]) == 64 and docs["http://a.com/doc.pdf"].metadata["quality_mode"] == "strict"
    errors = {(r.stage, r.url): r for r in store.errors().collect()}
    assert errors["fetch", "http://a.com/gone"].message == "HTTP status 404" and errors["parse", "http://a.com/pic.png"].message == "Unsupported content kind: binary" and errors["parse", "http://a.com/c"].error_type == "Filtered text did not meet quality thresholds"
    assert len(errors) == stats["storage"]["error_rows"] == 3
    # nofollow and other domains' links are not asked for, the page behind a redirect is stored once
    assert sorted(asked) == sorted({"http://a.com/", "http://a.com/b", "http://a.com/doc.pdf", "http://a.com/note.txt", "http://a.com/gone", "http://a.com/pic.png", "http://a.com/c", "http://a.com/moved"})
    assert stats["fetched_ok"] == 7 and stats["fetched_error"] == 1 and stats["parsed_ok"] == 5 and stats["parsed_error"] == 2 and stats["custom_counters"] == {"parse_skipped_cached": 1}
    assert stats["fetch"]["status_code_counts"] == {"200": 7, "404": 1} and stats["fetch"]["by_backend"] == {"requests": {"ok": 7, "error": 1}} and stats["frontier"]["extra_status_counts"] == {"invalid": 1} and stats["frontier"]["snapshot"]["enqueued"] == 8
    assert stats["parse"]["by_content_kind"]["html"] == {"ok": 3, "error": 1} and read_json(spark, store.paths["crawl_stats"])["stored_docs"] == 4
    assert {r.url for r in store.visited().collect()} == set(asked) and {r.url: r.status_code for r in store.url_meta().collect()}["http://a.com/gone"] == 404
    assert store.cached(store.visited()).count() == 6

    # a second run has nothing new to do, unless it must download again
    asked.clear()
    again = setup(spark, tmp_path / "w", fetcher=fetcher(spark, asked)).run()["stats"]
    assert not asked and again["frontier_skipped_visited"] == 1 and store.documents().count() == 4
    forced = setup(spark, tmp_path / "w", fetcher=fetcher(spark, asked), force_download=True).run()["stats"]
    assert len(asked) == 8 and forced["stored_docs"] == 0 and forced["custom_counters"]["parse_skipped_cached"] == 5 and store.raw().count() == 6


def test_fetch_only_then_parse_only(spark, tmp_path):
    run = setup(spark, tmp_path / "w", fetcher=fetcher(spark))
    first = run.run("fetch_only")["stats"]
    assert first["fetched_ok"] == 7 and first["parsed_ok"] == 0 and run.store.documents().count() == 0
    second = setup(spark, tmp_path / "w").run(" Parse_Only ")["stats"]
    assert second["stored_docs"] == 4 and second["parsed_error"] == 2 and second["custom_counters"] == {"parse_only_candidate_urls": 6}
    third = setup(spark, tmp_path / "w").run("parse_only")["stats"]
    assert third["stored_docs"] == 0 and third["custom_counters"]["parse_skipped_cached"] == 4
    assert setup(spark, tmp_path / "w", force_parse=True).run("parse_only")["stats"]["stored_docs"] == 4
    with pytest.raises(ValueError):
        crawl.resolve_mode("other")
    assert crawl.parse_time("2024-01-01T00:00:00").isoformat() == "2024-01-01T00:00:00+00:00" and crawl.parse_time("x").tzinfo and crawl.parse_time("2024-01-01T02:00:00+02:00").hour == 0


def test_cached_content_is_not_fetched(spark, tmp_path):
    store = CrawlStore(spark, str(tmp_path / "w"))
    store.save_raw(spark.createDataFrame([("http://a.com/", "html", PAGES["http://a.com/"].encode())], "url string, kind string, body binary"))
    asked: list[str] = []
    stats = setup(spark, tmp_path / "w", fetcher=fetcher(spark, asked), max_depth=0).run()["stats"]
    assert not asked and stats["stored_docs"] == 1 and stats["custom_counters"] == {"fetch_cache_hits": 1} and stats["fetched_ok"] == 0
    store.save_raw(spark.createDataFrame([("http://a.com/", "html", b"new"), ("u", "pdf", b"1")], "url string, kind string, body binary"))
    assert {(r.url, bytes(r.body)) for r in store.raw().collect()} == {("http://a.com/", PAGES["http://a.com/"].encode()), ("u", b"1")}
    store.save_raw(spark.createDataFrame([("u", "pdf", b"2")], "url string, kind string, body binary"), overwrite=True)
    assert {(r.url, bytes(r.body)) for r in store.raw().collect()} == {("http://a.com/", PAGES["http://a.com/"].encode()), ("u", b"2")}


def test_pages_of_one_url_keep_their_rows(spark, tmp_path):
    """Two pages of one URL at two depths are two rows, each with its own policy."""
    from corvane.queries import QUERIES

    spark.createDataFrame([(1, "http://example.com/a"), (2, "http://example.com/a"), (3, "http://example.com/a"), (10, "http://x.org/")], "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {(r.page_id, r.backend) for r in QUERIES["fetch_policy"](spark, str(tmp_path)).collect()}
    assert got == {(1, "requests"), (2, "requests"), (3, "selenium"), (10, "requests")} and QUERIES["fetch_policy"](spark, str(tmp_path)).count() == 4


def test_network_policies(spark):
    def transport(url, headers=None):
        return url, 200, "text/plain", f"{url} {(headers or {}).get('User-Agent')}".encode()

    domains = spark.createDataFrame([("a.com", "selenium", 1), ("b.com", "selenium", None)], "domain string, backend string, selenium_max_depth int")
    rows = spark.createDataFrame([("http://a.com/0", 1, None), ("http://a.com/1", 2, None), ("http://b.com/", 9, None)], "url string, depth int, seed_url string")
    found = fetch.policies(rows, domains, pause=0.0, headers={"X": "1"}, agent="me")
    assert {r.url: r.backend for r in found.collect()} == {"http://a.com/0": "selenium", "http://a.com/1": "requests", "http://b.com/": "selenium"}
    got = {r.url: r for r in fetch.fetch(found, {"requests": transport}, 0).collect()}
    assert got["http://a.com/1"].body == b"http://a.com/1 me" and got["http://b.com/"].error == "backend_unavailable: selenium"
    table = fetch.from_table(spark.createDataFrame([("http://a.com/x", "X"), ("http://a.com/y", "Y")], "url string, html string"))
    answers = {r.url: (r.status_code, r.final_url) for r in table(spark.createDataFrame([("http://a.com/y",), ("http://a.com/q",), ("http://n.org/",)], "url string")).collect()}
    assert answers == {"http://a.com/y": (200, "http://a.com/y"), "http://a.com/q": (200, "http://a.com/x"), "http://n.org/": (404, "http://n.org/")}


def test_cli(spark, tmp_path, capsys):
    (tmp_path / "docs.jsonl").write_text("\n".join(json.dumps({"doc_id": str(k), "text": f"The number {k} fox jumps over dogs. Another sentence about apples number {k}.", "title": f"T{k}", "url": f"http://a.com/{k}"}) for k in range(6)))
    out = lambda: json.loads(capsys.readouterr().out.strip().split("\n")[-1])
    assert cli.main(["chunk", "--input", str(tmp_path / "docs.jsonl"), "--output", str(tmp_path / "c"), "--split-max-block-words", "9", "--split-overlap-sentences", "0", "--max-docs", "5"]) == 0
    said = out()
    assert (said["docs_input"], said["chunks_count"], said["rejected_count"]) == (5, 10, 0) and read_json(spark, str(tmp_path / "c/stats.json"))["config"]["max_block_words"] == 9
    chunks = str(tmp_path / "c/chunks.jsonl")
    assert cli.main(["index", "--input", chunks, "--output", str(tmp_path / "i")]) == 0 and out()["indexed_rows"] == 10
    assert cli.main(["embed", "--input", chunks, "--output", str(tmp_path / "e")]) == 0 and out()["storage"]["num_rows"] == 10
    both = ["--index", str(tmp_path / "i"), "--vectors", str(tmp_path / "e")]
    for mode, metric in (("sparse", "bm25"), ("dense", "cosine"), ("hybrid", "rrf")):
        assert cli.main(["search", "--query", "apples number 3", "--mode", mode, "--top-k", "2", *both]) == 0
        said = out()
        assert said["num_results"] == 2 and said["results"][0]["metric"] == metric and said["results"][0]["title"].startswith("T")
    (tmp_path / "q.json").write_text(json.dumps([{"id": "1", "question": "apples number 3"}, {"id": "2", "question": "fox 4"}]))
    for mode in ("sparse", "dense", "hybrid", "closed_book"):
        assert cli.main(["answer", "--queries", str(tmp_path / "q.json"), "--mode", mode, "--head", "who=me", "--max-queries", "1", *both]) == 0
        said = json.loads(capsys.readouterr().out)
        assert set(said) == {"who", "1"} and (said["1"] == "") == (mode == "closed_book")
    assert cli.main(["answer", "--queries", str(tmp_path / "q.json"), "--mode", "dense", "--index", str(tmp_path / "i")]) == 2
    assert "needs --vectors" in capsys.readouterr().err
    a = cli.parser().parse_args(["ask", "--mode", "sparse", *both])
    assert cli.ask(a, ["apples number 3\n", "\n", "Quit\n", "never\n"]) == {"answered": 1}
    assert json.loads(capsys.readouterr().out)["question"] == "apples number 3"
    a = cli.parser().parse_args(["crawl", "--output", str(tmp_path / "w"), "--seed", "http://a.com/", "--domain", "a.com=requests", "--max-depth", "1", "--per-seed-cap", "0", "--no-respect-robots"])
    said = cli.crawl(a, fetcher(spark))
    assert said["stored_docs"] == 4 and read_json(spark, said["paths"]["crawl_config"])["per_seed_cap"] is None and read_json(spark, said["paths"]["crawl_config"])["respect_robots"] is False
    with pytest.raises(ValueError):
        cli.domain_specs(["a.com=other"])
