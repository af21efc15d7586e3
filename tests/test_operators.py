import importlib.util
import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane import config
from corvane.operators import chunking, classify, fetch, frontier, html, pdf, pdf_text, stats
from corvane.plans import bm25, dense, fusion, rag
from corvane.plans.storage import stored
from corvane.sources import readers
from corvane.streaming import ingest


def test_pack():
    words = lambda n, c: " ".join([c] * n)
    assert chunking.pack([words(3, "a"), words(2, "b")], 5) == ["a a a b b"]
    assert chunking.pack([words(3, "a"), words(3, "b")], 5, 1) == ["a a a", "b b b"]
    assert chunking.pack([words(4, "a"), words(1, "b"), words(4, "c")], 5, 1) == ["a a a a b", "b c c c c"]
    assert chunking.pack([words(2, "a"), words(12, "b"), words(1, "c")], 5, 1) == ["a a", words(5, "b"), words(5, "b"), words(2, "b"), "c"]
    assert chunking.pack([], 5) == []


def test_chunk_pipeline(spark):
    docs = spark.createDataFrame([(0, "a", "One two. Three."), (1, "b", "one TWO. three."), (2, "a", "| | | x"), (3, "c", ""), (4, "d", None)], "doc_seq long, doc_id string, text string")
    done = chunking.run_pipeline(docs)
    assert [(r.doc_seq, r.text, r.chunk_index) for r in done.marked.where("is_emitted").collect()] == [(0, "One two. Three.", 0)]
    rejected = chunking.rejects(done.judged, done.marked)
    assert sorted((r.stage, r.doc_seq, r.reason.split(":")[0]) for r in rejected.collect()) == [("block", 2, "pipe_token_fraction_above_threshold"), ("chunk", 1, "duplicate_chunk_text")]
    with pytest.raises(ValueError):
        chunking.ChunkConfig(max_block_words=0)


def test_bm25_padding_and_errors(spark):
    rows = spark.createDataFrame([(0, "red fox"), (1, "blue"), (2, "red red"), (3, "")], "row_id long, text string")
    index = bm25.build(rows)
    asked = spark.createDataFrame([(9, "red unknown red")], "query_id long, text string")
    plain = bm25.search(index, asked, 3).collect()
    assert {r.row_id for r in plain} == {0, 2}
    padded = {r.row_id: r.score for r in bm25.search(index, asked, 3, pad_zero_scores=True).collect()}
    assert set(padded) == {0, 1, 2} and padded[1] == 0.0
    with pytest.raises(ValueError):
        bm25.search(index, asked, 0)


def test_bm25_index_round_trip(spark, tmp_path):
    index = bm25.build(spark.createDataFrame([(0, "a b"), (1, "b c")], "row_id long, text string"), k1=1.2)
    index.write(str(tmp_path))
    again = bm25.Bm25Index.read(spark, str(tmp_path))
    assert again.settings.k1 == 1.2 and again.postings.count() == 4


def test_dense_blocks_equal_builtin(spark):
    rows = spark.createDataFrame([(k, [float(k % 3), 1.0 + k]) for k in range(9)] + [(9, [0.0, 0.0])], "row_id long, embedding array<double>")
    asked = spark.createDataFrame([(0, [1.0, 0.5]), (1, [0.0, 0.0])], "query_id long, vector array<double>")
    for metric in dense.METRICS:
        a, b = (sorted((r.query_id, r["rank"], r.row_id, r.score) for r in f(rows, asked, 4, metric).collect()) for f in (dense.search, dense.search_blocks))
        assert a == b
    assert dense.search(rows, asked, 99).count() == 20


def test_fusion(spark):
    side = lambda rows: spark.createDataFrame(rows, "query_id long, uid string, rank int, score double")
    d, s = side([(0, "a", 1, 0.9), (0, "b", 2, 0.8), (0, "b", 3, 0.7), (0, " ", 4, 0.1)]), side([(0, "c", 1, 5.0), (0, "a", 2, 4.0)])
    got = {r.uid: r for r in fusion.fuse(d, s, 5).collect()}
    assert set(got) == {"a", "b", "c"} and got["b"].dense_rank == 3 and got["a"].score == pytest.approx(1 / 61 + 1 / 62)
    assert got["b"].score == pytest.approx(1 / 62 + 1 / 63) and got["c"].dense_rank is None
    assert fusion.candidates(3) == 50 and fusion.candidates(3, 7) == 7
    with pytest.raises(ValueError):
        fusion.fuse(d, s, 5, dense_weight=0, sparse_weight=0)


def _graph(spark):
    edges = [("http://a.com/", 0, "http://a.com/1"), ("http://a.com/", 1, "http://a.com/2"), ("http://a.com/1", 0, "http://a.com/"), ("http://a.com/1", 1, "http://b.com/x"), ("http://a.com/2", 0, "http://a.com/3"), ("http://a.com/2", 1, "http://a.com/4")]
    return spark.createDataFrame([(0, "http://A.com"), (1, "bad"), (2, "http://a.com/#x")], "ord long, url string"), spark.createDataFrame(edges, "from_url string, position int, to_url string"), spark.createDataFrame([("a.com", [])], "domain string, prefixes array<string>")


def test_frontier(spark):
    seeds, edges, domains = _graph(spark)
    all_rows = frontier.expand(seeds, edges, domains, 2, stored).collect()
    assert {(r.url, r.depth) for r in all_rows if r.status == "enqueued"} == {("http://a.com/", 0), ("http://a.com/1", 1), ("http://a.com/2", 1), ("http://a.com/3", 2), ("http://a.com/4", 2)}
    assert {r.status for r in all_rows if r.url is None} == {"invalid"}
    assert {r.status for r in all_rows if r.url == "http://b.com/x"} == {"scope"} and {r.status for r in all_rows if r.url == "http://a.com/" and r.depth > 0} == {"seen"}
    capped = frontier.expand(seeds, edges, domains, 2, stored, global_cap=4, domain_cap=3).collect()
    assert [r.url for r in sorted((r for r in capped if r.status == "enqueued"), key=lambda r: r.depth)] == ["http://a.com/", "http://a.com/1", "http://a.com/2"]
    assert "domain_budget" in {r.status for r in capped}
    assert {r.status for r in frontier.expand(seeds, edges, domains, 2, stored, seed_cap=2).collect()} >= {"seed_budget", "seen"}


def test_frontier_goes_deep(spark):
    """A chain of pages, each with a few links; numbers are given anew at every level."""
    edges = [(f"http://a.com/{k}", p, f"http://a.com/{k + 1}" if p == 3 else f"http://a.com/{k}-{p}") for k in range(9) for p in range(4)]
    seeds = spark.createDataFrame([(77_000, "http://a.com/0")], "ord long, url string")
    rows = frontier.expand(seeds, spark.createDataFrame(edges, "from_url string, position int, to_url string"), spark.createDataFrame([("a.com", [])], "domain string, prefixes array<string>"), 8, stored).collect()
    assert {r.url: r.depth for r in rows}["http://a.com/8"] == 8 and len(rows) == 1 + 8 * 4 and {r.status for r in rows} == {"enqueued"}
    assert [r.ord for r in sorted(rows, key=lambda r: (r.level, r.ord)) if r.level == 3] == [0, 1, 2, 3]


def test_frontier_policies(spark):
    seeds, edges, domains = _graph(spark)
    more = spark.createDataFrame([("http://a.com/", 1, None)], "seed_url string, max_depth int, max_pages long")
    assert {r.depth for r in frontier.expand(seeds, edges, domains, 5, stored, seed_policy=more).collect()} == {0, 1}
    own = domains.withColumn("max_pages", F.lit(2).cast("long"))
    rows = frontier.expand(seeds, edges, own, 5, stored, domain_cap=100).collect()
    assert sum(r.status == "enqueued" for r in rows) == 2 and "domain_budget" in {r.status for r in rows}
    seen = spark.createDataFrame([("http://A.com/1#top",), ("bad",)], "url string")
    rows = frontier.expand(seeds, edges, domains, 5, stored, initial_seen=seen).collect()
    assert {r.status for r in rows if r.url == "http://a.com/1"} == {"seen"}
    # a global cap alone is settled without one ordered pass
    rows = frontier.expand(seeds, edges, domains, 5, stored, global_cap=2).collect()
    assert {r.url for r in rows if r.status == "enqueued"} == {"http://a.com/", "http://a.com/1"} and {r.status for r in rows if r.url == "http://a.com/2"} == {"global_budget"}
    counted = frontier.counters(frontier.expand(seeds, edges, domains, 2, stored)).first()
    assert (counted.enqueued, counted.skipped_invalid, counted.skipped_out_of_scope, counted.accepted_seed_count) == (5, 1, 1, 1)
    assert {r.domain: r.n for r in frontier.accepted_by(frontier.expand(seeds, edges, domains, 2, stored), "domain").collect()} == {"a.com": 5}
    urls = spark.createDataFrame([(0, "http://a.com/x"), (1, "HTTP://a.com/x/#y"), (2, "http://z.org/"), (3, None)], "ord long, url string")
    assert [tuple(r) for r in frontier.filter_in_scope(urls, domains, "ord").collect()] == [(0, "http://a.com/x")]
    assert [r.url for r in frontier.sorted_distinct([urls, urls.limit(2)]).collect()] == sorted({"http://a.com/x", "HTTP://a.com/x/#y", "http://z.org/"})
    assert frontier.policy_of(urls, domains.where("false")).select("domain").distinct().collect()[0][0] is None


def test_policy_longest(spark):
    domains = spark.createDataFrame([("a.com", ["/x"]), ("b.a.com", [])], "domain string, prefixes array<string>")
    urls = spark.createDataFrame([("http://b.a.com/q",), ("http://c.a.com/x",), ("http://nota.com/",)], "url string")
    got = {r.url: r.domain for r in frontier.policy_of(urls, domains).collect()}
    assert got == {"http://b.a.com/q": "b.a.com", "http://c.a.com/x": "a.com", "http://nota.com/": None}


def test_html(spark):
    page = "<html><head><title>T</title><script>x</script></head><body><nav>menu</nav><article><h1>Head</h1><p>First  para &amp; more.<p>Second</article><div class='ad'>buy</div><div>Side note</div><footer>f</footer></body></html>"
    assert html.default_extractor(page) == "Head\n\nFirst para & more.\n\nSecond\n\nSide note"
    rows = html.parse(spark.createDataFrame([("http://a/", page), ("http://b/", None)], "url string, html string")).collect()
    assert rows[0].error == "Filtered text did not meet quality thresholds: chars=43 < min_text_chars=60; words=7 < min_text_words=20" and rows[0].text == "" and rows[0].raw_text.startswith("Head")
    assert rows[1].error == html.NO_TEXT and rows[1].text == ""

    def broken(page):
        raise KeyError("x")

    assert html.parse(spark.createDataFrame([("http://a/", page)], "url string, html string"), broken).first().error == html.NO_TEXT + " (KeyError: 'x')"
    assert [r[0] for r in spark.createDataFrame([(b"caf\xc3\xa9",), (b"a\xffb",), (None,)], "b binary").select(html.decoded(F.col("b"))).collect()] == ["café", "a\ufffdb", None]
    assert html.merge_texts("A b\n\na  B\n\n--", "c") == "A b\n\nc"


def test_pdf(spark):
    text = lambda k: f"My Header\nPage {k} of 4\n" + f"The {k} quick brown foxes jump over many lazy dogs near river number and then rest calmly there.\na | b | c | d"
    pages = spark.createDataFrame([(0, k, text(k)) for k in range(4)], "doc_id long, page int, text string")
    marked = pdf.drop_repeated(pdf.lines(pages))
    assert {r.line for r in marked.where("drop = 'repeated'").collect()} == {"My Header"}
    assert marked.where("drop = 'boilerplate'").count() == 8
    found = pdf.cascade(pdf.lines(pages)).first()
    assert found.quality_mode == "strict" and found.error is None and found.pages_total == 4 and found.chunks_kept == 4 and found.dropped_boilerplate == 8 and found.dropped_repeated == 4
    # chunks end with their page, even in the middle of a sentence
    assert [len(p.split()) for p in found.text.split("\n\n")] == [18] * 4
    assert pdf.page_window(pages, 2).count() == 8 // 4


def test_pdf_odd_pages(spark):
    words = "some words that are long enough to stand here and be counted as a chunk by"
    pages = [(1, 0, words), (1, 1, "---\nx"), (1, 2, "---\ny"), (2, 0, "short"), (3, 0, None), (4, 0, f"{words} one\n{words} ONE"), (4, 1, "a head\nb"), (4, 2, ""), (4, 3, "A head!")]
    frame = spark.createDataFrame(pages, "doc_id long, page int, text string")
    # pages without lines count; lines without letters share one key
    drops = {(r.doc_id, r.line): r["drop"] for r in pdf.drop_repeated(pdf.lines(frame)).collect()}
    assert drops[1, "---"] == "repeated" and drops[4, "a head"] == drops[4, "A head!"] == "repeated" and drops[4, "b"] is None
    found = {r.doc_id: r for r in pdf.parse(frame).collect()}
    assert all(found[k].text == "" and found[k].error == pdf.QUALITY_ERROR for k in (1, 2, 3, 4)) and found[1].quality_mode == "strict" and found[3].pages_total == 1
    better = spark.createDataFrame([(2, 0, " ".join([words] * 4))], "doc_id long, page int, text string")
    chosen = {(r.doc_id, r.extractor) for r in pdf.choose_pages(frame, better).collect()}
    assert (2, "second") in chosen and (1, "first") in chosen and (2, "first") not in chosen


def _pdf_file(*pages, packed=True):
    """A PDF with one content stream for each page."""
    parts, kids = [], " ".join(f"{3 + 2 * k} 0 R" for k in range(len(pages)))
    parts.append(b"1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj")
    parts.append(f"2 0 obj << /Type /Pages /Kids [{kids}] /Count {len(pages)} >> endobj".encode())
    for k, lines in enumerate(pages):
        shown = b" ".join(b"(" + x.replace("(", r"\(").replace(")", r"\)").encode("latin-1") + b") Tj 0 -14 Td" for x in lines)
        body = b"BT /F1 12 Tf 72 700 Td " + shown + b" [(Ke) 20 (rn) -300 (ed)] TJ ET"
        body = zlib.compress(body) if packed else body
        parts.append(f"{3 + 2 * k} 0 obj << /Type /Page /Parent 2 0 R /Contents {4 + 2 * k} 0 R >> endobj".encode())
        parts.append(f"{4 + 2 * k} 0 obj << /Length {len(body)} {'/Filter /FlateDecode' if packed else ''} >> stream\n".encode() + body + b"\nendstream endobj")
    return b"%PDF-1.4\n" + b"\n".join(parts) + b"\ntrailer << /Root 1 0 R >>\n%%EOF"


@pytest.mark.parametrize("packed", [True, False])
def test_pdf_bytes(packed):
    assert pdf_text.pages_of(_pdf_file(["Hello (world)", "two"], ["caf\u00e9"], packed=packed)) == ["Hello (world)\ntwo\nKern ed", "caf\u00e9\nKern ed"]
    assert pdf_text.pages_of(_pdf_file(["a"], ["b"]), 1) == ["a\nKern ed"]
    for bad in (b"", b"<html>", b"%PDF-1.4 /Encrypt"):
        with pytest.raises(ValueError):
            pdf_text.pages_of(bad)


def test_fetch(spark):
    def transport(url):
        if url.endswith("/slow"):
            raise TimeoutError("too slow")
        return url, 404 if url.endswith("/no") else 200, "text/html", b"x"

    urls = spark.createDataFrame([("http://a/ok",), ("http://a/no",), ("http://a/slow",), ("bad",), ("http://a/private",)], "url string")
    rows = {r.url: r for r in fetch.fetch(urls, transport, 1, robots=lambda s: "User-agent: *\nDisallow: /private", sleep=lambda s: None).collect()}
    assert rows["http://a/ok"].status_code == 200 and rows["http://a/no"].attempts == 1 and rows["http://a/slow"].attempts == 2
    assert rows["http://a/slow"].error == "TimeoutError: too slow" and rows["bad"].error.startswith("invalid_url") and rows["http://a/private"].error.startswith("robots_denied")
    assert not fetch.is_terminal(429, None) and fetch.is_terminal(404, None)


def test_stats(spark):
    empty = spark.createDataFrame([], "v int")
    assert [tuple(r) for r in stats.lengths(empty, v=F.col("v")).collect()] == [("v", 0, 0, 0.0, None, None)]
    rows = spark.createDataFrame([(100,), (101,), (501,)], "v int")
    assert {r.bucket: r.n for r in stats.histogram(rows, F.col("v"), (100, 500)).collect()} == {"<= 100": 1, "<= 500": 1, "> 500": 1}
    assert [r[0] for r in spark.createDataFrame([("A: b",), ("none",)], "m string").select(stats.error_type(F.col("m"))).collect()] == ["A", None]


def test_sources(spark, tmp_path):
    docs = [{"doc_id": " 1 ", "text": "x", "url": " "}, {"id": "2", "text": "y"}]
    shapes = {"list": docs, "wrapped": {"docs": docs}, "named": {"items": {"1": {"text": "x"}, "2": {"text": "y"}}}, "root": {"1": {"text": "x"}, "2": {"text": "y"}}}
    for name, value in shapes.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(value))
        assert {(r.doc_id, r.text) for r in readers.read_documents(spark, str(tmp_path / f"{name}.json")).collect()} == {("1", "x"), ("2", "y")}
    (tmp_path / "d.jsonl").write_text('{"doc_id": "1", "text": "x"}\n\nnot json\n{"text": "no id"}\n')
    assert readers.read_documents(spark, str(tmp_path / "d.jsonl")).count() == 1
    with pytest.raises(Exception):
        readers.read_documents(spark, str(tmp_path / "d.jsonl"), skip_invalid=False).collect()
    (tmp_path / "q.json").write_text('[{"id": "1", "question": "Why?"}]')
    assert readers.read_queries(spark, str(tmp_path / "q.json")).first().question == "Why?"
    assert json.loads(readers.answers_json([("1", "a"), ("1", "b")], who="x")) == {"who": "x", "1": "b"}
    urls = spark.createDataFrame([("a",), ("a",), ("b",)], "url string")
    assert readers.append_visited(urls, str(tmp_path / "visited")) == 2 and readers.append_visited(urls, str(tmp_path / "visited")) == 0
    assert spark.read.text(str(tmp_path / "visited")).count() == 2
    numbered = readers.number_rows(spark.range(50).selectExpr("id * 2 as v"), "v").orderBy("v").collect()
    assert [r.row_id for r in numbered] == list(range(50))
    readers.store_raw(spark.createDataFrame([("u", "html", b"1")], "url string, kind string, body binary"), str(tmp_path / "raw"))
    readers.store_raw(spark.createDataFrame([("u", "html", b"2"), ("w", "pdf", b"3")], "url string, kind string, body binary"), str(tmp_path / "raw"))
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 2


def test_number_rows_of_several_ranges(spark):
    """Numbers go on from range to range, and no row is lost, whatever columns the ranges are counted from."""
    rows = spark.range(0, 20000, 1, 6).select((F.col("id") * 7919 % 20000).alias("v"), F.sha1(F.col("id").cast("string")).alias("t"))
    assert [(r.row_id, r.v) for r in readers.number_rows(rows, "v").orderBy("row_id").collect()] == [(k, k) for k in range(20000)]
    assert readers.number_rows(rows.limit(0), "v").count() == 0


def test_batches_do_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    """No Python step of the core takes all rows of a task, or a task's long texts, at once."""
    rows = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_seq"), F.col("id").cast("string").alias("doc_id"), F.repeat(F.lit("some words. "), F.when(F.col("id") < 200, 20000).otherwise(9).cast("int")).alias("text"))
    real, log = type(rows).mapInArrow, str(tmp_path / "sizes")

    def noted(self, f, schema, *more):
        def run(batches):
            def each():
                for batch in batches:
                    with open(log, "a") as out:
                        out.write(f"{batch.num_rows} {batch.nbytes}\n")
                    yield batch

            return f(each())

        return real(self, run, schema, *more)

    monkeypatch.setattr(type(rows), "mapInArrow", noted)
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    steps = (lambda: bm25.build(rows, "doc_id").n, lambda: chunking.split_blocks(rows).agg(F.sum("word_count")).first()[0], lambda: html.parse(rows.withColumnRenamed("text", "html"), lambda x: x).agg(F.sum(F.length("raw_text"))).first()[0])
    for step, right in zip(steps, (4000, 3800 * 18 + 200 * 40000, (3800 * 9 + 200 * 20000) * 12), strict=True):
        (tmp_path / "sizes").unlink(missing_ok=True)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        found = step()
        sizes = [tuple(map(int, x.split())) for x in (tmp_path / "sizes").read_text().splitlines()]
        assert found >= right and sum(n for n, _ in sizes) == 4000 and max(n for n, _ in sizes) <= 1024 and max(b for _, b in sizes) < 8 << 20
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)


def test_rag(spark):
    store = spark.createDataFrame([(0, "Alpha is first. More.", None, None)], "row_id long, text string, title string, url string")
    questions = spark.createDataFrame([(1, "alpha?"), (2, "zzz")], "query_id long, text string")
    found = rag.search(questions, 1, "sparse", bm25.build(store))
    prompts = {r.query_id: r.prompt for r in rag.prompts(questions, found, store).collect()}
    # a question that no row matches gets the first rows all the same, as a full ranking does
    assert prompts[1].startswith("Question: alpha?\n\nContext passages:\n[1] (title: Untitled; source: unknown)\nAlpha") and "Alpha is first" in prompts[2]
    assert {r.query_id: r.answer for r in rag.answer(questions, found, store).collect()} == {1: "Alpha is first", 2: "Alpha is first"}
    none = rag.search(questions, 1, "closed_book")
    assert {r.prompt for r in rag.prompts(questions, none, store).collect() if rag.NO_CONTEXT in r.prompt} and rag.search(questions.withColumn("text", F.lit(" ")), 1, "sparse", bm25.build(store)).count() == 0
    for mode in ("sparse", "dense", "hybrid"):
        with pytest.raises(ValueError):
            rag.search(questions, 1, mode)
    with pytest.raises(ValueError):
        rag.search(questions, 1, "other")


def test_labels(spark):
    rows = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "de"), ("x", None)], "text string, lang string")
    predict = classify.label_column(classify.learn_labels(rows))
    got = [r[0] for r in rows.select(predict(F.col("text"))).collect()]
    assert got[0][0].label == "en" and got[1][0].label == "de" and got[2] is None


def test_config(tmp_path):
    (tmp_path / "c.json").write_text('{"max_block_words": "30", "sentences_per_block": 3}')
    with pytest.warns(UserWarning):
        assert config.chunk_config(config.load_mapping(str(tmp_path / "c.json"))).max_block_words == 30
    assert config.chunk_config({"lang": "de", "quality_threshold": 0.7}).keep_labels == ("de",)
    whole = config.CrawlConfig.load({"seeds": ["http://a.com/", {"url": "http://b.com/", "max_depth": 0, "backend": "Selenium"}, "http://a.com/"], "seed_settings": [{"seed_url": "http://a.com/", "max_pages": "4"}], "max_pages_per_domain": 7})
    assert whole.seeds == ("http://a.com/", "http://b.com/") and [d.domain for d in whole.domains] == ["a.com", "b.com"] and whole.per_domain_cap == 7
    assert {p.seed_url: (p.max_depth, p.max_pages, p.backend) for p in whole.seed_settings} == {"http://a.com/": (None, 4, None), "http://b.com/": (0, None, "selenium")}
    for bad in ({"seeds": [{"max_depth": 1}]}, {"seeds": ["http://a.com/"], "seed_settings": {"http://x.com/": {}}}, {"seeds": ["http://a.com/"], "domains": [{"domain": "a.com", "backend": "x"}]}, {"max_pages": 0}, {"seeds": [{"url": "http://a.com/", "max_depth": -1}]}):
        with pytest.raises(ValueError):
            config.CrawlConfig.load(bad)
    for name in ("c.yaml", "d.json"):
        if name == "d.json" or importlib.util.find_spec("yaml"):
            config.save_mapping(config.to_mapping(whole), str(tmp_path / name))
            assert config.CrawlConfig.load(config.load_mapping(str(tmp_path / name))) == whole
    crawl = config.CrawlConfig.load({"domains": ["a.com", {"domain": "b.com", "max_pages": 3}, {"domain": "a.com", "backend": "selenium"}], "retries": 1})
    assert [d.domain for d in crawl.domains] == ["a.com", "b.com"] and crawl.domains[0].backend == "selenium"
    with pytest.raises(ValueError):
        config.RetrievalConfig(mode="x")
    with pytest.raises(ValueError):
        config.as_bool("yes", "k")


def test_streaming(spark, tmp_path):
    rows = spark.sql("select timestamp '2024-01-01 00:00:00' + make_interval(0,0,0,0,0,cast(id as int),0) as ts, concat('t', id % 3) as text, id as doc_seq, cast(id as string) as doc_id from range(6)")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    ingest.append(ingest.once(stream, "ts"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    ingest.append(ingest.blocks(stream), str(tmp_path / "out2"), str(tmp_path / "state2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out2")).count() == 6


def pack_by_the_rules(sentences, most, overlap):
    """Packing said once more, sentence by sentence, with the sentences themselves held."""
    out, held = [], []
    size = lambda: sum(len(s.split()) for s in held)
    for s in sentences:
        n = len(s.split())
        if n > most:
            out += [" ".join(held)] * bool(held) + [" ".join(s.split()[a : a + most]) for a in range(0, n, most)]
            held = []
            continue
        if held and size() + n > most:
            out.append(" ".join(held))
            held = held[len(held) - min(overlap, len(held)) :]
            while held and size() + n > most:
                held.pop(0)
        held.append(s)
    return out + [" ".join(held)] * bool(held)


def test_packing_equals_the_rules():
    rng = np.random.default_rng(0)
    for _ in range(3000):
        sentences = [" ".join("w" for _ in range(rng.integers(1, 9))) + str(k) for k in range(rng.integers(0, 12))]
        most, overlap = int(rng.integers(1, 12)), int(rng.integers(0, 4))
        assert chunking.pack(sentences, most, overlap) == pack_by_the_rules(sentences, most, overlap)


def test_chunk_run(spark):
    good = "One two three four five six. "
    docs = spark.createDataFrame([(0, "a", good * 3, None, "http://a/", "T", "A.com "), (1, "b", "one TWO three four five six.", "http://f/", "http://b/", None, None), (2, "c", "| | | | x", None, None, None, "a.com"), (3, "d", "", None, None, None, None)], "doc_seq long, doc_id string, text string, final_url string, url string, title string, source_domain string")
    calls = []
    done = chunking.run_pipeline(docs, chunking.ChunkConfig(max_block_words=6, overlap_sentences=0), None, None, lambda d, n: calls.append(n) or stored(d, n))
    assert calls == ["blocks", "chunks"]
    chunks = done.chunks.collect()
    assert [(r.doc_id, r.url, r.title, r.source_domain, r.block_ids, r.metadata.chunk_index) for r in chunks] == [("a", "http://a/", "T", "A.com", [0], 0)]
    rejected = done.rejected.collect()
    assert sorted((r.stage, r.doc_id, r.reason.split(":")[0]) for r in rejected) == [("block", "c", "pipe_token_fraction_above_threshold"), *[("chunk", "a", "duplicate_chunk_text")] * 2, ("chunk", "b", "duplicate_chunk_text")]
    assert {r.url for r in rejected if r.doc_id == "b"} == {"http://f/"} and json.loads(next(r.metadata for r in rejected if r.stage == "block"))["pipe_token_count"] == 4
    found = chunking.summary(done.docs, done.judged, done.marked, done.config, "2024-01-01T00:00:00+00:00", "2024-01-01T00:00:02+00:00")
    assert (found["docs_input"], found["docs_kept"], found["blocks_input"], found["chunks_output"], found["chunks_deduped"], found["duration_seconds"]) == (4, 1, 5, 1, 3, 2.0)
    assert found["rejections"]["by_stage_domain"] == {"block": {"a.com": 1}, "chunk": {"a.com": 2, "unknown": 1}} and found["domains"]["docs_by_domain"] == {"a.com": 2, "unknown": 2} and found["lengths"]["docs_kept_words"]["total"] == 18
    assert chunking.run_pipeline(docs, max_docs=1).docs.count() == 1
    predict = classify.label_column((["en"], np.log(np.full((1, classify.GRAMS), 1 / classify.GRAMS))))
    assert {r.label for r in chunking.run_pipeline(docs, predict=predict).judged.collect()} == {"en"}
    with pytest.raises(ValueError):
        chunking.limited(docs, 0)


def test_index_keeps_its_tokenizer(spark, tmp_path):
    rows = spark.createDataFrame([(0, "foo-bar baz"), (1, "foo qux"), (2, "Foo-Bar"), (3, None), (4, "!!")], "row_id long, text string")
    bm25.build(rows, pattern="[A-Za-z-]+", lowercase=False, min_length=4).write(str(tmp_path / "i"))
    index = bm25.Bm25Index.read(spark, str(tmp_path / "i"))
    assert (index.n, index.settings.pattern, index.settings.lowercase, index.settings.min_length) == (2, "[A-Za-z-]+", False, 4)
    asked = spark.createDataFrame([(0, "foo-bar"), (1, "nothing here"), (2, "!!")], "query_id long, text string")
    assert [(r.query_id, r.row_id) for r in bm25.search(index, asked).collect()] == [(0, 0)]
    padded = sorted((r.query_id, r.rank, r.row_id) for r in bm25.search(index, asked, 2, True).collect())
    assert padded == [(0, 1, 0), (0, 2, 2), (1, 1, 0), (1, 2, 2)]
    for bad in ({"pattern": "("}, {"min_length": 0}, {"k1": -1.0}, {"b": 2.0}):
        with pytest.raises(ValueError):
            bm25.Settings(**bad)
    plan = index.postings._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan
    counted = bm25.build_counts(rows).first()
    assert (counted.input_rows, counted.indexed_rows, counted.skipped_empty_text, counted.skipped_empty_tokens) == (5, 3, 1, 1)


def test_dense_blocks(spark, monkeypatch):
    rng = np.random.default_rng(0)
    x, q = rng.integers(-3, 4, (300, 5)).astype(float), rng.integers(-3, 4, (9, 5)).astype(float)
    corpus = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)] + [(999, None)], "row_id long, embedding array<double>").repartition(4)
    queries = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(q)] + [(99, None)], "query_id long, vector array<double>")
    monkeypatch.setattr(dense, "SCORE_BYTES", 8 * 9 * 16)
    for limit in (32 << 20, 100):  # one block of queries, and several
        monkeypatch.setattr(dense, "QUERY_BYTES", limit)
        for metric in dense.METRICS:
            score = {"ip": x @ q.T, "l2": -((x[:, None] - q[None]) ** 2).sum(2), "cosine": (x @ q.T) / np.maximum(np.linalg.norm(x, axis=1), 1e-12)[:, None] / np.maximum(np.linalg.norm(q, axis=1), 1e-12)[None]}[metric]
            want = {(j, k + 1): int(i) for j in range(9) for k, i in enumerate(np.lexsort((np.arange(300), -np.round(score[:, j], 6)))[:7])}
            assert {(r.query_id, r.rank): r.row_id for r in dense.search_blocks(corpus, queries, 7, metric).collect()} == want
    assert dense.search_blocks(corpus, queries.where("false")).count() == 0 and dense.search_blocks(corpus.where("false"), queries).count() == 0
    states, mask = np.arange(12).reshape(2, 3, 2), np.array([[1, 1, 0], [1, 1, 1]])
    assert dense.last_token_pool(states, mask).tolist() == [[2, 3], [10, 11]] and dense.last_token_pool(states, np.array([[0, 1, 1], [1, 1, 1]])).tolist() == [[4, 5], [10, 11]]


def test_fusion_depth():
    for bad in (0, -1):
        with pytest.raises(ValueError):
            fusion.candidates(3, bad)


def test_embedding_storage(spark, tmp_path):
    rows = spark.createDataFrame([(0, "u", [1.0, 0.0], "first"), (1, "v", [0.0, 1.0], "x"), (2, "u", [1.0, 1.0], "second")], "row_id long, chunk_uid string, embedding array<double>, text string")
    assert readers.write_embedded(rows, str(tmp_path / "e"), 2) == {"num_rows": 3, "dim": 2, "num_unique_chunks": 2}
    vectors, payload = readers.read_embedded(spark, str(tmp_path / "e"))
    assert vectors.count() == 3 and {r.row_id: r.text for r in payload.collect()} == {0: "first", 1: "x", 2: "first"}
    assert readers.write_embedded(rows.where("false"), str(tmp_path / "none"), 2) == {"num_rows": 0, "dim": 0, "num_unique_chunks": 0}
    assert readers.read_embedded(spark, str(tmp_path / "none"))[0].count() == 0
    ids = lambda *r: spark.createDataFrame(r, "row_id long, chunk_uid string")
    for bad in (ids((0, "a"), (5, "b")), ids((0, "a"), (1, " ")), ids((0, "a"), (0, "b"))):
        with pytest.raises(ValueError):
            readers.checked_row_map(bad, 2)
    with pytest.raises(Exception):
        readers.write_embeddings(rows, str(tmp_path / "bad"), 3)
    (tmp_path / "l.jsonl").write_text("{}\n\n{}\n")
    assert readers.count_lines(spark, str(tmp_path / "l.jsonl")) == 2 and readers.count_lines(spark, "x.json") is None and readers.count_lines(spark, "x.jsonl", 7) == 7


def test_summaries_add_up():
    one = {"fetched_ok": 1, "started_at": "a", "fetch": {"by_backend": {"requests": {"ok": 1, "error": 0}}, "elapsed_ms_total": 10, "elapsed_ms_samples": 1, "elapsed_ms_avg": 10.0}, "frontier": {"snapshot": {"enqueued": 1}, "extra_status_counts": {"scope": 1}}, "custom_counters": {}}
    two = {"fetched_ok": 2, "started_at": "b", "fetch": {"by_backend": {"requests": {"ok": 1, "error": 1}, "selenium": {"ok": 1, "error": 0}}, "elapsed_ms_total": 30, "elapsed_ms_samples": 3, "elapsed_ms_avg": 10.0}, "frontier": {"snapshot": {"enqueued": 5}, "extra_status_counts": {"scope": 2}}, "custom_counters": {"x": 1}}
    got = stats.merge_summaries(one, two)
    assert got["fetched_ok"] == 3 and got["started_at"] == "a" and got["fetch"]["by_backend"] == {"requests": {"ok": 2, "error": 1}, "selenium": {"ok": 1, "error": 0}} and got["fetch"]["elapsed_ms_avg"] == 10.0
    assert got["frontier"] == {"snapshot": {"enqueued": 5}, "extra_status_counts": {"scope": 3}} and got["custom_counters"] == {"x": 1}
