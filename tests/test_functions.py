import posixpath
import re
from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit, urlunsplit

import pytest
from pyspark.sql import functions as F

from corvane.functions import hashing as H
from corvane.functions import text as T
from corvane.functions import url as U
from corvane.functions import vector as V


def column(spark, f, values, kind="string"):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r[1] for r in sorted(rows.select("k", f(F.col("v")).alias("x")).collect())]


def model(url):
    """Independent canonical form by the standard library."""
    s = urlsplit(url.strip())
    if s.scheme.lower() not in ("http", "https") or not s.hostname:
        return None
    port = f":{s.port}" if s.port and (s.scheme.lower(), s.port) not in (("http", 80), ("https", 443)) else ""
    path = posixpath.normpath(re.sub("/+", "/", s.path)) if s.path else "/"
    pairs = sorted((k, v) for k, v in parse_qsl(s.query, keep_blank_values=True) if not (k.strip().lower().startswith("utm_") or k.strip().lower() in U.TRACKING_KEYS))
    return urlunsplit((s.scheme.lower(), s.hostname + port, path, urlencode(pairs), ""))


URLS = [
    "http://A.Com", "HTTPS://www.A.com:443/x/", "http://a.com:80/a//b/../c/./", "http://a.com:8080/?b=2&a=1&utm_source=x&a=0", "https://a.com/p?x=&y=%7E*&z=a b", "https://a.com/?gclid=1#top", "mailto:x@y", "ftp://a.com/",
    "/relative", "", " https://a.com/%zz?ref=1 ", "http://a.com/a?b=c+d%20e", "http://a.com/../../x", "http://a.com/?x",
]


def test_normalize(spark):
    assert column(spark, U.normalize, URLS) == [model(u) for u in URLS]
    assert column(spark, U.normalize, [None]) == [None]


def test_hosts(spark):
    given = ["https://www.Sub.A.com:8/x", "www.a.com/x", "//b.org", "a.com.", None]
    assert column(spark, U.normalize_domain, given) == ["sub.a.com", "a.com", "b.org", "a.com", None]
    assert column(spark, U.policy_domain, given)[:2] == ["sub.a.com", "a.com/x"]


def test_resolve(spark):
    base = "http://a.com/x/y?q=1"
    hrefs = ["z", "../z", "/w", "//b.com/k", "?p=2", "http://c.com", "#f", "javascript:1", "", "mailto:x@y"]
    want = [None if h == "" or h.startswith(("#", "java", "mailto")) else model(urljoin(base, h)) for h in hrefs]
    assert column(spark, lambda c: U.resolve(F.lit(base), c), hrefs) == want


def test_content_kind(spark):
    kinds = ["text/html; charset=x", "application/xhtml+xml", "application/pdf", "text/plain", "application/octet-stream", None, ""]
    assert column(spark, lambda c: U.content_kind(c, F.lit("http://a/x")), kinds) == ["html", "binary", "pdf", "text", "binary", "unknown", "unknown"]
    assert column(spark, lambda c: U.content_kind(c, F.lit("http://a/x.PDF")), [None]) == ["pdf"]


def test_links(spark):
    html = "<a href='/a'>x</a><!-- <a href=\"/no\"> --><area HREF=/b><a rel=\"nofollow\" href=\"/c\"><a class=x href=\"/d?x=1&amp;y=2\">"
    assert column(spark, U.links, [html]) == [["/a", "/b", "/d?x=1&y=2"]]


def test_text(spark):
    assert column(spark, T.normalize_text, ["a\x00b\r\nc  d \x1ce ", ""]) == ["a b c d e", ""]
    assert column(spark, lambda c: T.normalize_text(c, True), ["x\ny\nx\n\nz"]) == ["x y z"]
    assert column(spark, T.normalize_document, ["One [ 12 ] two.\r\nThree four"]) == ["One two. Three four"]
    assert column(spark, T.sentences, ["One. Two! Three? four"]) == [["One.", "Two!", "Three?", "four"]]
    assert column(spark, T.preview, ["a" * 241, "a" * 240]) == ["a" * 237 + "...", "a" * 240]
    assert column(spark, lambda c: T.token_share(c, r"\|"), ["a | b |", ""]) == [0.5, 0.0]
    assert column(spark, lambda c: T.tokens(c, min_length=2), ["A bc_1, d"]) == [["bc_1"]]
    assert column(spark, T.html_title, ["<title> A <b>x</b></title>", "<title></title><h1>B</h1>", "<p>"]) == ["A x", "B", None]


def test_sentences_keep_their_digits(spark):
    """A sentence that begins or ends with its own number is whole."""
    assert column(spark, T.sentences, ["0.5 is it. 1 or 11. 21.2.1! 33 end 3"]) == [["0.5 is it.", "1 or 11.", "21.2.1!", "33 end 3"]]


def test_template():
    with pytest.raises(ValueError):
        T.fill("{a} {b}", a=None)


def test_hashes(spark):
    import hashlib
    import json

    text = 'quote " slash \\ line\n tab\t \x01 é'
    want = hashlib.sha1(json.dumps({"doc_id": "7", "text": text, "title": "None", "url": "None"}, ensure_ascii=False, sort_keys=True).encode()).hexdigest()
    none = F.lit(None).cast("string")
    assert column(spark, lambda c: H.chunk_uid(none, F.lit(""), F.lit(7), c, none, none), [text]) == [want]
    assert column(spark, lambda c: H.chunk_uid(c, none, none, none, none, none), [" u "]) == ["u"]


def test_vectors(spark):
    a, b = [3.0, 4.0], [0.0, 0.0]
    rows = spark.createDataFrame([(a, b)], "a array<double>, b array<double>")
    got = rows.select(V.dot(F.col("a"), F.col("a")), V.cosine(F.col("a"), F.col("b")), V.squared_l2(F.col("a"), F.col("b")), V.l2_normalize(F.col("a"))).first()
    assert list(got) == [25.0, 0.0, 25.0, [0.6, 0.8]]
