"""HTML to title, main text, links: a standard-library extractor behind a plug-in, merged texts, quality gate."""

from __future__ import annotations

import re
from collections.abc import Callable
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..batches import bounded_batches, freed
from ..functions import text as T
from ..functions import url as U

_SKIP = frozenset({"script", "style", "nav", "footer", "header", "aside", "noscript", "template"})
_BLOCKS = frozenset({"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "th", "blockquote", "pre", "div", "article", "main", "section", "title", "br", "tr"})
_VOID = frozenset({"br", "meta", "link", "img", "hr", "input", "area"})


class _Blocks(HTMLParser):
    """Paragraphs outside furniture; `main_only` keeps those within article or main."""

    def __init__(self, main_only: bool):
        super().__init__(convert_charrefs=True)
        self.main_only, self.skip, self.main, self.title = main_only, 0, 0, 0
        self.blocks: list[str] = []
        self.now: list[str] = []

    def close_block(self) -> None:
        text = re.sub(r"[ \t\r\f\v\n]+", " ", "".join(self.now)).strip()
        if text:
            self.blocks.append(text)
        self.now = []

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            if tag == "br":
                self.now.append(" ")
            return
        marks = " ".join(v or "" for k, v in attrs if k in ("class", "id")).split()
        if self.skip or tag in _SKIP or {"ad", "ads", "advert"} & set(marks):
            self.skip += tag not in ("p", "li", "td", "tr", "th")
        if tag in _BLOCKS:
            self.close_block()
        self.main += tag in ("article", "main")
        self.title += tag == "title"

    def handle_endtag(self, tag):
        if tag in _BLOCKS:
            self.close_block()
        if self.skip and tag not in ("p", "li", "td", "tr", "th") and tag not in _VOID:
            self.skip -= 1
        self.main -= tag in ("article", "main") and self.main > 0
        self.title -= tag == "title" and self.title > 0

    def handle_data(self, data):
        if not self.skip and not self.title and (self.main or not self.main_only):
            self.now.append(data)


def paragraphs(html: str, main_only: bool) -> list[str]:
    parser = _Blocks(main_only)
    parser.feed(html)
    parser.close()
    parser.close_block()
    return parser.blocks


# What parts paragraphs, what is no part of a paragraph's key, and the messages of the gate.
_PARAGRAPHS = re.compile(r"\n\s*\n+")
_NO_KEY = re.compile(r"[^a-z0-9]+")
NO_TEXT = "No extractable text from HTML"
LOW_QUALITY = "Filtered text did not meet quality thresholds: "


def dedup_key(paragraph: str) -> str:
    return _NO_KEY.sub(" ", paragraph.lower()).strip()


def merge_texts(*texts: str) -> str:
    """Paragraphs of all texts in order, the first of each key; keys without letters or digits go."""
    seen, out = set(), []
    for text in texts:
        for part in _PARAGRAPHS.split(text.replace("\r\n", "\n").replace("\r", "\n").strip()):
            part = re.sub(r"[ \t]+", " ", part).strip()
            key = dedup_key(part)
            if key and key not in seen:
                seen.add(key)
                out.append(part)
    return "\n\n".join(out)


def default_extractor(html: str) -> str:
    return merge_texts("\n\n".join(paragraphs(html, True)), "\n\n".join(paragraphs(html, False)))


def word_count(text):
    """Runs of letters, digits and underscores of any alphabet."""
    return F.size(F.regexp_extract_all(text, F.lit(r"(?U)\b\w+\b"), F.lit(0)))


def quality_error(text, min_chars: int | None = 60, min_words: int | None = 20):
    """Message of every failed threshold, or null."""
    parts = []
    if min_chars is not None:
        parts.append(F.when(F.char_length(text) < min_chars, F.concat(F.lit("chars="), F.char_length(text).cast("string"), F.lit(f" < min_text_chars={min_chars}"))))
    if min_words is not None:
        parts.append(F.when(word_count(text) < min_words, F.concat(F.lit("words="), word_count(text).cast("string"), F.lit(f" < min_text_words={min_words}"))))
    failed = F.nullif(F.concat_ws("; ", *parts), F.lit("")) if parts else F.lit(None).cast("string")
    return F.when(failed.isNotNull(), F.concat(F.lit(LOW_QUALITY), failed))


def _replaced(body):
    return None if body is None else bytes(body).decode("utf-8", "replace")


def decoded(body):
    """Text of bytes as UTF-8; those that are not valid go through Python, which replaces the bad ones."""
    return F.when(F.is_valid_utf8(body.cast("string")), body.cast("string")).otherwise(F.udf(_replaced, "string")(body))


def parse(pages: DataFrame, extractor: Callable[[str], str] = default_extractor, min_chars: int | None = 60, min_words: int | None = 20) -> DataFrame:
    """pages (url, html, …) with title, text, raw_text, error. raw_text: what the extractor found; text: empty if that
    fails a threshold or nothing was found. A page that the extractor can't read is a row with an error."""
    names, at = [*pages.columns], pages.columns.index("html")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema) + ", raw_text string, _failure string"

    def run(batches):
        for batch in batches:
            done, failed = [], []
            for html in batch.column(at).to_pylist():
                try:
                    done.append(extractor(html or ""))
                    failed.append(None)
                except Exception as error:
                    done.append("")
                    failed.append(f"{type(error).__name__}: {error}")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(done, pa.string()), pa.array(failed, pa.string())], [*names, "raw_text", "_failure"])
        batch = done = failed = None
        freed()

    bounded_batches(pages.sparkSession)
    found = pages.mapInArrow(run, schema)
    nothing = F.when(F.col("_failure").isNotNull(), F.concat(F.lit(NO_TEXT + " ("), "_failure", F.lit(")"))).otherwise(F.lit(NO_TEXT))
    error = F.when(F.col("raw_text") == "", nothing).otherwise(quality_error(F.col("raw_text"), min_chars, min_words))
    judged = found.withColumns({"title": T.html_title(F.col("html")), "error": error}).withColumn("text", F.when(F.col("error").isNull(), F.col("raw_text")).otherwise(F.lit("")))
    return judged.drop("_failure")


def out_links(pages: DataFrame, base: str = "url") -> DataFrame:
    """(from_url, position, to_url): canonical links, the first of each target on a page."""
    canonical = U.normalize(F.col(base))
    found = F.array_distinct(F.filter(F.transform(U.links(F.col("html")), lambda h: U.resolve(F.col(base), h)), lambda x: x.isNotNull()))
    return pages.select(canonical.alias("from_url"), F.posexplode(found).alias("position", "to_url"))
