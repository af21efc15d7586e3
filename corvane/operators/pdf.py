"""Filters over extracted PDF pages: repeated and boilerplate lines, chunking, quality profiles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# Lines that are furniture wherever one of these is found, and the two quality profiles.
BOILERPLATE = (
    r"^\s*page\s+\d+\s*(of\s*\d+)?\s*$",
    r"^\s*\d+\s*/\s*\d+\s*$",
    r"\ball rights reserved\b",
    r"\bconfidential\b",
    r"\bdo not distribute\b",
    r"\bprinted on\b",
)


@dataclass(frozen=True)
class Profile:
    min_chars: int
    min_words: int
    min_alpha: float
    max_digit: float
    max_punctuation: float
    min_unique: float


STRICT = Profile(70, 12, 0.55, 0.35, 0.40, 0.25)
RELAXED = Profile(45, 8, 0.48, 0.45, 0.50, 0.18)
TOKEN = "[A-Za-z0-9']+"


def line_key(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"(?U)\W+", " "))


def is_boilerplate(line: Column) -> Column:
    matches = F.lit(False)
    for pattern in BOILERPLATE:
        matches = matches | F.lower(line).rlike(pattern)
    pipes = F.char_length(line) - F.char_length(F.replace(line, F.lit("|"), F.lit("")))
    return ((F.char_length(line) <= 180) & matches) | ((F.char_length(line) < 120) & (pipes >= 3))


#: Filtered texts of documents shorter than this are refused.
MIN_CHARS, MIN_WORDS = 180, 30
QUALITY_ERROR = "Filtered PDF text did not meet quality thresholds"
EMPTY_ERROR = "No extractable text from PDF"


def lines(pages: DataFrame) -> DataFrame:
    """(doc_id, pages, page, line_no, line, key) of the lines that are not empty, with the number of all the document's
    pages. pages: doc_id, page, text; a page without text counts."""
    clean = F.translate(F.regexp_replace(F.coalesce("text", F.lit("")), "\r\n?", "\n"), "\u00a0", " ")
    found = F.filter(F.transform(F.split(clean, "\n"), T.collapse), lambda x: x != "")
    count = pages.groupBy("doc_id").agg(F.countDistinct("page").alias("pages"))
    rows = pages.select("doc_id", "page", F.posexplode(found).alias("line_no", "line")).withColumn("key", line_key(F.col("line")))
    return rows.join(count, "doc_id").select("doc_id", "pages", "page", "line_no", "line", "key")


def drop_repeated(rows: DataFrame, share: float = 0.6, longest: int = 120) -> DataFrame:
    """rows with `drop`: null, boilerplate, or repeated (its key stands on at least max(2, share of the pages), and the
    line is short). Lines without letters or digits share the empty key; boilerplate counts too."""
    # one shuffle by document and key; the first line of a key on each page counts the page
    first = F.row_number().over(Window.partitionBy("doc_id", "key", "page").orderBy("line_no")) == 1
    counted = rows.repartition("doc_id", "key").withColumn("_first", first.cast("int"))
    counted = counted.withColumn("on_pages", F.sum("_first").over(Window.partitionBy("doc_id", "key")))
    often = (F.col("on_pages") >= F.greatest(F.lit(2), F.floor(F.col("pages") * share))) & (F.char_length("line") <= longest)
    return counted.withColumn("drop", F.when(is_boilerplate(F.col("line")), "boilerplate").when(often, "repeated")).drop("_first", "on_pages")


def join_lines(found: Column, enough: int = 420) -> Column:
    """Lines joined into chunks that end once they are long enough or a line ends a sentence."""
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"))

    def step(state: Column, line: Column) -> Column:
        now = F.when(state["now"] == "", line).otherwise(F.concat(state["now"], F.lit(" "), line))
        ends = (F.char_length(now) >= enough) | line.rlike("[.!?:]$")
        return F.struct(F.when(ends, F.concat(state["done"], F.array(now))).otherwise(state["done"]).alias("done"), F.when(ends, F.lit("")).otherwise(now).alias("now"))

    return F.aggregate(found, empty, step, lambda s: F.when(s["now"] == "", s["done"]).otherwise(F.concat(s["done"], F.array(s["now"]))))


def passes(chunk: Column, profile: Profile) -> Column:
    solid = F.greatest(F.char_length(F.regexp_replace(chunk, T.SPACE, "")), F.lit(1)).cast("double")
    share = lambda others: F.char_length(F.regexp_replace(chunk, others, "")) / solid
    tokens = F.regexp_extract_all(F.lower(chunk), F.lit(TOKEN), F.lit(0))
    unique = F.size(F.array_distinct(tokens)) / F.greatest(F.size(tokens), F.lit(1)).cast("double")
    fits = (F.char_length(chunk) >= profile.min_chars) & (F.size(tokens) >= profile.min_words) & (share(r"[^\p{L}]") >= profile.min_alpha) & (share(r"[^\p{Nd}]") <= profile.max_digit) & (share(r"[^!-/:-@\[-`{-~]") <= profile.max_punctuation)
    return fits & ((F.size(tokens) < 18) | (unique >= profile.min_unique))


def _long_enough(text: Column, min_chars: int, min_words: int) -> Column:
    return (F.char_length(text) >= min_chars) & (F.size(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))) >= min_words)


def page_chunks(rows: DataFrame) -> DataFrame:
    """(doc_id, pages, page, boilerplate, repeated, made) of each page with a line: lines dropped, and the kept ones
    joined into chunks that end with the page. rows: as `lines` gives them."""
    pages = drop_repeated(rows).groupBy("doc_id", "page").agg(
        F.first("pages").alias("pages"), F.array_sort(F.collect_list(F.when(F.col("drop").isNull(), F.struct("line_no", "line")))).alias("kept"), F.count_if(F.col("drop") == "boilerplate").alias("boilerplate"), F.count_if(F.col("drop") == "repeated").alias("repeated"),
    )
    return pages.select("doc_id", "pages", "page", "boilerplate", "repeated", join_lines(F.transform("kept", lambda x: x["line"])).alias("made"))


def cascade(rows: DataFrame, strict: Profile = STRICT, relaxed: Profile = RELAXED, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text, error, quality_mode, and the counters of the filter) of every document with a line.

    The strict text if it is long enough, else the relaxed one if that is; a document for which neither is has an empty
    text and an error, and the counters of the longer text. A text is the chunks that pass, the first of each key. Both
    profiles are judged in one pass over the chunks, a row for each.
    """
    each = page_chunks(rows).select("doc_id", "pages", "page", "boilerplate", "repeated", F.posexplode_outer("made").alias("pos", "chunk"))
    chunk, place = F.col("chunk"), F.struct("page", "pos")
    judged = each.withColumns({"key": line_key(chunk), "s": F.coalesce(passes(chunk, strict), F.lit(False)), "r": F.coalesce(passes(chunk, relaxed), F.lit(False))})
    alike = Window.partitionBy("doc_id", "key")
    first = judged.withColumns({f"{k}1": F.col(k) & (place == F.min(F.when(F.col(k), place)).over(alike)) for k in "sr"})
    text = lambda k: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(f"{k}1"), F.struct("page", "pos", "chunk")))), lambda x: x["chunk"]), "\n\n")
    top = F.coalesce("pos", F.lit(0)) == 0  # a page's own counts, once
    side = lambda k: F.struct(text(k).alias("text"), F.count_if(f"{k}1").alias("chunks_kept"), F.count_if(chunk.isNotNull() & ~F.col(k)).alias("dropped_quality"), F.count_if(F.col(k) & ~F.col(f"{k}1")).alias("dropped_duplicate"))
    both = first.groupBy("doc_id").agg(F.first("pages").alias("pages_total"), F.sum(F.when(top, F.col("boilerplate"))).alias("dropped_boilerplate"), F.sum(F.when(top, F.col("repeated"))).alias("dropped_repeated"), F.count("chunk").alias("chunks_input"), side("s").alias("s"), side("r").alias("r"))
    s_ok, r_ok = (_long_enough(F.col(f"{k}.text"), min_chars, min_words) for k in "sr")
    longer = F.char_length("r.text") > F.char_length("s.text")
    mode = F.when(s_ok, "strict").when(r_ok, "relaxed").when(longer, "relaxed_partial").otherwise("strict")
    chosen = both.withColumn("quality_mode", mode).withColumn("x", F.when(F.col("quality_mode") == "strict", F.col("s")).otherwise(F.col("r"))).withColumn("ok", s_ok | r_ok)
    return chosen.select(
        "doc_id", F.when(F.col("ok"), F.col("x.text")).otherwise(F.lit("")).alias("text"), F.when(~F.col("ok"), QUALITY_ERROR).alias("error"), "quality_mode", "pages_total", "chunks_input", "x.chunks_kept", "dropped_boilerplate", "dropped_repeated", "x.dropped_quality", "x.dropped_duplicate",
        F.char_length("x.text").alias("clean_chars"), F.size(F.regexp_extract_all("x.text", F.lit(TOKEN), F.lit(0))).alias("clean_words"),
    )


def parse(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """As cascade, for every document of pages: those without a line have an error too."""
    window = page_window(pages, max_pages)
    found = cascade(lines(window))
    every = window.groupBy("doc_id").agg(F.countDistinct("page").alias("_pages"))
    rows = every.join(found, "doc_id", "left")
    return rows.withColumns({"text": F.coalesce("text", F.lit("")), "error": F.when(F.col("quality_mode").isNull(), QUALITY_ERROR).otherwise(F.col("error")), "quality_mode": F.coalesce("quality_mode", F.lit("strict")), "pages_total": F.col("_pages")}).drop("_pages")


def choose_pages(first: DataFrame, second: DataFrame) -> DataFrame:
    """(doc_id, page, text, extractor): the first extractor's pages, but the second's where the first have too little
    text and the second more words. Both: doc_id, page, text."""
    words = lambda d: d.groupBy("doc_id").agg(F.sum(F.size(F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0)))).alias("w"))
    mine = low_signal(first).join(words(first), "doc_id")
    judged = mine.join(words(second).withColumnRenamed("w", "w2"), "doc_id", "full").select("doc_id", (F.coalesce("low_signal", F.lit(True)) & (F.coalesce("w2", F.lit(0)) > F.coalesce("w", F.lit(0)))).alias("second"))
    pick = lambda d, name, other: d.join(judged.where("second" if other else "not second").select("doc_id"), "doc_id", "left_semi").select("doc_id", "page", "text", F.lit(name).alias("extractor"))
    return pick(first, "first", False).unionByName(pick(second, "second", True))


def low_signal(pages: DataFrame) -> DataFrame:
    """(doc_id, low_signal): under 30 words or 180 characters in all pages."""
    return pages.groupBy("doc_id").agg(((F.sum(F.size(F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0)))) < 30) | (F.sum(T.char_count(F.col("text"))) < 180)).alias("low_signal"))


def page_window(pages: DataFrame, max_pages: int | None) -> DataFrame:
    """The first pages of each document."""
    if max_pages is None:
        return pages
    return pages.withColumn("_k", F.row_number().over(Window.partitionBy("doc_id").orderBy("page"))).where(F.col("_k") <= max_pages).drop("_k")
