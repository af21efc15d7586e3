"""Text functions, Column to Column. White space is Unicode white space and the separators x1c to x1f."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"(?U)[\s\x1c-\x1f]+"
#: What is no white space, and a place with none of it before or behind.
SOLID = r"[^\s\x1c-\x1f]"
SENTENCE_END = r"(?<=[.!?])\s+"
TOKEN = "[A-Za-z0-9_]+"


def collapse(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, SPACE, " "), "^ | $", "")


def words(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(text, SPACE, " "), " "), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"(?U){SOLID}+")).cast("long")


def char_count(text: Column) -> Column:
    return F.char_length(text).cast("long")


def normalize_text(text: Column, dedup_repeated_lines: bool = False) -> Column:
    """NUL and line ends unified, repeated lines optionally dropped (first stays), white space collapsed."""
    clean = F.regexp_replace(F.translate(text, "\x00", " "), "\r\n?", "\n")
    if dedup_repeated_lines:
        lines = F.filter(F.transform(F.split(clean, "\n"), collapse), lambda x: x != "")
        clean = F.array_join(F.array_distinct(lines), "\n")
    return collapse(clean)


def normalize_document(text: Column) -> Column:
    """Numeric citations such as [ 12 ] go, no-break spaces and line ends become spaces."""
    clean = F.translate(F.regexp_replace(text, "\r\n?", "\n"), " ", " ")
    return collapse(F.regexp_replace(clean, r"\[(?U)[\s\x1c-\x1f]*[0-9]+(?U)[\s\x1c-\x1f]*\]", " "))


def sentences(text: Column, pattern: str = SENTENCE_END) -> Column:
    # F.trim itself would get the sentence's number as its second argument: the characters to trim
    return F.filter(F.transform(F.split(text, pattern), lambda s: F.trim(s)), lambda s: s != "")


def preview(text: Column, limit: int = 240) -> Column:
    flat = collapse(text)
    return F.when(F.char_length(flat) > limit, F.concat(F.left(flat, F.lit(limit - 3)), F.lit("..."))).otherwise(flat)


def dedup_text(text: Column) -> Column:
    return F.lower(collapse(text))


def tokens(text: Column, pattern: str = TOKEN, lowercase: bool = True, min_length: int = 1) -> Column:
    found = F.regexp_extract_all(F.lower(text) if lowercase else text, F.lit(pattern), F.lit(0))
    return F.filter(found, lambda t: F.char_length(t) >= min_length) if min_length > 1 else found


def token_count(text: Column, pattern: str) -> Column:
    """White-space tokens that match the whole pattern."""
    return F.regexp_count(text, F.lit(f"(?U)(?<!{SOLID})(?:{pattern})(?!{SOLID})")).cast("long")


def quality_text(text: Column, newline: str = " ") -> Column:
    """Text as a classifier gets it: line ends replaced, white space collapsed."""
    return collapse(F.replace(F.regexp_replace(text, "\r\n?", "\n"), F.lit("\n"), F.lit(newline)))


def token_share(text: Column, pattern: str) -> Column:
    """Share of white-space tokens that match the whole pattern; 0 without tokens."""
    return F.coalesce(F.try_divide(token_count(text, pattern).cast("double"), word_count(text)), F.lit(0.0))


def passage_format(text: Column) -> Column:
    return text


def query_format(text: Column, task: str) -> Column:
    return F.concat(F.lit(f"Instruct: {task}\nQuery: "), text)


def html_title(html: Column) -> Column:
    """The title, else the first h1 or h2, tags and spare white space removed; null if there is none."""

    def inner(tag: str) -> Column:
        found = F.regexp_extract(html, f"(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>", 1)
        return F.nullif(collapse(F.regexp_replace(found, "<[^>]*>", " ")), F.lit(""))

    return F.coalesce(inner("title"), inner("h1"), inner("h2"))


def template_names(template: str) -> list[str]:
    import string

    return [name for _, name, _, _ in string.Formatter().parse(template) if name is not None]


def fill(template: str, **values: Column) -> Column:
    """A format string over columns; ValueError for a placeholder without a value."""
    import string

    parts = []
    for text, name, _, _ in string.Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if name is not None:
            if name not in values:
                raise ValueError(f"template placeholder {name!r} has no value")
            parts.append(values[name])
    return F.concat(*parts) if parts else F.lit("")
