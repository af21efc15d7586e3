"""Identifiers from content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def document_id(final_url: Column, body_sha256: Column, text: Column) -> Column:
    return F.sha1(F.concat_ws("\n", _or_empty(final_url), _or_empty(body_sha256), F.left(_or_empty(text), F.lit(512))))


def chunk_id(doc_id: Column, chunk_index: Column, text: Column) -> Column:
    return F.sha1(F.concat_ws(":", doc_id.cast("string"), chunk_index.cast("string"), text))


def json_string(value: Column) -> Column:
    """A JSON string literal with short escapes; other control characters as lower-case \\u00xx."""
    out = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for raw, escaped in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    for code in (*range(0, 8), 11, *range(14, 32)):
        out = F.replace(out, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
    return F.concat(F.lit('"'), out, F.lit('"'))


def chunk_uid(chunk_uid: Column, chunk_id: Column, doc_id: Column, text: Column, title: Column, url: Column) -> Column:
    """The first that is not blank of uid and id, else the hash of the sorted JSON of the fields; a null field is "None"."""
    body = F.concat(F.lit("{"), *(F.concat(F.lit((", " if k else "") + f'"{name}": '), json_string(F.coalesce(value.cast("string"), F.lit("None")))) for k, (name, value) in enumerate((("doc_id", doc_id), ("text", text), ("title", title), ("url", url)))), F.lit("}"))
    return F.coalesce(F.nullif(F.trim(chunk_uid), F.lit("")), F.nullif(F.trim(chunk_id), F.lit("")), F.sha1(body))
