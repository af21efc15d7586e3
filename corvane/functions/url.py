"""URL functions, Column to Column, without a UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query keys that only track.
TRACKING_KEYS = ("fbclid", "gclid", "mc_cid", "mc_eid", "mkt_tok", "spm", "igshid", "ref_src")
TRACKING_PREFIX = "utm_"

_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_AUTHORITY = r"^(?:(.*)@)?(\[[^\]]*\]|[^:]*)(?::([0-9]*))?$"


def _part(url: Column, k: int) -> Column:
    return F.regexp_extract(F.trim(url), _SPLIT, k)


def host(url: Column) -> Column:
    """Host in lower case without one leading www. and outer dots; '' if there is none."""
    name = F.lower(F.regexp_extract(_part(url, 2), _AUTHORITY, 2))
    return F.btrim(F.regexp_replace(name, r"^www\.", ""), F.lit("."))


def normalize_domain(value: Column) -> Column:
    """Host of a URL or of a bare domain, with or without a scheme."""
    trimmed = F.lower(F.trim(value))
    return host(F.when(trimmed.contains("://") | trimmed.startswith("//"), trimmed).otherwise(F.concat(F.lit("//"), trimmed)))


def policy_domain(value: Column) -> Column:
    """As normalize_domain, but a value without :// is taken whole, with its port and path."""
    trimmed = F.lower(F.trim(value))
    return F.when(trimmed.contains("://"), host(trimmed)).otherwise(F.btrim(F.regexp_replace(trimmed, r"^www\.", ""), F.lit(".")))


def is_http(url: Column) -> Column:
    return F.coalesce(F.trim(url).rlike(r"^(?i)https?://[^/?#]+"), F.lit(False))


def normal_path(path: Column, remove_trailing_slash: bool = True) -> Column:
    """Repeated slashes, . and .. resolved; the root for an empty path."""
    kept = F.filter(F.split(path, "/"), lambda s: (s != "") & (s != "."))
    folded = F.aggregate(kept, F.array().cast("array<string>"), lambda acc, s: F.when(s == "..", F.when(F.size(acc) > 0, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc)).otherwise(F.concat(acc, F.array(s))))
    joined = F.concat(F.lit("/"), F.array_join(folded, "/"))
    return joined if remove_trailing_slash else F.when(path.endswith("/") & (joined != "/"), F.concat(joined, F.lit("/"))).otherwise(joined)


def is_tracking(key: Column) -> Column:
    plain = F.lower(F.trim(key))
    return plain.isin(*TRACKING_KEYS) | plain.startswith(TRACKING_PREFIX)


def _decoded(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), F.replace(text, F.lit("+"), F.lit(" ")))


def _encoded(text: Column) -> Column:
    return F.replace(F.replace(F.url_encode(text), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def normal_query(query: Column, strip_tracking: bool = True, sort: bool = True) -> Column:
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda x: x != ""),
        lambda x: F.struct(_decoded(F.substring_index(x, "=", 1)).alias("k"), F.when(F.instr(x, "=") > 0, _decoded(F.substr(x, F.instr(x, "=") + 1))).otherwise(F.lit("")).alias("v")),
    )
    if strip_tracking:
        pairs = F.filter(pairs, lambda p: ~is_tracking(p["k"]))
    if sort:
        pairs = F.array_sort(pairs)
    return F.array_join(F.transform(pairs, lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")


def normalize(url: Column, strip_fragment: bool = True, strip_default_port: bool = True, strip_tracking: bool = True, sort_query: bool = True, remove_trailing_slash: bool = True, schemes: Sequence[str] = ("http", "https")) -> Column:
    """The canonical absolute URL, or null."""
    scheme, authority = F.lower(_part(url, 1)), _part(url, 2)
    user, name, port = (F.regexp_extract(authority, _AUTHORITY, k) for k in (1, 2, 3))
    default = ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    shown = (port != "") & ~default if strip_default_port else port != ""
    query = normal_query(_part(url, 4), strip_tracking, sort_query)
    built = F.concat(
        scheme, F.lit("://"), F.when(user != "", F.concat(user, F.lit("@"))).otherwise(F.lit("")), F.lower(name), F.when(shown, F.concat(F.lit(":"), port)).otherwise(F.lit("")),
        normal_path(_part(url, 3), remove_trailing_slash), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
    )
    if not strip_fragment:
        built = F.concat(built, F.when(_part(url, 5) != "", F.concat(F.lit("#"), _part(url, 5))).otherwise(F.lit("")))
    return F.when(scheme.isin(*schemes) & (name != ""), built)


def resolve(base: Column, href: Column, canonical: bool = True) -> Column:
    """href against base (RFC 3986); null for empty ones, fragments and the schemes that fetch nothing."""
    link = F.trim(href)
    root = F.concat(_part(base, 1), F.lit("://"), _part(base, 2))
    path = _part(base, 3)
    folder = F.when(path.contains("/"), F.regexp_replace(path, "[^/]*$", "")).otherwise(F.lit("/"))
    joined = (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(_part(base, 1), F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.startswith("?"), F.concat(root, path, link))
        .otherwise(F.concat(root, folder, link))
    )
    useful = (link != "") & ~link.rlike("^(?i)(?:#|javascript:|mailto:|tel:|data:)")
    return F.when(useful, normalize(joined) if canonical else joined)


def suffixes(name: Column) -> Column:
    """The host and its parent domains, longest first."""
    labels = F.split(name, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))


def in_prefixes(path: Column, prefixes: Column) -> Column:
    """Whether there are no prefixes or the path starts with one."""
    return F.coalesce(F.size(prefixes) <= 0, F.lit(True)) | F.exists(prefixes, lambda p: F.startswith(path, p))


def path_of(url: Column) -> Column:
    return F.when(_part(url, 3) == "", F.lit("/")).otherwise(_part(url, 3))


def content_kind(content_type: Column, url: Column) -> Column:
    kind = F.lower(F.trim(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1)))
    return (
        F.when(kind.contains("text/html"), "html")
        .when(kind.contains("application/pdf") | F.coalesce(F.lower(url).endswith(".pdf"), F.lit(False)), "pdf")
        .when(kind.startswith("text/"), "text")
        .when(kind != "", "binary")
        .otherwise("unknown")
    )


def suffix_content_type(url: Column) -> Column:
    path = F.lower(_part(url, 3))
    return F.when(path.endswith(".pdf"), "application/pdf").when(path.rlike(r"\.html?$"), "text/html").when(path.endswith(".txt"), "text/plain")


def links(html: Column, include_nofollow: bool = False) -> Column:
    """href of the a and area tags outside comments, in order."""
    tags = F.regexp_extract_all(F.regexp_replace(html, "(?s)<!--.*?-->", ""), F.lit(r"(?is)<(?:a|area)\s[^>]*>"), F.lit(0))
    if not include_nofollow:
        tags = F.filter(tags, lambda t: ~t.rlike(r"(?is)\srel\s*=\s*[\"']?[^\"'>]*nofollow"))
    found = F.transform(tags, lambda t: F.regexp_extract(t, r"(?is)\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", 0))
    bare = F.transform(F.filter(found, lambda x: x != ""), lambda x: F.regexp_replace(F.regexp_replace(x, r"(?is)^\shref\s*=\s*", ""), "^[\"']|[\"']$", ""))
    return F.transform(bare, lambda x: F.replace(x, F.lit("&amp;"), F.lit("&")))
