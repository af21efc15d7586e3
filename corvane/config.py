"""Configurations of the stages, from mappings, JSON or YAML, with typed values and aliases."""

from __future__ import annotations

import json
import warnings
from dataclasses import asdict, dataclass, field, fields
from pathlib import Path
from typing import Any

from .operators.chunking import ChunkConfig


def load_mapping(path: str) -> dict[str, Any]:
    """A JSON or YAML file whose root is a mapping; an empty YAML file is an empty one."""
    text, suffix = Path(path).read_text(encoding="utf-8"), Path(path).suffix.lower()
    if suffix == ".json":
        value = json.loads(text)
    elif suffix in (".yaml", ".yml"):
        import yaml

        value = yaml.safe_load(text) or {}
    else:
        raise ValueError(f"{path}: a configuration is .json, .yaml or .yml")
    if not isinstance(value, dict):
        raise ValueError(f"{path}: the root must be a mapping")
    return value


def save_mapping(value: dict[str, Any], path: str) -> None:
    """JSON or YAML by suffix, written beside its place and then moved over it."""
    place, suffix = Path(path), Path(path).suffix.lower()
    if suffix == ".json":
        text = json.dumps(value, indent=2, ensure_ascii=False, sort_keys=True, default=list) + "\n"
    elif suffix in (".yaml", ".yml"):
        import yaml

        text = yaml.safe_dump(json.loads(json.dumps(value, default=list)), sort_keys=False, allow_unicode=True)
    else:
        raise ValueError(f"{path}: a configuration is .json, .yaml or .yml")
    place.parent.mkdir(parents=True, exist_ok=True)
    beside = place.with_name(place.name + ".tmp")
    beside.write_text(text, encoding="utf-8")
    beside.replace(place)


def as_bool(value: Any, key: str) -> bool:
    if not isinstance(value, bool):
        raise ValueError(f"{key} must be true or false")
    return value


def as_number(value: Any, key: str, kind: type = float):
    if isinstance(value, bool):
        raise ValueError(f"{key} must be a number")
    try:
        return kind(value)
    except (TypeError, ValueError):
        raise ValueError(f"{key} must be a number") from None


def from_mapping(kind: type, value: dict[str, Any], aliases: dict[str, str] | None = None):
    """A dataclass from a mapping: the first alias that is there wins, unknown keys are left out with a warning."""
    names, given = {f.name: f for f in fields(kind)}, {}
    for key, x in value.items():
        name = (aliases or {}).get(key, key)
        if name not in names:
            warnings.warn(f"unknown key {key!r}", stacklevel=2)
        elif name not in given:
            default = names[name].default
            if isinstance(default, bool):
                x = as_bool(x, key)
            elif isinstance(default, (int, float)) and x is not None:
                x = as_number(x, key, type(default))
            given[name] = tuple(x) if isinstance(x, list) else x
    return kind(**given)


@dataclass(frozen=True)
class RetrievalConfig:
    mode: str = "hybrid"
    top_k: int = 5
    fusion_top_k: int | None = None
    rrf_k: int = 60
    dense_weight: float = 1.0
    sparse_weight: float = 1.0
    k1: float = 1.5
    b: float = 0.75
    epsilon: float = 0.25
    max_new_tokens: int = 512
    temperature: float = 0.0

    def __post_init__(self):
        from .plans.rag import MODES

        if self.mode not in MODES or self.top_k <= 0 or self.rrf_k <= 0:
            raise ValueError(f"mode must be one of {MODES}; top_k and rrf_k must be positive")
        if min(self.dense_weight, self.sparse_weight) < 0 or self.dense_weight + self.sparse_weight <= 0:
            raise ValueError("weights must not be negative, nor both zero")


BACKENDS = ("requests", "selenium")
#: Settings of a domain or of a seed's lineage, and their Spark types.
POLICY = {"backend": "string", "selenium_max_depth": "int", "rate_limit_seconds": "double", "max_pages": "long", "selenium_wait_selector": "string", "selenium_wait_seconds": "double", "headers": "map<string,string>", "respect_robots": "boolean"}


def normal_domain(value: str) -> str:
    """A domain in lower case without www. and outer dots; of a URL, its host."""
    from urllib.parse import urlsplit

    raw = str(value).strip().lower()
    host = (urlsplit(raw).hostname or "") if "://" in raw else raw
    return host.removeprefix("www.").strip(".")


def _policy(value: dict[str, Any], key: str) -> dict[str, Any]:
    """The settings of a mapping, checked; what is not set is None."""
    given = lambda name, kind: None if value.get(name) is None else as_number(value[name], f"{key}.{name}", kind)
    backend = value.get("backend")
    backend = None if backend is None else str(backend).strip().lower()
    if backend not in (None, *BACKENDS):
        raise ValueError(f"{key}.backend must be one of {BACKENDS}")
    out = {
        "backend": backend, "selenium_max_depth": given("selenium_max_depth", int), "rate_limit_seconds": given("rate_limit_seconds", float), "max_pages": given("max_pages", int), "selenium_wait_selector": None if value.get("selenium_wait_selector") is None else str(value["selenium_wait_selector"]),
        "selenium_wait_seconds": given("selenium_wait_seconds", float), "headers": {str(k): str(v) for k, v in dict(value.get("headers") or {}).items()}, "respect_robots": None if value.get("respect_robots") is None else as_bool(value["respect_robots"], f"{key}.respect_robots"), "metadata": dict(value.get("metadata") or {}),
    }
    if (out["selenium_max_depth"] or 0) < 0:
        raise ValueError(f"{key}.selenium_max_depth must not be negative")
    return out


@dataclass(frozen=True)
class DomainPolicy:
    domain: str
    backend: str | None = None
    prefixes: tuple[str, ...] = ()
    selenium_max_depth: int | None = None
    rate_limit_seconds: float | None = None
    max_pages: int | None = None
    selenium_wait_selector: str | None = None
    selenium_wait_seconds: float | None = None
    headers: dict[str, str] = field(default_factory=dict)
    respect_robots: bool | None = None
    metadata: dict[str, Any] = field(default_factory=dict)

    @staticmethod
    def of(value: Any) -> DomainPolicy:
        """From a name or a mapping."""
        if isinstance(value, DomainPolicy):
            return value
        if isinstance(value, str):
            value = {"domain": value}
        if not isinstance(value, dict):
            raise TypeError(f"a domain is a name or a mapping, not {type(value).__name__}")
        name = normal_domain(value.get("domain") or "")
        if not name:
            raise ValueError("a domain needs a name")
        return DomainPolicy(name, prefixes=tuple(map(str, value.get("allowed_path_prefixes") or value.get("prefixes") or ())), **_policy(value, name))


@dataclass(frozen=True)
class SeedPolicy:
    seed_url: str
    max_depth: int | None = None
    backend: str | None = None
    selenium_max_depth: int | None = None
    rate_limit_seconds: float | None = None
    max_pages: int | None = None
    selenium_wait_selector: str | None = None
    selenium_wait_seconds: float | None = None
    headers: dict[str, str] = field(default_factory=dict)
    respect_robots: bool | None = None
    metadata: dict[str, Any] = field(default_factory=dict)

    @staticmethod
    def of(url: str, value: Any) -> SeedPolicy:
        if isinstance(value, SeedPolicy):
            if value.seed_url.strip() != str(url).strip():
                raise ValueError(f"settings of {value.seed_url!r} under the key {url!r}")
            return value
        if value is not None and not isinstance(value, dict):
            raise TypeError(f"settings of a seed are a mapping, not {type(value).__name__}")
        name = str(url).strip()
        if not name:
            raise ValueError("a seed needs a URL")
        found = _policy(value or {}, "seed")
        depth = (value or {}).get("max_depth")
        depth = None if depth is None else as_number(depth, "seed.max_depth", int)
        if (depth or 0) < 0 or (found["max_pages"] is not None and found["max_pages"] <= 0):
            raise ValueError("a seed's max_depth must not be negative, its max_pages must be positive")
        return SeedPolicy(name, depth, **found)


def seed_policies(value: Any) -> dict[str, SeedPolicy]:
    """Settings of seeds: a mapping by URL, or a list of mappings with url or seed_url; the last of a URL wins."""
    if value is None:
        return {}
    if isinstance(value, dict):
        return {p.seed_url: p for p in (SeedPolicy.of(url, v) for url, v in value.items())}
    if not isinstance(value, list):
        raise TypeError("settings of seeds are a mapping or a list")
    out = {}
    for entry in value:
        if isinstance(entry, SeedPolicy):
            out[entry.seed_url] = entry
            continue
        if not isinstance(entry, dict):
            raise TypeError("settings of a seed are a mapping")
        url = entry.get("seed_url") or entry.get("url")
        if not url:
            raise ValueError("settings of a seed need its url")
        out[str(url).strip()] = SeedPolicy.of(url, entry)
    return out


@dataclass(frozen=True)
class CrawlConfig:
    seeds: tuple[str, ...] = ()
    domains: tuple[DomainPolicy, ...] = ()
    seed_settings: tuple[SeedPolicy, ...] = ()
    max_depth: int = 1
    max_pages: int | None = None
    per_domain_cap: int | None = None
    per_seed_cap: int | None = None
    concurrency: int = 32
    timeout_seconds: float = 25.0
    retries: int = 2
    retry_backoff_seconds: float = 1.0
    rate_limit_seconds: float = 0.2
    user_agent: str = "corvane"
    default_headers: dict[str, str] = field(default_factory=dict)
    respect_robots: bool = True
    force_download: bool = False
    force_parse: bool = False
    metadata: dict[str, Any] = field(default_factory=dict)

    def __post_init__(self):
        caps = (self.max_pages, self.per_domain_cap, self.per_seed_cap)
        if self.max_depth < 0 or self.retries < 0 or any(c is not None and c <= 0 for c in caps):
            raise ValueError("max_depth and retries must not be negative, page limits must be positive")
        if self.concurrency <= 0 or self.timeout_seconds <= 0 or min(self.retry_backoff_seconds, self.rate_limit_seconds) < 0:
            raise ValueError("concurrency and timeout_seconds must be positive, backoff and rate limit must not be negative")
        unknown = sorted({p.seed_url for p in self.seed_settings} - set(self.seeds))
        if unknown:
            raise ValueError(f"settings of URLs that are no seeds: {', '.join(unknown)}")

    @staticmethod
    def load(value: dict[str, Any]) -> CrawlConfig:
        """From a mapping. Seeds are URLs or mappings with their settings; domains are names or mappings, the last of a
        name wins at the first one's place, and without any the seeds' hosts are taken; explicit seed settings win."""
        value = dict(value)
        seeds, inline = [], {}
        for entry in value.pop("seeds", None) or []:
            if isinstance(entry, dict):
                rest = dict(entry)
                url = rest.pop("url", None) or rest.pop("seed_url", None)
                rest.pop("seed_url", None)
                if not url:
                    raise ValueError("a seed needs a url")
                inline[str(url).strip()] = SeedPolicy.of(url, rest)
                entry = url
            if str(entry).strip() and str(entry).strip() not in seeds:
                seeds.append(str(entry).strip())
        listed, old = value.pop("domains", None), value.pop("allowed_domains", None)
        named: dict[str, DomainPolicy] = {}
        for d in listed or old or [x for x in map(normal_domain, seeds) if x]:
            policy = DomainPolicy.of(d)
            named[policy.domain] = policy
        settings = inline | seed_policies(value.pop("seed_settings", None))
        base = from_mapping(CrawlConfig, value, {"max_pages_per_domain": "per_domain_cap", "max_pages_per_seed": "per_seed_cap", "timeout": "timeout_seconds", "backoff": "retry_backoff_seconds"})
        given = {f.name: getattr(base, f.name) for f in fields(CrawlConfig)} | {"seeds": tuple(seeds), "domains": tuple(named.values()), "seed_settings": tuple(settings.values())}
        for key in ("max_pages", "per_domain_cap", "per_seed_cap"):
            given[key] = None if given[key] is None else as_number(given[key], key, int)
        return CrawlConfig(**given)

    def tables(self, spark):
        """(seeds, domains, seed policy or None) as the crawl takes them."""
        names = [*POLICY]
        rows = lambda policies, *first: [tuple(getattr(p, k) for k in (*first, *names)) for p in policies]
        ddl = ", ".join(f"{k} {t}" for k, t in POLICY.items())
        seeds = spark.createDataFrame(list(enumerate(self.seeds)), "ord long, url string")
        domains = spark.createDataFrame([(d, list(p), *rest) for d, p, *rest in rows(self.domains, "domain", "prefixes")], f"domain string, prefixes array<string>, {ddl}")
        policy = spark.createDataFrame(rows(self.seed_settings, "seed_url", "max_depth"), f"seed_url string, max_depth int, {ddl}") if self.seed_settings else None
        return seeds, domains, policy


def first_set(*values):
    """Precedence of seed, domain and global settings: the first that is not None."""
    return next((v for v in values if v is not None), None)


#: Other names of the chunker's settings.
CHUNK_ALIASES = {
    "block_overlap_sentences": "overlap_sentences", "split_overlap_sentences": "overlap_sentences", "split_max_block_words": "max_block_words", "max_pipe_token_fraction": "max_pipe_share", "max_dash_token_fraction": "max_dash_share", "quality_threshold": "min_label_score",
}


def chunk_config(value: dict[str, Any]) -> ChunkConfig:
    """lang, if given, is the only label that is kept."""
    value = dict(value)
    lang = value.pop("lang", None)
    if lang and "keep_labels" not in value:
        value["keep_labels"] = [str(lang)]
    return from_mapping(ChunkConfig, value, CHUNK_ALIASES)


def to_mapping(config) -> dict[str, Any]:
    return asdict(config)
