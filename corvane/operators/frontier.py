"""Crawl frontier: level-by-level expansion of the link graph with depth, scope and budgets."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import url as U
from ..sources.readers import number_rows

#: Statuses of an offered URL.
STATUSES = ("enqueued", "invalid", "depth", "scope", "closed", "seen", "global_budget", "domain_budget", "seed_budget")


def policy_of(urls: DataFrame, domains: DataFrame, url: str = "url") -> DataFrame:
    """urls with the policy columns of the longest domain that is a suffix of the host; nulls outside every domain.

    The hosts' last one, two, … labels are joined with the domains in turn, the longest first: equi-joins that Spark
    broadcasts as long as the policy is small, so no URL is shuffled. domains: one row for each domain.
    """
    rest = [c for c in domains.columns if c != "domain"]
    most = domains.agg(F.max(F.size(F.split("domain", r"\.")))).first()[0] or 0  # labels of the longest domain
    out, labels = urls.withColumn("_labels", F.split(U.host(F.col(url)), r"\.")), F.col("_labels")
    for n in range(most, 0, -1):
        mine = domains.where(F.size(F.split("domain", r"\.")) == n).select(F.col("domain").alias(f"_d{n}"), F.struct(F.col("domain"), *rest).alias(f"_p{n}"))
        suffix = F.when(F.size(labels) >= n, F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), F.lit(n)), "."))
        out = out.join(mine, suffix == F.col(f"_d{n}"), "left").drop(f"_d{n}")
    found = F.coalesce(*(F.col(f"_p{n}") for n in range(most, 0, -1))) if most else F.lit(None).cast(domains.schema)
    picked = out.withColumn("_p", found)
    return picked.select(*urls.columns, F.col("_p.domain").alias("domain"), *(F.col(f"_p.{c}").alias(c) for c in rest))


def in_scope(urls: DataFrame, domains: DataFrame, url: str = "url") -> DataFrame:
    """urls with `in_scope`: within a domain and, if that has prefixes, under one of them. domains: domain, prefixes."""
    found = policy_of(urls, domains.select("domain", "prefixes"), url)
    inside = F.col("domain").isNotNull() & F.coalesce(U.in_prefixes(U.path_of(F.col(url)), F.col("prefixes")), F.lit(False))
    return found.select(*urls.columns, inside.alias("in_scope"))


def filter_in_scope(urls: DataFrame, domains: DataFrame, order: str) -> DataFrame:
    """(order, url) of the first offer of each canonical URL that is in scope. urls: order, url."""
    canonical = urls.select(order, U.normalize(F.col("url")).alias("url")).where("url is not null")
    first = canonical.groupBy("url").agg(F.min(order).alias(order))
    return in_scope(first, domains).where("in_scope").select(order, "url")


def scope_status(depth: Column, max_depth: Column) -> Column:
    """Reason of refusal before any budget; null if there is none."""
    inside = F.col("domain").isNotNull() & U.in_prefixes(U.path_of(F.col("url")), F.col("prefixes"))
    return F.when(F.col("url").isNull(), "invalid").when(depth > max_depth, "depth").when(~inside, "scope")


def admit(offered: DataFrame, seen: DataFrame, global_cap: int | None = None, capped: bool = False, used: DataFrame | None = None) -> DataFrame:
    """offered (ord, url, domain, seed_url, depth, status, domain_cap, seed_cap) with the final status of each row.

    Rows with a status stay as they are. The others are admitted in the order of ord: the first of a URL not seen yet,
    as long as the budgets last; null caps are none. Without budgets that is a join and an aggregation; a global one
    alone numbers the candidates by range. capped: there are caps of domains or seeds. Those depend on each other row
    by row and are settled in one ordered pass over the few columns it needs. used: (domain, seed_url, n) so far.
    """
    fresh = offered.where("status is null").join(seen.select(F.col("url").alias("_seen")).distinct(), F.col("url") == F.col("_seen"), "left")
    done = offered.where("status is not null")
    if not capped:
        first = fresh.where("_seen is null").groupBy(F.col("url").alias("_url")).agg(F.min("ord").alias("_first"))
        if global_cap is not None:
            spent = (used.agg(F.sum("n")).first()[0] or 0) if used is not None else 0
            first = number_rows(first, "_first", "_place").withColumn("_open", F.col("_place") < max(0, global_cap - spent)).drop("_place")
        else:
            first = first.withColumn("_open", F.lit(True))
        judged = fresh.join(first, F.col("url") == F.col("_url"), "left")
        status = F.when(F.col("_seen").isNotNull(), "seen").when(~F.col("_open"), "global_budget").when(F.col("ord") == F.col("_first"), "enqueued").otherwise("seen")
        return done.unionByName(judged.withColumn("status", status).select(*offered.columns))
    open_rows = fresh.withColumn("status", F.when(F.col("_seen").isNotNull(), "seen")).drop("_seen")
    used_rows = [tuple(r) for r in used.collect()] if used is not None else []  # a row for each domain and seed
    names, schema = open_rows.columns, open_rows.schema
    at = [names.index(c) for c in ("url", "domain", "seed_url", "domain_cap", "seed_cap", "status")]

    def fold(batches):
        total, by_domain, by_seed, taken = 0, {}, {}, set()
        for domain, seed, n in used_rows:
            total += n
            by_domain[domain] = by_domain.get(domain, 0) + n
            by_seed[seed] = by_seed.get(seed, 0) + n
        for batch in batches:
            out = []
            for link, domain, seed, domain_cap, seed_cap, old in zip(*(batch.column(k).to_pylist() for k in at), strict=True):
                if old or link in taken:
                    out.append(old or "seen")
                elif global_cap is not None and total >= global_cap:
                    out.append("global_budget")
                elif domain_cap is not None and by_domain.get(domain, 0) >= domain_cap:
                    out.append("domain_budget")
                elif seed_cap is not None and by_seed.get(seed, 0) >= seed_cap:
                    out.append("seed_budget")
                else:
                    out.append("enqueued")
                    taken.add(link)
                    total += 1
                    by_domain[domain] = by_domain.get(domain, 0) + 1
                    by_seed[seed] = by_seed.get(seed, 0) + 1
            yield batch.set_column(at[-1], "status", pa.array(out, pa.string()))

    judged = open_rows.repartition(1).sortWithinPartitions("ord").mapInArrow(fold, schema)
    return done.unionByName(judged)


def _with(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """rows with null columns where they are missing."""
    return rows.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in rows.columns})


class Frontier:
    """The state of one crawl: what was offered at each level, and what is admitted.

    domains: domain, prefixes and, if set, max_pages. seed_policy: seed_url, max_depth, max_pages; nulls leave the
    global values. initial_seen: url. store: a function of (DataFrame, name) that writes a table and reads it back,
    called once for each level.
    """

    def __init__(self, domains: DataFrame, max_depth: int, store: Callable[[DataFrame, str], DataFrame], global_cap: int | None = None, domain_cap: int | None = None, seed_cap: int | None = None, seed_policy: DataFrame | None = None, initial_seen: DataFrame | None = None):
        self.domains = _with(domains, {"prefixes": "array<string>", "max_pages": "long"}).select("domain", "prefixes", F.coalesce(F.col("max_pages").cast("long"), F.lit(domain_cap).cast("long")).alias("domain_cap"))
        self.seeds = None if seed_policy is None else _with(seed_policy, {"max_depth": "int", "max_pages": "long"}).select(U.normalize(F.col("seed_url")).alias("seed_url"), F.col("max_depth").cast("int").alias("_depth"), F.col("max_pages").cast("long").alias("_pages"))
        self.max_depth, self.store, self.global_cap, self.seed_cap = max_depth, store, global_cap, seed_cap
        self.initial = None if initial_seen is None else initial_seen.select(U.normalize(F.col("url")).alias("url")).where("url is not null")
        per_domain = domain_cap is not None or bool(self.domains.where("domain_cap is not null").take(1))
        per_seed = seed_cap is not None or (self.seeds is not None and bool(self.seeds.where("_pages is not null").take(1)))
        self.capped = per_domain or per_seed
        self.level, self.everything = 0, None

    def push(self, offered: DataFrame) -> DataFrame:
        """Judge (ord, url, depth, seed_url, referrer) and return the rows admitted. ord is new at every level."""
        rows = offered.withColumn("url", U.normalize(F.col("url")))
        rows = rows.withColumn("seed_url", F.coalesce(U.normalize(F.col("seed_url")), F.col("url")))
        if self.seeds is not None:
            rows = rows.join(self.seeds, "seed_url", "left")
        else:
            rows = rows.withColumns({"_depth": F.lit(None).cast("int"), "_pages": F.lit(None).cast("long")})
        rows = rows.withColumns({"_depth": F.coalesce("_depth", F.lit(self.max_depth)), "seed_cap": F.coalesce("_pages", F.lit(self.seed_cap).cast("long"))})
        rows = policy_of(rows, self.domains).withColumn("status", scope_status(F.col("depth"), F.col("_depth")))
        rows = rows.withColumn("level", F.lit(self.level)).select("level", "ord", "url", "depth", "seed_url", "referrer", "domain", "status", "domain_cap", "seed_cap", F.col("_depth").alias("max_depth"))
        used = seen = None
        if self.everything is not None:
            taken = self.everything.where("status = 'enqueued'")
            seen = taken.select("url")
            used = taken.groupBy("domain", "seed_url").agg(F.count(F.lit(1)).alias("n"))
        for extra in (self.initial,):
            seen = seen if extra is None else extra if seen is None else seen.unionByName(extra)
        done = self.store(admit(rows, rows.select("url").where("false") if seen is None else seen, self.global_cap, self.capped, used), f"frontier-{self.level}")
        self.everything = done if self.everything is None else self.everything.unionByName(done)
        self.level += 1
        return done.where("status = 'enqueued'")

    def push_links(self, links: DataFrame) -> DataFrame:
        """Judge links (parent_ord, position, url, depth, seed_url, referrer), in the order of parent, position and URL."""
        numbered = number_rows(links, ["parent_ord", "position", "url"], "ord")
        return self.push(numbered.select("ord", "url", "depth", "seed_url", "referrer"))

    def snapshot(self) -> DataFrame:
        """(status, n) of everything offered."""
        return snapshot(self.everything)


def expand(seeds: DataFrame, edges: DataFrame, domains: DataFrame, max_depth: int, store, global_cap: int | None = None, domain_cap: int | None = None, seed_cap: int | None = None, seed_policy: DataFrame | None = None, initial_seen: DataFrame | None = None) -> DataFrame:
    """(level, ord, url, depth, seed_url, referrer, domain, status) of every URL offered, breadth first.

    seeds: ord, url. edges: from_url, position, to_url (both canonical). The other arguments are Frontier's. Order is by
    (level, ord), numbered anew at each level, so any depth does.
    """
    frontier = Frontier(domains, max_depth, store, global_cap, domain_cap, seed_cap, seed_policy, initial_seen)
    new = frontier.push(seeds.select("ord", "url", F.lit(0).alias("depth"), F.col("url").alias("seed_url"), F.lit(None).cast("string").alias("referrer")))
    while True:
        # links of pages at the depth of their seed are not offered
        open_pages = new.where("depth < max_depth")
        if not open_pages.take(1):
            break
        linked = open_pages.select(F.col("ord").alias("parent_ord"), F.col("url").alias("from_url"), "depth", "seed_url").join(edges, "from_url")
        new = frontier.push_links(linked.select("parent_ord", "position", F.col("to_url").alias("url"), (F.col("depth") + 1).alias("depth"), "seed_url", F.col("from_url").alias("referrer")))
    return frontier.everything.select("level", "ord", "url", "depth", "seed_url", "referrer", "domain", "status")


def snapshot(everything: DataFrame) -> DataFrame:
    return everything.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def counters(everything: DataFrame) -> DataFrame:
    """One row of the frontier's counters: offered URLs by outcome, budgets together, seen URLs, admitted domains and seeds."""
    is_ = lambda *names: F.count_if(F.col("status").isin(*names))
    return everything.agg(
        is_("enqueued").alias("enqueued"), is_("seen").alias("skipped_seen"), is_("depth").alias("skipped_depth"), is_("global_budget", "domain_budget", "seed_budget").alias("skipped_budget"), is_("invalid").alias("skipped_invalid"), is_("scope").alias("skipped_out_of_scope"),
        F.countDistinct(F.when(F.col("status") == "enqueued", F.col("seed_url"))).alias("accepted_seed_count"), F.countDistinct(F.when(F.col("status") == "enqueued", F.col("url"))).alias("accepted_this_run"),
    )


def accepted_by(everything: DataFrame, key: str) -> DataFrame:
    """(key, n) of admitted URLs by domain or seed_url."""
    return everything.where("status = 'enqueued'").groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def sorted_distinct(urls: Sequence[DataFrame]) -> DataFrame:
    """The distinct URLs of all tables, in order."""
    out = urls[0].select("url")
    for more in urls[1:]:
        out = out.unionByName(more.select("url"))
    return out.where("url is not null").distinct().orderBy("url")
