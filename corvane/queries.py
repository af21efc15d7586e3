"""Registered queries of the engine over the driver's tables, each beside its SQL for DuckDB where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import hashing as H
from .functions import text as T
from .functions import url as U
from .functions import vector as V
from .operators import chunking, classify, fetch, frontier, html, pdf, stats
from .plans import bm25, dense, fusion, rag
from .plans.storage import stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


# text

_NORMAL = r"trim(regexp_replace(replace(replace(text, chr(13)||chr(10), chr(10)), chr(13), chr(10)), '\s+', ' ', 'g'))"
_SENTENCES = r"list_filter(list_transform(string_split(regexp_replace(trim(regexp_replace(regexp_replace(text, '\[\s*[0-9]+\s*\]', ' ', 'g'), '\s+', ' ', 'g')), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s)), lambda s: s <> '')"


@query(f"SELECT doc_id, sha1({_NORMAL}) AS text_sha1, CAST(length({_NORMAL}) AS BIGINT) AS n_chars_normal FROM documents")
def text_normalize(spark, sf_dir):
    clean = T.normalize_text(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.sha1(clean).alias("text_sha1"), T.char_count(clean).alias("n_chars_normal"))


@query(r"""
WITH split AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS k FROM documents),
lines AS (SELECT doc_id, trim(regexp_replace(line, '\s+', ' ', 'g')) AS line, k FROM split),
firsts AS (SELECT doc_id, line, min(k) AS k FROM lines WHERE line <> '' GROUP BY ALL)
SELECT d.doc_id, sha1(coalesce(string_agg(f.line, ' ' ORDER BY f.k), '')) AS text_sha1, count(f.line) AS n_lines
FROM documents d LEFT JOIN firsts f USING (doc_id) GROUP BY d.doc_id""")
def text_line_dedup(spark, sf_dir):
    lines = F.array_distinct(F.filter(F.transform(F.split("text", "\n"), T.collapse), lambda x: x != ""))
    return _docs(spark, sf_dir).select("doc_id", F.sha1(T.normalize_text(F.col("text"), True)).alias("text_sha1"), F.size(lines).cast("long").alias("n_lines"))


@query("SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, sha1(array_to_string(t, ' ')) AS tokens_sha1 FROM (SELECT doc_id, regexp_extract_all(lower(text), '[A-Za-z0-9_]+') AS t FROM documents)")
def tokenize(spark, sf_dir):
    found = T.tokens(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.size(found).cast("long").alias("n_tokens"), F.sha1(F.array_join(found, " ")).alias("tokens_sha1"))


@query(f"SELECT doc_id, CAST(len(s) AS BIGINT) AS n_sentences, sha1(array_to_string(s, chr(10))) AS sentences_sha1 FROM (SELECT doc_id, {_SENTENCES} AS s FROM documents)")
def sentence_split(spark, sf_dir):
    found = T.sentences(T.normalize_document(F.col("text")))
    return _docs(spark, sf_dir).select("doc_id", F.size(found).cast("long").alias("n_sentences"), F.sha1(F.array_join(found, "\n")).alias("sentences_sha1"))


@query(r"SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS BIGINT) AS word_count, CAST(length(text) AS BIGINT) AS char_count FROM documents")
def word_char_counts(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.word_count(F.col("text")).alias("word_count"), T.char_count(F.col("text")).alias("char_count"))


@query(r"SELECT doc_id, CASE WHEN length(t) > 240 THEN left(t, 237) || '...' ELSE t END AS preview FROM (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents)")
def preview_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.preview(F.col("text")).alias("preview"))


# chunking

_PACK = rf"""
sents AS (SELECT doc_id, {_SENTENCES} AS s FROM documents),
states AS (SELECT doc_id, list_transform(s, lambda x: {{'b': CAST([] AS VARCHAR[]), 'c': [x], 'w': len(string_split(x, ' '))}}) AS l FROM sents),
folded AS (SELECT doc_id, list_reduce(l, lambda a, x: CASE
  WHEN x.w > 45 THEN {{'b': list_concat(a.b, CASE WHEN len(a.c) > 0 THEN [array_to_string(a.c, ' ')] ELSE CAST([] AS VARCHAR[]) END,
    list_transform(range(0, x.w, 45), lambda i: array_to_string(list_slice(string_split(x.c[1], ' '), CAST(i + 1 AS BIGINT), CAST(i + 45 AS BIGINT)), ' '))), 'c': CAST([] AS VARCHAR[]), 'w': CAST(0 AS BIGINT)}}
  WHEN len(a.c) > 0 AND a.w + x.w > 45 THEN CASE WHEN len(string_split(a.c[-1], ' ')) + x.w <= 45
    THEN {{'b': list_append(a.b, array_to_string(a.c, ' ')), 'c': [a.c[-1], x.c[1]], 'w': len(string_split(a.c[-1], ' ')) + x.w}}
    ELSE {{'b': list_append(a.b, array_to_string(a.c, ' ')), 'c': x.c, 'w': x.w}} END
  ELSE {{'b': a.b, 'c': list_concat(a.c, x.c), 'w': a.w + x.w}} END, {{'b': CAST([] AS VARCHAR[]), 'c': CAST([] AS VARCHAR[]), 'w': CAST(0 AS BIGINT)}}) AS f FROM states),
packed AS (SELECT doc_id, list_concat(f.b, CASE WHEN len(f.c) > 0 THEN [array_to_string(f.c, ' ')] ELSE CAST([] AS VARCHAR[]) END) AS blocks FROM folded),
blocks AS (SELECT doc_id, unnest(blocks) AS text, unnest(range(len(blocks))) AS block_id FROM packed),
judged AS (SELECT *, CASE WHEN trim(text) = '' THEN 'empty_block'
    WHEN len(list_filter(string_split(text, ' '), lambda w: w = '|')) / len(string_split(text, ' ')) > 0.05 THEN 'pipe'
    WHEN len(list_filter(string_split(text, ' '), lambda w: regexp_full_match(w, '-+'))) / len(string_split(text, ' ')) > 0.05 THEN 'dash'
    WHEN d.lang <> 'en' THEN 'label:' || d.lang END AS reason FROM blocks JOIN documents d USING (doc_id)),
judged2 AS (SELECT doc_id, block_id, reason, b.text FROM judged JOIN blocks b USING (doc_id, block_id)),
passed AS (SELECT doc_id, block_id, text, row_number() OVER (PARTITION BY sha1(lower(text)) ORDER BY doc_id, block_id) = 1 AS emitted FROM judged2 WHERE reason IS NULL),
marked AS (SELECT *, CAST(coalesce(sum(CAST(emitted AS BIGINT)) OVER (PARTITION BY doc_id ORDER BY block_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS chunk_index FROM passed)
"""
# text of the joined documents must not hide the block's
_PACK = _PACK.replace("FROM blocks JOIN documents d USING (doc_id))", "FROM blocks JOIN (SELECT doc_id, lang FROM documents) d USING (doc_id))").replace("judged2 AS (SELECT doc_id, block_id, reason, b.text FROM judged JOIN blocks b USING (doc_id, block_id))", "judged2 AS (SELECT doc_id, block_id, reason, text FROM judged)")


def _sequenced(spark, sf_dir):
    return _docs(spark, sf_dir).withColumn("doc_seq", F.col("doc_id"))


def _judged(spark, sf_dir) -> DataFrame:
    docs = _sequenced(spark, sf_dir)
    labels = docs.select(F.col("doc_id").alias("doc_seq"), F.col("lang").alias("label"))
    judged = chunking.split_blocks(docs).join(labels, "doc_seq").withColumn("reason", chunking.block_reason(chunking.ChunkConfig(), label=F.col("label")))
    return stored(judged, "blocks")  # read more than once


def _marked(spark, sf_dir) -> DataFrame:
    return chunking.chunks(_judged(spark, sf_dir).where("reason is null"))


@query(f"WITH {_PACK} SELECT doc_id, block_id, sha1(text) AS text_sha1, CAST(len(string_split(text, ' ')) AS BIGINT) AS word_count FROM blocks")
def chunk_pack(spark, sf_dir):
    return chunking.split_blocks(_sequenced(spark, sf_dir)).select(F.col("doc_seq").alias("doc_id"), F.col("block_id").cast("long").alias("block_id"), F.sha1("text").alias("text_sha1"), "word_count")


@query(f"WITH {_PACK} SELECT doc_id, block_id, emitted AS is_emitted, chunk_index, sha1(doc_id || ':' || chunk_index || ':' || text) AS chunk_id FROM marked")
def chunk_dedup_first_wins(spark, sf_dir):
    return _marked(spark, sf_dir).select(F.col("doc_seq").alias("doc_id"), F.col("block_id").cast("long").alias("block_id"), "is_emitted", "chunk_index", "chunk_id")


@query(f"""WITH {_PACK} SELECT 'block' AS stage, doc_id, block_id, CASE WHEN length(text) > 240 THEN left(text, 237) || '...' ELSE text END AS text_preview FROM judged2 WHERE reason IS NOT NULL
UNION ALL SELECT 'chunk', doc_id, block_id, CASE WHEN length(text) > 240 THEN left(text, 237) || '...' ELSE text END FROM marked WHERE NOT emitted""")
def rejects_union(spark, sf_dir):
    judged = _judged(spark, sf_dir)
    return chunking.rejects(judged, chunking.chunks(judged.where("reason is null"))).select("stage", F.col("doc_seq").alias("doc_id"), F.col("block_id").cast("long").alias("block_id"), "text_preview")


@query(f"WITH {_PACK} SELECT coalesce(split_part(reason, ':', 1), 'kept') AS kind, count(*) AS n FROM judged2 GROUP BY 1")
def block_filter_counts(spark, sf_dir):
    kind = F.split_part("reason", F.lit(":"), F.lit(1))
    short = F.when(kind.startswith("pipe"), "pipe").when(kind.startswith("dash"), "dash").when(kind == "classifier_label_not_allowed", "label").otherwise(F.coalesce(kind, F.lit("kept")))
    return _judged(spark, sf_dir).groupBy(short.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_PACK} SELECT count(DISTINCT doc_id) AS docs_in, count(DISTINCT doc_id) FILTER (emitted) AS docs_kept, (SELECT count(*) FROM blocks) AS blocks_in, count(*) FILTER (reason IS NULL) AS blocks_kept, count(*) FILTER (emitted) AS chunks_kept,
count(*) FILTER (emitted) / (SELECT count(*) FROM blocks) AS chunk_rate FROM judged2 LEFT JOIN (SELECT doc_id, block_id, emitted FROM marked) USING (doc_id, block_id)""")
def keep_rates(spark, sf_dir):
    judged = _judged(spark, sf_dir)
    rows = judged.join(chunking.chunks(judged.where("reason is null")).select("doc_seq", "block_id", "is_emitted"), ["doc_seq", "block_id"], "left")
    counted = rows.agg(F.countDistinct("doc_seq").alias("docs_in"), F.countDistinct(F.when(F.col("is_emitted"), F.col("doc_seq"))).alias("docs_kept"), F.count(F.lit(1)).alias("blocks_in"), F.count_if(F.col("reason").isNull()).alias("blocks_kept"), F.count_if("is_emitted").alias("chunks_kept"))
    return counted.withColumn("chunk_rate", stats.rate(F.col("chunks_kept"), F.col("blocks_in")))


def _shown(spark, sf_dir) -> DataFrame:
    """Documents with what chunk records show: the source as domain and URL, the language as title."""
    return _docs(spark, sf_dir).select(F.col("doc_id").alias("doc_seq"), "doc_id", "text", F.col("source").alias("url"), F.col("lang").alias("title"), F.col("source").alias("source_domain"))


@query(f"""WITH {_PACK} SELECT sha1(m.doc_id || ':' || chunk_index || ':' || m.text) AS chunk_id, CAST(m.doc_id AS VARCHAR) AS doc_id, d.source AS url, d.lang AS title, d.source AS source_domain, sha1(m.text) AS text_sha1, CAST(block_id AS BIGINT) AS block,
CAST(length(m.text) AS BIGINT) AS char_count, CAST(len(string_split(m.text, ' ')) AS BIGINT) AS word_count, chunk_index, CAST(len(string_split(m.text, ' ')) AS BIGINT) AS tokens FROM marked m JOIN documents d USING (doc_id) WHERE emitted""")
def chunk_records(spark, sf_dir):
    found = chunking.chunk_records(_marked(spark, sf_dir), _shown(spark, sf_dir))
    return found.select("chunk_id", "doc_id", "url", "title", "source_domain", F.sha1("text").alias("text_sha1"), F.col("block_ids")[0].cast("long").alias("block"), "char_count", "word_count", F.col("metadata.chunk_index").alias("chunk_index"), F.col("metadata.token_count_estimate").alias("tokens"))


@query(f"""WITH {_PACK}, pipe AS (SELECT doc_id, block_id, text, reason, len(string_split(text, ' ')) AS n, len(list_filter(string_split(text, ' '), lambda w: w = '|')) AS p, len(list_filter(string_split(text, ' '), lambda w: regexp_full_match(w, '-+'))) AS h FROM judged2)
SELECT 'block' AS stage, CAST(doc_id AS VARCHAR) AS doc_id, block_id AS block, CAST(NULL AS VARCHAR) AS chunk_id, source AS url, sha1(pipe.text) AS text_sha1, n AS words, p AS pipes, h AS dashes FROM pipe JOIN (SELECT doc_id, source FROM documents) USING (doc_id) WHERE reason IS NOT NULL
UNION ALL SELECT 'chunk', CAST(doc_id AS VARCHAR), NULL, doc_id || ':' || chunk_index, source, NULL, NULL, NULL, NULL FROM marked JOIN (SELECT doc_id, source FROM documents) USING (doc_id) WHERE NOT emitted""")
def reject_records(spark, sf_dir):
    judged = _judged(spark, sf_dir)
    found = chunking.reject_records(judged, chunking.chunks(judged.where("reason is null")), _shown(spark, sf_dir))
    number = lambda key: F.get_json_object("metadata", f"$.{key}").cast("long")
    return found.select("stage", "doc_id", F.col("block_id").cast("long").alias("block"), "chunk_id", "url", F.sha1("text").alias("text_sha1"), number("word_count_total").alias("words"), number("pipe_token_count").alias("pipes"), number("dash_token_count").alias("dashes"))


_SIZED = r"""docs2 AS (SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS BIGINT) AS w, CAST(length(text) AS BIGINT) AS c FROM documents),
kept2 AS (SELECT DISTINCT doc_id FROM marked WHERE emitted), sized AS (SELECT doc_id, block_id, reason, CAST(len(string_split(text, ' ')) AS BIGINT) AS w, CAST(length(text) AS BIGINT) AS c FROM judged2),
made AS (SELECT CAST(len(string_split(text, ' ')) AS BIGINT) AS w, CAST(length(text) AS BIGINT) AS c FROM marked WHERE emitted)"""


def _length(name: str, rows: str, column: str) -> str:
    return f"""SELECT '{name}' AS name, count(*) AS "count", CAST(coalesce(sum({column}), 0) AS BIGINT) AS total, coalesce(avg({column}), 0.0) AS avg, min({column}) AS min, max({column}) AS max FROM {rows}"""


@query(f"WITH {_PACK}, {_SIZED} " + " UNION ALL ".join(_length(f"{n}_{m}", r, c) for n, r in (("docs_input", "docs2"), ("docs_kept", "docs2 WHERE doc_id IN (SELECT doc_id FROM kept2)"), ("blocks_input", "sized"), ("blocks_kept", "sized WHERE reason IS NULL"), ("chunks_output", "made")) for m, c in (("words", "w"), ("chars", "c"))))
def chunk_lengths(spark, sf_dir):
    judged = _judged(spark, sf_dir)
    return chunking.length_rows(_sequenced(spark, sf_dir), judged, chunking.chunks(judged.where("reason is null")))


def _buckets(bounds) -> str:
    return "CASE " + " ".join(f"WHEN w <= {b} THEN '<= {b}'" for b in bounds) + f" ELSE '> {bounds[-1]}' END"


@query(f"WITH {_PACK}, {_SIZED} " + " UNION ALL ".join(f"SELECT '{n}' AS name, {_buckets(b)} AS bucket, count(*) AS n FROM {r} GROUP BY 2" for n, r, b in (("doc_words_input", "docs2", stats.DOCUMENT_WORDS), ("block_words_input", "sized", stats.BLOCK_WORDS), ("chunk_words_output", "made", stats.CHUNK_WORDS))))
def chunk_histograms(spark, sf_dir):
    judged = _judged(spark, sf_dir)
    return chunking.histogram_rows(_sequenced(spark, sf_dir), judged, chunking.chunks(judged.where("reason is null")))


@query(f"""WITH {_PACK}, c AS (SELECT (SELECT count(*) FROM documents) AS docs_input, (SELECT count(DISTINCT doc_id) FROM marked WHERE emitted) AS docs_kept, CAST(0 AS BIGINT) AS docs_rejected, (SELECT count(*) FROM judged2) AS blocks_input, (SELECT count(*) FROM judged2 WHERE reason IS NULL) AS blocks_kept,
(SELECT count(*) FROM judged2 WHERE reason IS NOT NULL) AS blocks_rejected, (SELECT count(*) FROM marked WHERE emitted) AS chunks_output, (SELECT count(*) FROM marked WHERE NOT emitted) AS chunks_rejected, (SELECT count(*) FROM marked WHERE NOT emitted) AS chunks_deduped)
SELECT *, docs_kept / docs_input AS docs_keep_rate, blocks_kept / blocks_input AS blocks_keep_rate, chunks_output / docs_kept AS chunks_per_doc_kept, chunks_output / blocks_kept AS chunks_per_block_kept FROM c""")
def chunk_counters(spark, sf_dir):
    judged = _judged(spark, sf_dir)
    return chunking.counters(_sequenced(spark, sf_dir), judged, chunking.chunks(judged.where("reason is null")))


@query(f"""WITH {_PACK}, r AS (SELECT doc_id, 'block' AS stage, reason FROM judged2 WHERE reason IS NOT NULL UNION ALL SELECT doc_id, 'chunk', 'duplicate_chunk_text' FROM marked WHERE NOT emitted),
named AS (SELECT stage, coalesce(nullif(lower(trim(source)), ''), 'unknown') AS domain FROM r JOIN (SELECT doc_id, source FROM documents) USING (doc_id))
SELECT stage, domain, count(*) AS n FROM named GROUP BY GROUPING SETS ((stage), (domain), (stage, domain))""")
def chunk_rejections(spark, sf_dir):
    judged = _judged(spark, sf_dir)
    return chunking.rejection_rows(judged, chunking.chunks(judged.where("reason is null")), _shown(spark, sf_dir)).where("reason is null").select("stage", "domain", "n")


@query(f"WITH {_PACK}, big AS (SELECT doc_id, block_id, text FROM blocks WHERE len(string_split(text, ' ')) >= 12 AND length(text) >= 60) SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY block_id) - 1 AS block_id, sha1(text) AS text_sha1 FROM big")
def block_minimums(spark, sf_dir):
    """Blocks below the minimums are gone before blocks are numbered."""
    config = chunking.ChunkConfig(min_block_words=12, min_block_chars=60)
    return chunking.split_blocks(_sequenced(spark, sf_dir), config).select(F.col("doc_seq").alias("doc_id"), F.col("block_id").cast("long").alias("block_id"), F.sha1("text").alias("text_sha1"))


@query(f"""WITH {_PACK}, s AS (SELECT doc_id, block_id, reason, text, len(list_filter(string_split(text, ' '), lambda w: w = '|')) / len(string_split(text, ' ')) AS p, len(list_filter(string_split(text, ' '), lambda w: regexp_full_match(w, '-+'))) / len(string_split(text, ' ')) AS h FROM judged2 WHERE reason IS NOT NULL)
SELECT s.doc_id, block_id, CASE reason WHEN 'pipe' THEN 'pipe_token_fraction_above_threshold:' || printf('%.4f', p) || '>0.0500' WHEN 'dash' THEN 'dash_token_fraction_above_threshold:' || printf('%.4f', h) || '>0.0500' ELSE 'classifier_label_not_allowed:' || lang END AS reason FROM s JOIN (SELECT doc_id, lang FROM documents) USING (doc_id)""")
def reject_reasons(spark, sf_dir):
    return _judged(spark, sf_dir).where("reason is not null").select(F.col("doc_seq").alias("doc_id"), F.col("block_id").cast("long").alias("block_id"), "reason")


@query(r"SELECT doc_id, sha1(trim(regexp_replace(replace(text, chr(10), ' / '), '\s+', ' ', 'g'))) AS text_sha1, 'Instruct: find it' || chr(10) || 'Query: ' || lang AS query, source AS passage FROM documents")
def model_inputs(spark, sf_dir):
    """Texts as a classifier gets them, queries and passages as an encoder does."""
    return _docs(spark, sf_dir).select("doc_id", F.sha1(T.quality_text(F.col("text"), " / ")).alias("text_sha1"), T.query_format(F.col("lang"), "find it").alias("query"), T.passage_format(F.col("source")).alias("passage"))


# statistics


@query("""SELECT 'chars' AS name, count(*) AS "count", CAST(sum(length(text)) AS BIGINT) AS total, avg(length(text)) AS avg, CAST(min(length(text)) AS BIGINT) AS min, CAST(max(length(text)) AS BIGINT) AS max FROM documents
UNION ALL SELECT 'words', count(*), CAST(sum(w) AS BIGINT), avg(w), CAST(min(w) AS BIGINT), CAST(max(w) AS BIGINT) FROM (SELECT len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS w FROM documents)""".replace("\\\\", "\\"))
def length_stats(spark, sf_dir):
    return stats.lengths(_docs(spark, sf_dir), chars=T.char_count(F.col("text")), words=T.word_count(F.col("text")))


_WORDS = r"len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))"
_BUCKETS = " ".join(f"WHEN w <= {b} THEN '<= {b}'" for b in stats.DOCUMENT_WORDS)


@query(f"SELECT CASE {_BUCKETS} ELSE '> {stats.DOCUMENT_WORDS[-1]}' END AS bucket, count(*) AS n FROM (SELECT {_WORDS} AS w FROM documents) GROUP BY 1")
def length_histogram(spark, sf_dir):
    return stats.histogram(_docs(spark, sf_dir), T.word_count(F.col("text")), stats.DOCUMENT_WORDS)


@query("SELECT stage, domain, count(*) AS n FROM (SELECT lang AS stage, coalesce(nullif(lower(trim(source)), ''), 'unknown') AS domain FROM documents) GROUP BY GROUPING SETS ((stage), (domain), (stage, domain))")
def rejections_grouping_sets(spark, sf_dir):
    return stats.by_stage_and_domain(_docs(spark, sf_dir).select(F.col("lang").alias("stage"), stats.domain_key(F.col("source")).alias("domain")))


@query("SELECT coalesce(nullif(lower(trim(source)), ''), 'unknown') AS domain, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, domain LIMIT 10")
def top_domains(spark, sf_dir):
    return stats.top_domains(_docs(spark, sf_dir).withColumnRenamed("source", "domain"))


@query("SELECT event_type AS backend, count(*) FILTER (event_type <> 'error' AND value < 50) AS ok, count(*) FILTER (NOT (event_type <> 'error' AND value < 50)) AS error, round(avg(value), 6) AS avg_elapsed_ms, CAST(sum(length(props)) AS BIGINT) AS bytes FROM events GROUP BY 1")
def crawl_stats(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("backend"), ((F.col("event_type") != "error") & (F.col("value") < 50)).alias("ok"), F.col("value").alias("elapsed_ms"), F.length("props").alias("content_length"))
    return stats.crawl(rows).withColumn("avg_elapsed_ms", F.round("avg_elapsed_ms", 6))


@query("SELECT user_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'error') AS error, count(*) FILTER (event_type = 'view') AS view FROM events GROUP BY 1")
def crawl_stats_pivot(spark, sf_dir):
    kinds = ["click", "error", "view"]
    return table(spark, sf_dir, "events").groupBy("user_id").pivot("event_type", kinds).count().na.fill(0, kinds)


@query("SELECT backend, CAST(sum(n) AS BIGINT) AS n FROM (SELECT event_type AS backend, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY 1 UNION ALL SELECT event_type, count(*) FROM events WHERE event_id % 2 = 1 GROUP BY 1) GROUP BY 1")
def stats_merge(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "backend")
    parts = [events.where(F.col("event_id") % 2 == k).groupBy("backend").agg(F.count(F.lit(1)).alias("n")) for k in (0, 1)]
    return stats.merge(*parts, ["backend"])


@query("""SELECT CASE event_type WHEN 'click' THEN 'frontier_enqueued' WHEN 'view' THEN 'frontier_skipped_visited' WHEN 'error' THEN 'frontier_skipped_budget' ELSE event_type END AS counter, count(*) AS n FROM events GROUP BY 1""")
def enqueue_folding(spark, sf_dir):
    kind = F.col("event_type")
    status = F.when(kind == "click", "enqueued").when(kind == "view", "seen").when((kind == "error") & (F.col("event_id") % 2 == 0), "domain_budget").when(kind == "error", "seed_budget").otherwise(kind)
    return table(spark, sf_dir, "events").groupBy(stats.folded_status(status).alias("counter")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH f AS (SELECT event_id, event_type, value, CASE WHEN event_type = 'error' THEN 'Timeout: ' || event_id END AS error, CASE WHEN event_id % 3 > 0 THEN CAST(floor(value) AS BIGINT) END AS ms, length(props) AS size FROM events)
SELECT count(*) FILTER (error IS NULL) AS ok, count(*) FILTER (error IS NOT NULL) AS error, CAST(coalesce(sum(ms), 0) AS BIGINT) AS elapsed_ms_total, count(ms) AS elapsed_ms_samples, CAST(sum(size) AS BIGINT) AS bytes_total, count(*) FILTER (error LIKE 'Timeout:%') AS timeouts FROM f""")
def fetch_totals(spark, sf_dir):
    bad = F.col("event_type") == "error"
    rows = table(spark, sf_dir, "events").select((~bad).alias("ok"), F.when(bad, F.concat(F.lit("Timeout: "), F.col("event_id").cast("string"))).alias("error"), F.when(F.col("event_id") % 3 > 0, F.floor("value").cast("long")).alias("elapsed_ms"), F.length("props").alias("content_length"))
    timeouts = rows.groupBy(stats.failure_type(F.col("error")).alias("t")).count().where("t = 'Timeout'").agg(F.coalesce(F.sum("count"), F.lit(0)).cast("long")).first()[0]
    return stats.fetch_totals(rows).withColumn("timeouts", F.lit(timeouts))


@query("SELECT to_json({'doc_id': doc_id, 'lang': lang, 'n_chars': n_chars, 'source': source, 'title': CAST(NULL AS VARCHAR)})::VARCHAR AS value FROM documents")
def document_json_lines(spark, sf_dir):
    from .sources.crawl_store import json_lines

    return json_lines(_docs(spark, sf_dir).select("source", "doc_id", "lang", "n_chars", F.lit(None).cast("string").alias("title")))


@query("SELECT doc_id, source AS chunk_uid, CAST(NULL AS VARCHAR) AS title, sha1(text) AS text_sha1, lang AS url FROM documents")
def chunk_payloads(spark, sf_dir):
    from .sources.readers import chunk_payload

    rows = _docs(spark, sf_dir).select("doc_id", F.col("source").alias("chunk_uid"), "text", F.col("lang").alias("url"))
    return chunk_payload(rows).select("doc_id", "chunk_uid", "title", F.sha1("text").alias("text_sha1"), "url")


@query("SELECT event_id, event_type <> 'error' AND event_id % 7 < 4 AND event_id % 5 > 0 AS ok, CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'Timeout' END AS error_type FROM events")
def fetch_outcomes(spark, sf_dir):
    n, bad = F.col("event_id"), F.col("event_type") == "error"
    error = F.when(bad, F.when(n % 2 == 0, F.lit("Timeout: slow")).otherwise(F.lit("no type")))
    status = F.when(n % 7 < 3, 200 + (n % 7) * 49).when(n % 7 == 3, 299).when(n % 7 == 4, 300).when(n % 7 == 5, 404)
    body = F.when(n % 5 > 0, F.col("props").cast("binary"))
    return table(spark, sf_dir, "events").select("event_id", fetch.ok(error, status, body).alias("ok"), stats.error_type(error).alias("error_type"))


def _scratch(spark, name: str) -> str:
    import uuid

    from .plans.storage import folder

    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(r"SELECT CAST(doc_id AS VARCHAR) AS doc_id, sha1(text) AS text_sha1, source AS source_domain, CAST(NULL AS VARCHAR) AS title, '{}' AS metadata FROM documents WHERE doc_id % 3 > 0")
def documents_from_json_lines(spark, sf_dir):
    """Documents written as JSON lines, a third of the lines cut short, and read back leniently."""
    from .sources import readers
    from .sources.crawl_store import json_lines

    path = _scratch(spark, "documents")
    lines = json_lines(_docs(spark, sf_dir).select("doc_id", F.col("doc_id").cast("string").alias("id"), "text", F.concat(F.lit(" "), "source").alias("source_domain"), F.lit(" ").alias("title")).drop("doc_id"))
    lines.withColumn("value", F.when(F.get_json_object("value", "$.id").cast("long") % 3 == 0, F.left("value", F.length("value") - 1)).otherwise(F.col("value"))).write.text(path)
    return readers.read_documents(spark, path).select("doc_id", F.sha1("text").alias("text_sha1"), "source_domain", "title", "metadata")


@query("SELECT CAST(item_id AS VARCHAR) AS id, trim(text) AS question FROM benchmark")
def query_file(spark, sf_dir):
    from .sources import readers

    path = _scratch(spark, "queries")
    listed = table(spark, sf_dir, "benchmark").agg(F.to_json(F.collect_list(F.struct(F.col("item_id").cast("string").alias("id"), F.trim("text").alias("question")))).alias("value"))
    listed.write.text(path)  # one JSON list: a question file
    return readers.read_queries(spark, path).select("id", "question")


@query("SELECT vec_id AS row_id, 'c' || label AS chunk_uid, CAST(embedding[1] AS DOUBLE) AS head, len(embedding) AS size, first_id AS shown FROM embeddings JOIN (SELECT label, min(vec_id) AS first_id FROM embeddings GROUP BY 1) USING (label)")
def embedding_store(spark, sf_dir):
    """Vectors written with row map and chunk store and read back, checked; a uid shows its first row's payload."""
    from .sources import readers

    path = _scratch(spark, "vectors")
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_id"), F.concat(F.lit("c"), "label").alias("chunk_uid"), "embedding", F.col("vec_id").alias("shown"))
    readers.write_embedded(rows, path, 64)
    vectors, payload = readers.read_embedded(spark, path)
    return vectors.join(payload, "row_id").select("row_id", "chunk_uid", F.col("embedding")[0].cast("double").alias("head"), F.size("embedding").cast("long").alias("size"), "shown")


@query("SELECT DISTINCT source AS url FROM documents")
def visited_manifest(spark, sf_dir):
    """Two lists of URLs added one after the other: each URL stands once."""
    from .sources.crawl_store import CrawlStore

    store = CrawlStore(spark, _scratch(spark, "manifest"))
    urls = _docs(spark, sf_dir).select(F.col("source").alias("url"), "doc_id")
    for part in (urls.where("doc_id % 2 = 0"), urls):
        store.append_visited(part.select("url"))
    return store.visited()


# URLs and pages

_CANON = r"""regexp_extract(lower({u}), '^(https?://[^/?#]+)', 1) || coalesce(nullif(rtrim(regexp_extract({u}, '^https?://[^/?#]+([^?#]*)', 1), '/'), ''), '/') ||
CASE WHEN regexp_extract({u}, '\?([^#]*)', 1) = '' THEN '' ELSE coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(regexp_extract({u}, '\?([^#]*)', 1), '&'), lambda p: NOT starts_with(p, 'utm_'))), '&'), ''), '') END"""
_URL = _CANON.format(u="url")
_HOST = "regexp_replace(lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)), '^www\\.', '')"


@query(f"SELECT page_id, {_URL} AS url_normal FROM pages")
def url_normalize(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.normalize(F.col("url")).alias("url_normal"))


@query(f"SELECT page_id, {_HOST} AS host, {_HOST} AS domain, true AS is_http FROM pages")
def url_host(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", U.host(url).alias("host"), U.normalize_domain(url).alias("domain"), U.is_http(url).alias("is_http"))


@query(r"""WITH p AS (SELECT page_id, lower(regexp_extract(url, '^(https?://[^/?#]+)', 1)) AS root, rtrim(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '/') AS path FROM pages)
SELECT page_id, root || regexp_replace(path, '/[^/]*$', '') || '/x/z' AS url_normal FROM p""")
def url_path_dots(spark, sf_dir):
    """Dots, double dots and repeated slashes behind every page's path."""
    bare = F.regexp_replace("url", "/*([?#].*)?$", "")
    return table(spark, sf_dir, "pages").select("page_id", U.normalize(F.concat(bare, F.lit("/.././x//y/../z/"))).alias("url_normal"))


_HREFS = ("a/b", "./c", "../d", "?q=1", "//other.example.com/z", "#f", "mailto:x@y.z", "/top?utm_source=a&b=2")


@query(r"""WITH p AS (SELECT page_id, lower(regexp_extract(url, '^(https?)', 1)) AS scheme, lower(regexp_extract(url, '^(https?://[^/?#]+)', 1)) AS root, coalesce(nullif(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), ''), '/') AS path FROM pages), d AS (SELECT *, regexp_replace(path, '[^/]*$', '') AS dir FROM p)
SELECT page_id, k, CASE k WHEN 0 THEN root || dir || 'a/b' WHEN 1 THEN root || dir || 'c' WHEN 2 THEN root || regexp_replace(dir, '[^/]+/$', '') || 'd' WHEN 3 THEN root || coalesce(nullif(rtrim(path, '/'), ''), '/') || '?q=1' WHEN 4 THEN scheme || '://other.example.com/z' WHEN 7 THEN root || '/top?b=2' END AS url FROM d, range(8) AS r(k)""")
def url_resolve(spark, sf_dir):
    each = F.array(*(U.resolve(F.col("url"), F.lit(h)) for h in _HREFS))
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(each).alias("k", "url")).withColumn("k", F.col("k").cast("long"))


@query(r"SELECT page_id, CASE WHEN regexp_matches(url, '\.html?([?#].*)?$') THEN 'text/html' END AS suffix_type, CASE WHEN page_id % 4 = 0 THEN 'html' WHEN page_id % 4 = 1 THEN 'pdf' WHEN page_id % 4 = 2 THEN 'text' ELSE 'binary' END AS kind FROM pages")
def content_kind(spark, sf_dir):
    n = F.col("page_id") % 4
    given = F.when(n == 0, "Text/HTML; charset=utf-8").when(n == 1, "application/pdf").when(n == 2, "text/plain").otherwise("application/xhtml+xml")
    return table(spark, sf_dir, "pages").select("page_id", U.suffix_content_type(F.col("url")).alias("suffix_type"), U.content_kind(given, F.col("url")).alias("kind"))


#: Crawl policy of the registered queries: domains and the path prefixes allowed under them.
POLICY = (("example.com", ()), ("example.net", ("/de", "/en")), ("blog.ththly.example.org", ()), ("therha.example.com", ("/fr",)))


def _policy(spark) -> DataFrame:
    return spark.createDataFrame([(d, list(p)) for d, p in POLICY], "domain string, prefixes array<string>")


@query(f"""WITH p(domain, prefixes) AS (VALUES {", ".join(f"('{d}', CAST([{', '.join(repr(x) for x in p)}] AS VARCHAR[]))" for d, p in POLICY)}),
h AS (SELECT page_id, {_HOST} AS host, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path FROM pages),
m AS (SELECT page_id, path, domain, prefixes, row_number() OVER (PARTITION BY page_id ORDER BY length(domain) DESC) AS k FROM h JOIN p ON host = domain OR ends_with(host, '.' || domain))
SELECT h.page_id, m.domain, coalesce(len(m.prefixes) = 0 OR len(list_filter(m.prefixes, lambda x: starts_with(m.path, x))) > 0, false) AS in_scope FROM h LEFT JOIN m ON h.page_id = m.page_id AND k = 1""")
def url_scope_longest_suffix(spark, sf_dir):
    found = frontier.policy_of(table(spark, sf_dir, "pages").select("page_id", "url"), _policy(spark))
    return found.select("page_id", "domain", (F.col("domain").isNotNull() & U.in_prefixes(U.path_of(F.col("url")), F.col("prefixes"))).alias("in_scope"))


_SCOPED = f"""pol(domain, prefixes) AS (VALUES {", ".join(f"('{d}', CAST([{', '.join(repr(x) for x in p)}] AS VARCHAR[]))" for d, p in POLICY)}),
cu AS (SELECT {_URL} AS url, min(page_id) AS page_id FROM pages GROUP BY 1), hu AS (SELECT url, page_id, regexp_replace(regexp_extract(url, '^https?://([^/?#:]+)', 1), '^www\\.', '') AS host, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path FROM cu),
best AS (SELECT url, page_id, any_value(path) AS path, arg_max(prefixes, length(domain)) AS prefixes FROM hu JOIN pol ON host = domain OR ends_with(host, '.' || domain) GROUP BY 1, 2)""".replace("\\\\.", "\\.")


@query(f"WITH {_SCOPED} SELECT page_id, url FROM best WHERE len(prefixes) = 0 OR len(list_filter(prefixes, lambda x: starts_with(path, x))) > 0")
def url_scope_filter(spark, sf_dir):
    return frontier.filter_in_scope(table(spark, sf_dir, "pages").select("page_id", "url"), _policy(spark), "page_id")


@query(f"""WITH pol(domain, backend, most, pause, robots) AS (VALUES ('example.com', 'selenium', 0, 1.5, CAST(NULL AS BOOLEAN)), ('example.net', CAST(NULL AS VARCHAR), NULL, NULL, false), ('cheap-pills.example.com', 'requests', NULL, 9.0, true)),
h AS (SELECT page_id, {_HOST} AS host, {_URL} IN (SELECT {_URL} FROM pages WHERE page_id % 10 = 0) AS seed FROM pages), m AS (SELECT page_id, domain, backend, most, pause, robots, row_number() OVER (PARTITION BY page_id ORDER BY length(domain) DESC) AS k FROM h JOIN pol ON host = domain OR ends_with(host, '.' || domain))
SELECT h.page_id, m.domain, CASE WHEN seed THEN 'requests' WHEN m.backend = 'selenium' AND h.page_id % 3 > most THEN 'requests' ELSE coalesce(m.backend, 'requests') END AS backend, CAST(CASE WHEN seed THEN 0.5 ELSE coalesce(m.pause, 0.2) END AS DOUBLE) AS pause, coalesce(m.robots, true) AS respect_robots, CASE WHEN seed THEN 'seed' WHEN m.domain = 'example.net' THEN 'domain' ELSE 'corvane' END AS agent
FROM h LEFT JOIN m ON h.page_id = m.page_id AND k = 1""")
def fetch_policy(spark, sf_dir):
    """What is in force for each page: its seed's settings (every tenth page is one), its domain's, the global ones."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", (F.col("page_id") % 3).cast("int").alias("depth"))
    domains = spark.createDataFrame([("example.com", "selenium", 0, 1.5, None, None), ("example.net", None, None, None, False, {"User-Agent": "domain"}), ("cheap-pills.example.com", "requests", None, 9.0, True, None)], "domain string, backend string, selenium_max_depth int, rate_limit_seconds double, respect_robots boolean, headers map<string,string>")
    seeds = pages.where("page_id % 10 = 0").select(F.col("url").alias("seed_url"), F.lit("requests").alias("backend"), F.lit(0.5).alias("rate_limit_seconds"), F.create_map(F.lit("User-Agent"), F.lit("seed")).alias("headers")).dropDuplicates(["seed_url"])
    found = fetch.policies(pages.select("page_id", "url", "depth", U.normalize(F.col("url")).alias("seed_url")), domains, seeds, agent="corvane", keep=["page_id"])
    return found.select("page_id", "domain", "backend", "pause", "respect_robots", F.col("headers")["User-Agent"].alias("agent"))


_LINKS = r"""SELECT page_id, url, unnest(h) AS href, unnest(range(len(h))) AS k FROM (SELECT page_id, url, regexp_extract_all(html, '<a\s[^>]*?href="([^"]*)"', 1) AS h FROM pages)"""


@query(f"SELECT page_id, CAST(k AS BIGINT) AS position, href FROM ({_LINKS})")
def link_extract(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(U.links(F.col("html"))).alias("position", "href")).withColumn("position", F.col("position").cast("long"))


@query(r"""WITH h AS (SELECT page_id, regexp_extract_all(regexp_replace(html, '<li><a [^>]*>', '', 'g'), '<a\s[^>]*?href="([^"]*)"', 1) AS h FROM pages) SELECT page_id, CAST(unnest(range(len(h))) AS BIGINT) AS position, unnest(h) AS href FROM h""")
def link_nofollow(spark, sf_dir):
    """The links of lists marked nofollow: only the others are found."""
    marked = F.regexp_replace("html", "<li><a ", '<li><a rel="external nofollow" ')
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(U.links(marked)).alias("position", "href")).withColumn("position", F.col("position").cast("long"))


@query(f"SELECT page_id, 'raw/html/' || {_HOST} || '/' || sha256(url) || '.html' AS path FROM pages")
def raw_paths(spark, sf_dir):
    from .sources.readers import raw_path

    return table(spark, sf_dir, "pages").select("page_id", raw_path(F.col("url"), F.lit("html")).alias("path"))


_TARGET = _CANON.format(u="t")
_EDGES = rf"""targets AS (SELECT page_id, {_URL} AS from_url, k, regexp_extract(url, '^(https?://[^/?#]+)', 1) || href AS t FROM ({_LINKS}) WHERE starts_with(href, '/')),
edges AS (SELECT page_id, from_url, to_url, min(k) AS k FROM (SELECT page_id, from_url, {_TARGET} AS to_url, k FROM targets) GROUP BY ALL)"""


@query(f"WITH {_EDGES} SELECT from_url, to_url, count(*) AS n FROM edges GROUP BY 1, 2")
def link_expand_depth1(spark, sf_dir):
    return html.out_links(table(spark, sf_dir, "pages")).groupBy("from_url", "to_url").agg(F.count(F.lit(1)).alias("n"))


def _frontier(spark, sf_dir, domains: DataFrame | None = None, **caps) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    edges = stored(html.out_links(pages).groupBy("from_url", "to_url").agg(F.min("position").alias("position")), "edges")
    seeds = pages.select(F.col("page_id").alias("ord"), "url")
    return frontier.expand(seeds, edges, _policy(spark) if domains is None else domains, 1, stored, **caps)


@query(f"""WITH {_EDGES}, p(domain, prefixes) AS (VALUES {", ".join(f"('{d}', CAST([{', '.join(repr(x) for x in p)}] AS VARCHAR[]))" for d, p in POLICY)}),
ok AS (SELECT u FROM (SELECT u, arg_max(prefixes, length(domain)) AS prefixes FROM (SELECT DISTINCT {_URL} AS u FROM pages UNION SELECT to_url FROM edges),
  p WHERE regexp_replace(regexp_extract(u, '^https?://([^/?#:]+)', 1), '^www\\.', '') = domain OR ends_with(regexp_replace(regexp_extract(u, '^https?://([^/?#:]+)', 1), '^www\\.', ''), '.' || domain) GROUP BY u)
  WHERE len(prefixes) = 0 OR len(list_filter(prefixes, lambda x: starts_with(regexp_extract(u, '^https?://[^/?#]+([^?#]*)', 1), x))) > 0),
level0 AS (SELECT DISTINCT {_URL} AS url FROM pages WHERE {_URL} IN (SELECT u FROM ok)),
level1 AS (SELECT DISTINCT to_url AS url FROM edges WHERE from_url IN (SELECT url FROM level0) AND to_url IN (SELECT u FROM ok) AND to_url NOT IN (SELECT url FROM level0))
SELECT url, 0 AS depth FROM level0 UNION ALL SELECT url, 1 FROM level1""".replace("\\\\.", "\\."))
def frontier_bfs(spark, sf_dir):
    return _frontier(spark, sf_dir).where("status = 'enqueued'").select("url", "depth")


_FOLD = """{state} AS (SELECT CAST(0 AS BIGINT) AS i, {start} UNION ALL SELECT i + 1, CASE WHEN open THEN total + 1 ELSE total END, CASE WHEN open THEN map_concat(dom, MAP {{coalesce(domain, ''): coalesce(dom[domain], 0) + 1}}) ELSE dom END, CASE WHEN open THEN map_concat(sd, MAP {{coalesce(seed, ''): coalesce(sd[seed], 0) + 1}}) ELSE sd END,
  CASE WHEN open THEN list_append(taken, url) ELSE taken END, now, url, depth, seed FROM (SELECT *, now = 'enqueued' AS open FROM (SELECT s.i, s.total, s.dom, s.sd, s.taken, r.url, r.depth, r.seed, r.domain, CASE WHEN r.status IS NOT NULL THEN r.status WHEN list_contains(s.taken, r.url) THEN 'seen' WHEN s.total >= 200 THEN 'global_budget' WHEN coalesce(s.dom[r.domain], 0) >= r.cap THEN 'domain_budget'
  WHEN coalesce(s.sd[r.seed], 0) >= 3 THEN 'seed_budget' ELSE 'enqueued' END AS now FROM {state} s JOIN {rows} r ON r.i = s.i + 1)))"""
_HOST_OF = "regexp_replace(regexp_extract({u}, '^https?://([^/?#:]+)', 1), '^www\\.', '')"
_JUDGED = """(SELECT {cols}, arg_max(p.domain, length(p.domain)) AS domain, arg_max(p.prefixes, length(p.domain)) AS prefixes, arg_max(p.cap, length(p.domain)) AS cap FROM {rows} LEFT JOIN pol p ON {host} = p.domain OR ends_with({host}, '.' || p.domain) GROUP BY {cols})"""
_REFUSED = "CASE WHEN domain IS NULL OR NOT (len(prefixes) = 0 OR len(list_filter(prefixes, lambda x: starts_with(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), x))) > 0) THEN 'scope' END"


def _budget_sql() -> str:
    policy = ", ".join(f"('{d}', CAST([{', '.join(repr(x) for x in p)}] AS VARCHAR[]), {60 if d == 'example.com' else 120})" for d, p in POLICY)
    host = _HOST_OF.format(u="url")
    fold = lambda state, rows, start: _FOLD.format(state=state, rows=rows, start=start)
    return f"""WITH RECURSIVE {_EDGES}, pol(domain, prefixes, cap) AS (VALUES {policy}), off0 AS (SELECT page_id AS o, {_URL} AS url, {_URL} AS seed FROM pages),
jud0 AS {_JUDGED.format(cols="o, url, seed", rows="off0", host=host)}, rows0 AS (SELECT row_number() OVER (ORDER BY o) AS i, url, 0 AS depth, seed, domain, cap, {_REFUSED} AS status FROM jud0),
{fold("f0", "rows0", "CAST(0 AS BIGINT) AS total, CAST(MAP {} AS MAP(VARCHAR, BIGINT)) AS dom, CAST(MAP {} AS MAP(VARCHAR, BIGINT)) AS sd, CAST([] AS VARCHAR[]) AS taken, CAST(NULL AS VARCHAR) AS st, CAST(NULL AS VARCHAR) AS url, 0 AS depth, CAST(NULL AS VARCHAR) AS seed")},
done0 AS (SELECT i, st, url, depth, seed FROM f0 WHERE i > 0), off1 AS (SELECT d.i AS pi, min(e.k) AS k, e.to_url AS url, d.seed FROM done0 d JOIN (SELECT from_url, to_url, min(k) AS k FROM edges GROUP BY 1, 2) e ON e.from_url = d.url WHERE d.st = 'enqueued' GROUP BY d.i, e.to_url, d.seed),
jud1 AS {_JUDGED.format(cols="pi, k, url, seed", rows="off1", host=host)}, rows1 AS (SELECT row_number() OVER (ORDER BY pi, k) AS i, url, 1 AS depth, seed, domain, cap, {_REFUSED} AS status FROM jud1),
{fold("f1", "rows1", "total, dom, sd, taken, CAST(NULL AS VARCHAR) AS st, CAST(NULL AS VARCHAR) AS url, 0 AS depth, CAST(NULL AS VARCHAR) AS seed FROM (SELECT * FROM f0 ORDER BY i DESC LIMIT 1)")},
every AS (SELECT st, url, depth FROM done0 UNION ALL SELECT st, url, depth FROM f1 WHERE i > 0) """


@query(_budget_sql() + "SELECT st AS status, count(*) AS n FROM every GROUP BY 1")
def frontier_budget(spark, sf_dir):
    return frontier.snapshot(_budgeted(spark, sf_dir))


@query(_budget_sql() + "SELECT url, depth FROM every WHERE st = 'enqueued'")
def frontier_budget_urls(spark, sf_dir):
    return _budgeted(spark, sf_dir).where("status = 'enqueued'").select("url", "depth")


def _budgeted(spark, sf_dir) -> DataFrame:
    """A global cap, one for each seed, and one for each domain that one domain has of its own."""
    return _frontier(spark, sf_dir, _policy(spark).withColumn("max_pages", F.when(F.col("domain") == "example.com", 60)), global_cap=200, domain_cap=120, seed_cap=3)


# the crawl, over pages in place of the network

#: Domains of the offline crawl.
_WEB = (("example.com", ()), ("example.net", ("/de", "/en", "/fr")), ("example.org", ()))


def plain_text(page: str) -> str:
    """Everything outside tags: an extractor that SQL can say."""
    import re

    return re.sub(r"[ \t\n\f\r]+", " ", re.sub(r"<[^>]*>", " ", page)).strip()


def _crawl(spark, sf_dir, mode: str = "crawl"):
    import uuid

    from .plans.crawl import Crawl
    from .plans.storage import folder
    from .sources.crawl_store import CrawlStore

    pages = table(spark, sf_dir, "pages")
    seeds = pages.groupBy(U.host(F.col("url")).alias("host")).agg(F.min_by("url", "page_id").alias("url"), F.min("page_id").alias("ord")).select("ord", "url")
    domains = spark.createDataFrame([(d, list(p)) for d, p in _WEB], "domain string, prefixes array<string>")
    store = CrawlStore(spark, f"{folder(spark)}/crawl-{uuid.uuid4().hex}")
    run = Crawl(store, domains, seeds, fetch.from_table(pages), max_depth=1, extractor=plain_text, now="2024-01-01T00:00:00+00:00")
    return store, run.run(mode)


_PLAIN = r"trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))"
_TITLE = r"trim(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '\s+', ' ', 'g'))"
_OFFLINE = rf"""WITH {_EDGES}, pol(domain, prefixes) AS (VALUES {", ".join(f"('{d}', CAST([{', '.join(repr(x) for x in p)}] AS VARCHAR[]))" for d, p in _WEB)}),
web AS (SELECT {_URL} AS url, arg_min({_PLAIN}, url) AS text, arg_min({_TITLE}, url) AS title FROM pages GROUP BY 1), home AS (SELECT {_HOST_OF.format(u="url")} AS host, min(url) AS url FROM web GROUP BY 1),
good AS (SELECT url, title, text FROM web WHERE length(text) >= 60 AND len(regexp_extract_all(text, '[\p{{L}}\p{{M}}\p{{Nd}}_]+')) >= 20),
inside AS (SELECT u AS url FROM (SELECT u, arg_max(prefixes, length(domain)) AS prefixes FROM (SELECT url AS u FROM web UNION SELECT to_url FROM edges), pol WHERE {_HOST_OF.format(u="u")} = domain OR ends_with({_HOST_OF.format(u="u")}, '.' || domain) GROUP BY u) WHERE len(prefixes) = 0 OR len(list_filter(prefixes, lambda x: starts_with(regexp_extract(u, '^https?://[^/?#]+([^?#]*)', 1), x))) > 0),
seeds AS (SELECT arg_min({_URL}, page_id) AS url, min(page_id) AS o FROM pages GROUP BY {_HOST}), level0 AS (SELECT url, min(o) AS o FROM seeds WHERE url IN (SELECT url FROM inside) GROUP BY 1),
doc0 AS (SELECT l.url, l.url AS final_url, l.o FROM level0 l JOIN good USING (url)),
link1 AS (SELECT d.o, min(e.k) AS k, e.to_url AS url FROM doc0 d JOIN edges e ON e.from_url = d.url WHERE e.to_url IN (SELECT url FROM inside) GROUP BY 1, 3),
level1 AS (SELECT url, min((o, k)) AS place FROM link1 WHERE url NOT IN (SELECT url FROM level0) GROUP BY 1),
got1 AS (SELECT l.url, l.place, coalesce(w.url, h.url) AS final_url FROM level1 l LEFT JOIN web w ON w.url = l.url LEFT JOIN home h ON h.host = {_HOST_OF.format(u="l.url")}),
new1 AS (SELECT arg_min(url, place) AS url, final_url FROM got1 WHERE final_url IN (SELECT url FROM good) AND final_url NOT IN (SELECT final_url FROM doc0) GROUP BY final_url),
docs AS (SELECT url, final_url FROM doc0 UNION ALL SELECT url, final_url FROM new1)"""


@query(f"{_OFFLINE} SELECT d.url, d.final_url, g.title, sha1(g.text) AS text_sha1, {_HOST_OF.format(u='d.final_url')} AS source_domain, 'html' AS content_kind FROM docs d JOIN good g ON g.url = d.final_url")
def crawl_documents(spark, sf_dir):
    store, _ = _crawl(spark, sf_dir)
    return store.documents().select("url", "final_url", "title", F.sha1("text").alias("text_sha1"), "source_domain", "content_kind")


@query(f"""{_OFFLINE} SELECT 'frontier_enqueued' AS name, (SELECT count(*) FROM level0) + (SELECT count(*) FROM level1) AS n UNION ALL SELECT 'fetched_ok', (SELECT count(*) FROM level0) + (SELECT count(*) FROM got1 WHERE final_url IS NOT NULL) UNION ALL SELECT 'fetched_error', (SELECT count(*) FROM got1 WHERE final_url IS NULL)
UNION ALL SELECT 'parsed_ok', (SELECT count(*) FROM doc0) + (SELECT count(*) FROM got1 WHERE final_url IN (SELECT url FROM good)) UNION ALL SELECT 'parsed_error', (SELECT count(*) FROM level0 WHERE url NOT IN (SELECT url FROM good)) + (SELECT count(*) FROM got1 WHERE final_url IS NOT NULL AND final_url NOT IN (SELECT url FROM good)) UNION ALL SELECT 'stored_docs', (SELECT count(*) FROM docs)""")
def crawl_counters(spark, sf_dir):
    _, result = _crawl(spark, sf_dir)
    names = ("frontier_enqueued", "fetched_ok", "fetched_error", "parsed_ok", "parsed_error", "stored_docs")
    return spark.createDataFrame([(n, int(result["stats"][n])) for n in names], "name string, n long")


@query(f"{_OFFLINE} SELECT url FROM level0 UNION ALL SELECT url FROM level1")
def crawl_visited(spark, sf_dir):
    store, _ = _crawl(spark, sf_dir)
    return store.visited()


@query(rf"""{_OFFLINE}, l1 AS (SELECT l.url, min(e.k) AS k FROM level0 l JOIN edges e ON e.from_url = l.url GROUP BY 1), t1 AS (SELECT DISTINCT e.to_url AS url FROM level0 l JOIN edges e ON e.from_url = l.url WHERE e.to_url IN (SELECT url FROM inside) AND e.to_url NOT IN (SELECT url FROM level0)),
g1 AS (SELECT t.url, coalesce(w.url, h.url) AS final_url FROM t1 t LEFT JOIN web w ON w.url = t.url LEFT JOIN home h ON h.host = {_HOST_OF.format(u="t.url")})
SELECT url, url AS final_url, 200 AS status_code FROM level0 UNION ALL SELECT url, coalesce(final_url, url), CASE WHEN final_url IS NULL THEN 404 ELSE 200 END FROM g1""")
def crawl_fetch_only(spark, sf_dir):
    store, _ = _crawl(spark, sf_dir, "fetch_only")
    return store.url_meta().select("url", "final_url", "status_code")


@query(r"SELECT page_id, trim(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '\s+', ' ', 'g')) AS title FROM pages")
def html_title(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.html_title(F.col("html")).alias("title"))


@query()
def html_text(spark, sf_dir):
    return html.parse(table(spark, sf_dir, "pages")).select("page_id", "title", "text", "error")


@query(rf"""WITH t AS (SELECT page_id, {_PLAIN} AS text, {_TITLE} AS title FROM pages), c AS (SELECT *, length(text) AS chars, len(regexp_extract_all(text, '[\p{{L}}\p{{M}}\p{{Nd}}_]+')) AS words FROM t),
e AS (SELECT *, concat_ws('; ', CASE WHEN chars < 900 THEN 'chars=' || chars || ' < min_text_chars=900' END, CASE WHEN words < 150 THEN 'words=' || words || ' < min_text_words=150' END) AS failed FROM c)
SELECT page_id, title, CASE WHEN text = '' OR failed <> '' THEN sha1('') ELSE sha1(text) END AS text_sha1, CASE WHEN text = '' THEN 'No extractable text from HTML' WHEN failed <> '' THEN 'Filtered text did not meet quality thresholds: ' || failed END AS error FROM e""")
def html_gate(spark, sf_dir):
    return html.parse(table(spark, sf_dir, "pages"), plain_text, 900, 150).select("page_id", "title", F.sha1("text").alias("text_sha1"), "error")


_PDF = r"""pages AS (SELECT doc_id // 10 AS pdf, doc_id % 10 AS page, text FROM documents), lines AS (SELECT pdf, page, k, line FROM (SELECT pdf, page, unnest(range(len(string_split(text, chr(10))))) AS k, trim(regexp_replace(unnest(string_split(text, chr(10))), '\s+', ' ', 'g')) AS line FROM pages) WHERE line <> ''),
keyed AS (SELECT *, trim(regexp_replace(lower(line), '[^\p{L}\p{N}_]+', ' ', 'g')) AS key,
  (length(line) <= 180 AND (regexp_matches(lower(line), '^\s*page\s+\d+\s*(of\s*\d+)?\s*$') OR regexp_matches(lower(line), '^\s*\d+\s*/\s*\d+\s*$') OR regexp_matches(lower(line), '\b(all rights reserved|confidential|do not distribute|printed on)\b')))
  OR (length(line) < 120 AND length(line) - length(replace(line, '|', '')) >= 3) AS furniture FROM lines),
freq AS (SELECT pdf, key, count(DISTINCT page) AS n FROM keyed GROUP BY ALL), total AS (SELECT pdf, count(DISTINCT page) AS pages FROM pages GROUP BY 1),
marked AS (SELECT pdf, page, k, line, pages, furniture, NOT furniture AND n >= greatest(2, floor(pages * 0.6)) AND length(line) <= 120 AS repeated FROM keyed JOIN freq USING (pdf, key) JOIN total USING (pdf))"""


def _pdf_pages(spark, sf_dir) -> DataFrame:
    return _docs(spark, sf_dir).select(F.expr("doc_id div 10").alias("doc_id"), (F.col("doc_id") % 10).alias("page"), "text")


@query(f"WITH {_PDF} SELECT pdf, count(*) AS n_lines, count(*) FILTER (furniture) AS n_boilerplate, count(*) FILTER (repeated) AS n_repeated FROM marked GROUP BY 1")
def pdf_line_filter(spark, sf_dir):
    marked = pdf.drop_repeated(pdf.lines(_pdf_pages(spark, sf_dir)))
    return marked.groupBy(F.col("doc_id").alias("pdf")).agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("drop") == "boilerplate").alias("n_boilerplate"), F.count_if(F.col("drop") == "repeated").alias("n_repeated"))


@query(r"""SELECT pdf AS doc_id, sum(len(regexp_extract_all(text, '[A-Za-z0-9'']+'))) < 30 OR sum(length(text)) < 180 AS low_signal FROM (SELECT doc_id // 10 AS pdf, doc_id % 10 AS page, text, row_number() OVER (PARTITION BY doc_id // 10 ORDER BY doc_id) AS k FROM documents) WHERE k <= 2 GROUP BY 1""")
def pdf_low_signal(spark, sf_dir):
    """Of each document the first two pages."""
    return pdf.low_signal(pdf.page_window(_pdf_pages(spark, sf_dir), 2))


def _profile(p: pdf.Profile) -> str:
    return f"length(chunk) >= {p.min_chars} AND len(tok) >= {p.min_words} AND alpha / solid >= {p.min_alpha} AND digits / solid <= {p.max_digit} AND punct / solid <= {p.max_punctuation} AND (len(tok) < 18 OR len(list_distinct(list_transform(tok, lambda t: lower(t)))) / len(tok) >= {p.min_unique})"


_PDF_CHUNKS = rf"""perpage AS (SELECT pdf, page, list(line ORDER BY k) AS l FROM marked WHERE NOT furniture AND NOT repeated GROUP BY 1, 2),
folded AS (SELECT pdf, page, list_reduce(list_transform(l, lambda x: {{'d': CAST([] AS VARCHAR[]), 'c': x}}), lambda a, x: CASE WHEN length(CASE WHEN a.c = '' THEN x.c ELSE a.c || ' ' || x.c END) >= 420 OR regexp_matches(x.c, '[.!?:]$') THEN {{'d': list_append(a.d, CASE WHEN a.c = '' THEN x.c ELSE a.c || ' ' || x.c END), 'c': ''}}
  ELSE {{'d': a.d, 'c': CASE WHEN a.c = '' THEN x.c ELSE a.c || ' ' || x.c END}} END, {{'d': CAST([] AS VARCHAR[]), 'c': ''}}) AS f FROM perpage),
listed AS (SELECT pdf, page, list_concat(f.d, CASE WHEN f.c <> '' THEN [f.c] ELSE CAST([] AS VARCHAR[]) END) AS l FROM folded), chunks AS (SELECT pdf, page, unnest(range(len(l))) AS k, unnest(l) AS chunk FROM listed),
sized AS (SELECT *, CAST(greatest(1, length(regexp_replace(chunk, '\s+', '', 'g'))) AS DOUBLE) AS solid, length(regexp_replace(chunk, '[^\p{{L}}]', '', 'g')) AS alpha, length(regexp_replace(chunk, '[^\p{{Nd}}]', '', 'g')) AS digits, length(regexp_replace(chunk, '[^!-/:-@\[-`{{-~]', '', 'g')) AS punct, regexp_extract_all(chunk, '[A-Za-z0-9'']+') AS tok, trim(regexp_replace(lower(chunk), '[^\p{{L}}\p{{N}}_]+', ' ', 'g')) AS key FROM chunks)"""


def _pdf_side(name: str, p: pdf.Profile) -> str:
    return f"""{name}0 AS (SELECT *, {_profile(p)} AS passed FROM sized), {name}1 AS (SELECT *, row_number() OVER (PARTITION BY pdf, passed, key ORDER BY page, k) = 1 AS first FROM {name}0),
{name} AS (SELECT pdf, coalesce(string_agg(chunk, chr(10) || chr(10) ORDER BY page, k) FILTER (passed AND first), '') AS text, count(*) FILTER (passed AND first) AS kept, count(*) FILTER (NOT passed) AS low, count(*) FILTER (passed AND NOT first) AS twice, count(*) AS n FROM {name}1 GROUP BY 1)"""


@query(rf"""WITH {_PDF}, {_PDF_CHUNKS}, {_pdf_side("s", pdf.STRICT)}, {_pdf_side("r", pdf.RELAXED)}, lined AS (SELECT pdf, any_value(pages) AS pages, count(*) FILTER (furniture) AS boiler, count(*) FILTER (repeated) AS often FROM marked GROUP BY 1),
j AS (SELECT l.*, coalesce(s.text, '') AS st, coalesce(r.text, '') AS rt, s.kept AS sk, s.low AS sl, s.twice AS s2, r.kept AS rk, r.low AS rl, r.twice AS r2, coalesce(s.n, 0) AS n FROM lined l LEFT JOIN s USING (pdf) LEFT JOIN r USING (pdf)),
o AS (SELECT *, length(st) >= 180 AND len(regexp_extract_all(st, '[A-Za-z0-9'']+')) >= 30 AS so, length(rt) >= 180 AND len(regexp_extract_all(rt, '[A-Za-z0-9'']+')) >= 30 AS ro FROM j), m AS (SELECT *, CASE WHEN so THEN 'strict' WHEN ro THEN 'relaxed' WHEN length(rt) > length(st) THEN 'relaxed_partial' ELSE 'strict' END AS mode FROM o)
SELECT pdf AS doc_id, sha1(CASE WHEN so OR ro THEN CASE WHEN mode = 'strict' THEN st ELSE rt END ELSE '' END) AS text_sha1, CASE WHEN NOT (so OR ro) THEN 'Filtered PDF text did not meet quality thresholds' END AS error, mode AS quality_mode, pages AS pages_total, n AS chunks_input, coalesce(CASE WHEN mode = 'strict' THEN sk ELSE rk END, 0) AS chunks_kept, boiler AS dropped_boilerplate, often AS dropped_repeated,
coalesce(CASE WHEN mode = 'strict' THEN sl ELSE rl END, 0) AS dropped_quality, coalesce(CASE WHEN mode = 'strict' THEN s2 ELSE r2 END, 0) AS dropped_duplicate, length(CASE WHEN mode = 'strict' THEN st ELSE rt END) AS clean_chars FROM m""")
def pdf_cascade(spark, sf_dir):
    counts = ("pages_total", "chunks_input", "chunks_kept", "dropped_boilerplate", "dropped_repeated", "dropped_quality", "dropped_duplicate", "clean_chars")
    return pdf.cascade(pdf.lines(_pdf_pages(spark, sf_dir))).select("doc_id", F.sha1("text").alias("text_sha1"), "error", "quality_mode", *(F.col(c).cast("long").alias(c) for c in counts))


# identifiers and payloads


@query("SELECT doc_id, sha1(source || chr(10) || sha256(text) || chr(10) || left(text, 512)) AS hash FROM documents")
def doc_id_hash(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", H.document_id(F.col("source"), F.sha2("text", 256), F.col("text")).alias("hash"))


@query("""SELECT doc_id, sha1('{"doc_id": "' || doc_id || '", "text": "' || replace(replace(replace(text, chr(92), chr(92) || chr(92)), '"', chr(92) || '"'), chr(10), chr(92) || 'n') || '", "title": "None", "url": "' || source || '"}') AS uid FROM documents""")
def chunk_uid_hash(spark, sf_dir):
    none = F.lit(None).cast("string")
    return _docs(spark, sf_dir).select("doc_id", H.chunk_uid(none, F.lit(" "), F.col("doc_id"), F.col("text"), none, F.col("source")).alias("uid"))


@query("SELECT e.vec_id, d.source, d.lang FROM embeddings e LEFT JOIN documents d ON e.vec_id = d.doc_id")
def store_join_left(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id")
    store = _docs(spark, sf_dir).select(F.col("doc_id").alias("vec_id"), "source", "lang")
    return bm25.with_payload(rows, store, "vec_id")


@query("SELECT DISTINCT source AS value FROM documents UNION SELECT DISTINCT lang FROM documents")
def parsed_urls(spark, sf_dir):
    from .sources.readers import parsed_urls as urls

    return urls(_docs(spark, sf_dir).select(F.col("source").alias("url"), F.col("lang").alias("final_url"))).withColumnRenamed("url", "value")


@query("SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS row_id FROM embeddings")
def row_numbering(spark, sf_dir):
    from .sources.readers import number_rows

    return number_rows(table(spark, sf_dir, "embeddings").select("vec_id"), "vec_id").select("vec_id", "row_id")


@query("SELECT source AS chunk_uid, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def chunk_store_first_wins(spark, sf_dir):
    from .sources.readers import chunk_store

    return chunk_store(_docs(spark, sf_dir).select(F.col("doc_id").alias("row_id"), F.col("source").alias("chunk_uid"), "doc_id"))


# retrieval

_BM25 = """tf AS (SELECT doc_id AS row_id, t AS term, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[A-Za-z0-9_]+')) AS t FROM documents) GROUP BY ALL),
dl AS (SELECT row_id, sum(tf) AS dl FROM tf GROUP BY 1), meta AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
raw AS (SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS raw FROM df, meta), terms AS (SELECT term, df, CASE WHEN raw >= 0 THEN raw ELSE 0.25 * (SELECT avg(raw) FROM raw) END AS idf FROM raw)"""
_ASKED = "asked AS (SELECT item_id AS query_id, t AS term, count(*) AS qf FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[A-Za-z0-9_]+')) AS t FROM benchmark) GROUP BY ALL)"
_SCORED = "scored AS (SELECT query_id, row_id, round(sum(qf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 6) AS score FROM tf JOIN terms USING (term) JOIN asked USING (term) JOIN dl USING (row_id), meta GROUP BY ALL)"
_SPARSE = "SELECT query_id, row_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id) AS rank FROM scored"


def _index(spark, sf_dir) -> bm25.Bm25Index:
    return bm25.build(_docs(spark, sf_dir), "doc_id")


def _questions(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


@query(f"WITH {_BM25} SELECT (SELECT n FROM meta) AS n, round((SELECT avgdl FROM meta), 6) AS avgdl, (SELECT count(*) FROM df) AS n_terms, (SELECT count(*) FROM tf) AS n_postings")
def bm25_index_stats(spark, sf_dir):
    index = _index(spark, sf_dir)
    return index.terms.agg(F.lit(index.n).alias("n"), F.round(F.lit(index.avgdl), 6).alias("avgdl"), F.count(F.lit(1)).alias("n_terms"), F.sum("df").alias("n_postings"))


@query(f"WITH {_BM25} SELECT term, df, round(idf, 9) AS idf FROM terms")
def bm25_idf(spark, sf_dir):
    return _index(spark, sf_dir).terms.select("term", "df", F.round("idf", 9).alias("idf"))


@query(f"WITH {_BM25}, {_ASKED}, {_SCORED} SELECT * FROM ({_SPARSE}) WHERE rank <= 5")
def bm25_topk(spark, sf_dir):
    return bm25.search(_index(spark, sf_dir), _questions(spark, sf_dir), 5, digits=6).withColumn("rank", F.col("rank").cast("long"))


_CUT = "regexp_extract_all(lower(text), '[a-z0-9-]+')"
_DASHED = f"""tf AS (SELECT doc_id AS row_id, t AS term, count(*) AS tf FROM (SELECT doc_id, unnest(list_filter({_CUT}, lambda t: length(t) >= 3)) AS t FROM documents) GROUP BY ALL),
dl AS (SELECT row_id, sum(tf) AS dl FROM tf GROUP BY 1), meta AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1), raw AS (SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS raw FROM df, meta), terms AS (SELECT term, df, CASE WHEN raw >= 0 THEN raw ELSE 0.25 * (SELECT avg(raw) FROM raw) END AS idf FROM raw),
asked AS (SELECT item_id AS query_id, t AS term, count(*) AS qf FROM (SELECT item_id, unnest(list_filter({_CUT}, lambda t: length(t) >= 3)) AS t FROM benchmark) GROUP BY ALL)"""


@query(f"WITH {_DASHED}, {_SCORED} SELECT * FROM ({_SPARSE}) WHERE rank <= 5")
def bm25_custom_tokens(spark, sf_dir):
    """An index with a tokenizer of its own, written, read back and searched with the settings it holds."""
    import uuid

    from .plans.storage import folder

    path = f"{folder(spark)}/index-{uuid.uuid4().hex}"
    bm25.build(_docs(spark, sf_dir), "doc_id", pattern="[a-z0-9-]+", min_length=3).write(path)
    return bm25.search(bm25.Bm25Index.read(spark, path), _questions(spark, sf_dir), 5, digits=6).withColumn("rank", F.col("rank").cast("long"))


@query(f"""WITH {_BM25}, long_word AS (SELECT item_id, regexp_extract(text, '[A-Za-z]{{{{13,}}}}') AS text FROM benchmark), asked AS (SELECT item_id AS query_id, t AS term, count(*) AS qf FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[A-Za-z0-9_]+')) AS t FROM long_word) GROUP BY ALL), {_SCORED},
low AS (SELECT row_id FROM dl ORDER BY row_id LIMIT 10), padded AS (SELECT query_id, row_id, score FROM scored UNION ALL SELECT query_id, row_id, 0.0 FROM (SELECT DISTINCT query_id FROM asked), low WHERE NOT EXISTS (SELECT 1 FROM scored s WHERE s.query_id = asked.query_id AND s.row_id = low.row_id))
SELECT * FROM (SELECT query_id, row_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id) AS rank FROM padded) WHERE rank <= 5""".replace("{{", "{").replace("}}", "}").replace("(SELECT DISTINCT query_id FROM asked), low", "(SELECT DISTINCT query_id FROM asked) AS asked, low"))
def bm25_padded(spark, sf_dir):
    """Questions of one long word, which few rows hold: the rest of the five are rows without a match."""
    rare = _questions(spark, sf_dir).withColumn("text", F.regexp_extract("text", "[A-Za-z]{13,}", 0))
    return bm25.search(_index(spark, sf_dir), rare, 5, True, 6).withColumn("rank", F.col("rank").cast("long"))


@query(r"""WITH c AS (SELECT trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents), n AS (SELECT t, len(list_filter(regexp_extract_all(lower(t), '[A-Za-z0-9_]+'), lambda x: length(x) >= 12)) AS k FROM c)
SELECT count(*) AS input_rows, count(*) FILTER (k > 0) AS indexed_rows, count(*) FILTER (t = '') AS skipped_empty_text, count(*) FILTER (t <> '' AND k = 0) AS skipped_empty_tokens FROM n""")
def bm25_build_counts(spark, sf_dir):
    return bm25.build_counts(_docs(spark, sf_dir), settings=bm25.Settings(min_length=12))


def _vectors(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Vectors scaled so that metrics differ, and those whose id is divisible by 50 as queries."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_id"), F.transform("embedding", lambda x: x.cast("double") * (1 + F.col("vec_id") % 3)).alias("embedding"))
    asked = rows.where("row_id % 50 = 0").select(F.col("row_id").alias("query_id"), F.col("embedding").alias("vector"))
    return rows, asked


_VECTORS = "v AS (SELECT vec_id AS row_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * (1 + vec_id % 3)) AS e FROM embeddings), q AS (SELECT row_id AS query_id, e AS f FROM v WHERE row_id % 50 = 0)"
#: As queries the vectors of the questions' own ids.
_OWN_VECTORS = _VECTORS.replace("WHERE row_id % 50 = 0", "WHERE row_id IN (SELECT item_id FROM benchmark)")
_METRIC = {"cosine": "list_dot_product(e, f) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(f, f)))", "ip": "list_dot_product(e, f)", "l2": "-(list_dot_product(e, e) + list_dot_product(f, f) - 2 * list_dot_product(e, f))"}


def _dense_sql(metric: str, k: int) -> str:
    return f"SELECT * FROM (SELECT query_id, row_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id) AS rank FROM (SELECT query_id, row_id, round({_METRIC[metric]}, 6) + 0.0 AS score FROM v, q)) WHERE rank <= {k}"


def _dense_query(metric: str):
    def run(spark, sf_dir):
        return dense.search_blocks(*_vectors(spark, sf_dir), 3, metric).withColumn("rank", F.col("rank").cast("long"))

    run.__name__ = f"dense_topk_{metric}"
    return run


for _m in dense.METRICS:
    query(f"WITH {_VECTORS} {_dense_sql(_m, 3)}")(_dense_query(_m))


@query(f"WITH {_VECTORS} {_dense_sql('cosine', 5)}")
def dense_topk_builtin(spark, sf_dir):
    return dense.search(*_vectors(spark, sf_dir), 5, "cosine").withColumn("rank", F.col("rank").cast("long"))


@query(f"WITH {_VECTORS}, found AS ({_dense_sql('l2', 4)}) SELECT query_id, f.row_id, rank, score, 'l2' AS metric, -score AS distance, d.source FROM found f LEFT JOIN documents d ON d.doc_id = f.row_id")
def dense_results_l2(spark, sf_dir):
    store = _docs(spark, sf_dir).select(F.col("doc_id").alias("row_id"), "source")
    found = dense.search_blocks(*_vectors(spark, sf_dir), 4, "l2").withColumn("rank", F.col("rank").cast("long"))
    return bm25.results(found, store, "l2").select("query_id", "row_id", "rank", "score", "metric", "distance", "source")


@query("SELECT vec_id, round(sqrt(list_dot_product(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), list_transform(embedding, lambda x: CAST(x AS DOUBLE)))), 6) AS norm, CAST(1.0 AS DOUBLE) AS unit FROM embeddings")
def vector_norms(spark, sf_dir):
    e = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(V.norm(e), 6).alias("norm"), F.round(V.norm(V.l2_normalize(e)), 6).alias("unit"))


def _hybrid(spark, sf_dir, weights: tuple[float, float]) -> DataFrame:
    deep, (rows, _) = 50, _vectors(spark, sf_dir)
    own = rows.join(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("row_id")), "row_id", "left_semi").select(F.col("row_id").alias("query_id"), F.col("embedding").alias("vector"))
    sides = dense.search_blocks(rows, own, deep, "cosine"), bm25.search(_index(spark, sf_dir), _questions(spark, sf_dir), deep, digits=6)
    fused = fusion.fuse(*(s.withColumnRenamed("row_id", "uid") for s in sides), 5, 60, *weights, digits=12)
    return fused.select("query_id", "uid", "score", F.col("dense_rank").cast("long").alias("dense_rank"), F.col("sparse_rank").cast("long").alias("sparse_rank"), F.col("rank").cast("long").alias("rank"))


def _hybrid_sql(a: float, b: float) -> str:
    return f"""WITH {_BM25}, {_ASKED}, {_SCORED}, {_OWN_VECTORS}, s AS (SELECT query_id, row_id AS uid, rank AS sr FROM ({_SPARSE}) WHERE rank <= 50), d AS (SELECT query_id, row_id AS uid, rank AS dr FROM ({_dense_sql("cosine", 50)})),
f AS (SELECT query_id, uid, round(coalesce(CAST({a} AS DOUBLE) / (60 + dr), 0.0) + coalesce(CAST({b} AS DOUBLE) / (60 + sr), 0.0), 12) AS score, dr AS dense_rank, sr AS sparse_rank FROM d FULL JOIN s USING (query_id, uid))
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, coalesce(dense_rank, 1000000000), coalesce(sparse_rank, 1000000000), uid) AS rank FROM f) WHERE rank <= 5"""


@query(_hybrid_sql(1.0, 1.0))
def hybrid_rrf(spark, sf_dir):
    return _hybrid(spark, sf_dir, (1.0, 1.0))


@query(_hybrid_sql(0.3, 1.0))
def hybrid_rrf_weighted(spark, sf_dir):
    return _hybrid(spark, sf_dir, (0.3, 1.0))


# prompts, answers, models


@query("SELECT conv_id, string_agg('[' || (turn + 1) || '] (title: ' || role || '; source: unknown)' || chr(10) || trim(text), chr(10) || chr(10) ORDER BY turn) AS context FROM conversations GROUP BY 1")
def prompt_context(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    found = turns.select(F.col("conv_id").alias("query_id"), F.concat_ws("-", "conv_id", "turn").alias("row_id"), (F.col("turn") + 1).alias("rank"), F.lit(0.0).alias("score"))
    store = turns.select(F.concat_ws("-", "conv_id", "turn").alias("row_id"), "text", F.col("role").alias("title"), F.lit(None).cast("string").alias("url"))
    return rag.contexts(found, store).select(F.col("query_id").alias("conv_id"), "context")


@query("SELECT conv_id, turn + 1 AS rank, conv_id || '-' || turn AS chunk_uid, role AS title, trim(text) AS text, 0.0 AS score, '{}' AS metadata FROM conversations")
def retrieved_docs(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    uid = F.concat_ws("-", "conv_id", "turn")
    found = turns.select(F.col("conv_id").alias("query_id"), uid.alias("row_id"), (F.col("turn") + 1).alias("rank"), F.lit(0.0).alias("score"))
    store = turns.select(uid.alias("row_id"), uid.alias("chunk_uid"), "text", F.col("role").alias("title"))
    return rag.retrieved(found, store).select(F.col("query_id").alias("conv_id"), F.inline("docs")).drop("url")


@query(f"""WITH {_BM25}, {_ASKED}, {_SCORED}, best AS (SELECT query_id, row_id FROM ({_SPARSE}) WHERE rank = 1)
SELECT query_id, list_filter(list_transform(string_split(replace(trim(text), chr(10), ' '), '. '), lambda s: trim(s)), lambda s: s <> '')[1] AS answer FROM best JOIN documents ON doc_id = row_id""")
def answer_batch(spark, sf_dir):
    questions = _questions(spark, sf_dir)
    found = rag.search(questions, 3, "sparse", _index(spark, sf_dir))
    store = _docs(spark, sf_dir).select(F.col("doc_id").alias("row_id"), "text", F.lit(None).cast("string").alias("title"), F.col("source").alias("url"))
    return rag.answer(questions, found, store)


@query()
def language_labels(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    predict = classify.label_column(classify.learn_labels(docs))
    return docs.select("doc_id", F.try_element_at(predict(F.col("text")), F.lit(1)).alias("best")).select("doc_id", "best.label", "best.score")


@query()
def embed_documents(spark, sf_dir):
    return classify.encode(_docs(spark, sf_dir).where("trim(text) != ''").select("doc_id", "text"), T.normalize_text(F.col("text"))).select("doc_id", "embedding")


@query("SELECT lang, count(*) AS n, count(*) FILTER (lang = 'en') AS kept FROM documents GROUP BY 1")
def lang_filter_counts(spark, sf_dir):
    return _docs(spark, sf_dir).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("lang") == "en").alias("kept"))


@query("SELECT source, doc_id, rank FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents) WHERE rank <= 3")
def topk_per_group(spark, sf_dir):
    rank = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id"))
    return _docs(spark, sf_dir).select("source", "doc_id", rank.cast("long").alias("rank")).where("rank <= 3")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BM25 passages for the benchmark questions, with their payload."""
    store = _docs(spark, sf_dir).select(F.col("doc_id").alias("row_id"), "source", "lang", T.preview(F.col("text")).alias("preview"))
    return bm25.with_payload(bm25_topk(spark, sf_dir), store)
