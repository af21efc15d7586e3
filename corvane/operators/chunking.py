"""Chunking: sentence packing with overlap, block filters, first-wins deduplication, chunk numbering, rejects."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from itertools import accumulate
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..batches import bounded_batches, freed
from ..functions import hashing as H
from ..functions import text as T
from . import stats


@dataclass(frozen=True)
class ChunkConfig:
    max_block_words: int = 45
    min_block_words: int = 0
    min_block_chars: int = 0
    overlap_sentences: int = 1
    max_pipe_share: float = 0.05
    max_dash_share: float = 0.05
    keep_labels: tuple[str, ...] = ("en",)
    min_label_score: float = 0.5
    dedup: bool = True

    def __post_init__(self):
        if self.max_block_words <= 0 or min(self.min_block_words, self.min_block_chars, self.overlap_sentences) < 0 or self.min_block_words > self.max_block_words:
            raise ValueError("block limits must not be negative, max_block_words must be positive and at least min_block_words")
        if not 0 <= self.min_label_score <= 1 or min(self.max_pipe_share, self.max_dash_share) < 0:
            raise ValueError("shares must not be negative, min_label_score must be within 0 and 1")


def pack(sentences: list[str], most: int, overlap: int = 0) -> list[str]:
    """Sentences joined into blocks of at most `most` words.

    A block is a run of sentences; the next one begins up to `overlap` sentences earlier, as far as they leave room for
    the sentence that didn't fit. A longer sentence is cut into slices of its own, which no block reaches across.
    """
    ends = [0, *accumulate(len(s.split()) for s in sentences)]
    blocks: list[str] = []
    begin = 0
    for k, sentence in enumerate(sentences):
        if ends[k + 1] - ends[k] > most:
            words = sentence.split()
            blocks += [" ".join(sentences[begin:k])] * (begin < k) + [" ".join(words[a : a + most]) for a in range(0, len(words), most)]
            begin = k + 1
        elif begin < k and ends[k + 1] - ends[begin] > most:
            blocks.append(" ".join(sentences[begin:k]))
            # the first place from which all up to this sentence fits
            begin = next(i for i in range(max(begin, k - overlap), k + 1) if ends[k + 1] - ends[i] <= most)
    return blocks + [" ".join(sentences[begin:])] * (begin < len(sentences))


def split_blocks(docs: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:
    """(doc_seq, doc_id, block_id, text, word_count, char_count). docs: doc_seq, doc_id, text.

    Packing is a fold whose state grows with the text, so it runs over Arrow batches; all else is built in. Blocks
    below the minimums vanish before block_id is given.
    """

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                packed = [pack(s or [], config.max_block_words, config.overlap_sentences) for s in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.list_(pa.string()))], ["doc_seq", "doc_id", "blocks"])
        batch = packed = None
        freed()

    bounded_batches(docs.sparkSession)
    split = docs.select(F.col("doc_seq").cast("long"), F.col("doc_id").cast("string"), T.sentences(T.normalize_document(F.col("text"))).alias("s"))
    packed = split.mapInArrow(run, "doc_seq long, doc_id string, blocks array<string>")
    kept = F.filter("blocks", lambda b: (T.word_count(b) >= max(1, config.min_block_words)) & (F.char_length(b) >= config.min_block_chars))
    return packed.select("doc_seq", "doc_id", F.posexplode(kept).alias("block_id", "text")).withColumns({"word_count": T.word_count(F.col("text")), "char_count": T.char_count(F.col("text"))})


def block_reason(config: ChunkConfig, text=None, label=None, score=None):
    """The first reason to reject a block, or null. label and score: a classifier's columns, or None for no classifier."""
    text = F.col("text") if text is None else text
    pipe, dash = T.token_share(text, r"\|"), T.token_share(text, "-+")
    shown = lambda x: F.format_string("%.4f", F.bround(x, 4))  # noqa: E731  ties to even, as in shares of 32 words
    reason = (
        F.when(T.collapse(text) == "", F.lit("empty_block"))
        .when(pipe > config.max_pipe_share, F.concat(F.lit("pipe_token_fraction_above_threshold:"), shown(pipe), F.lit(f">{config.max_pipe_share:.4f}")))
        .when(dash > config.max_dash_share, F.concat(F.lit("dash_token_fraction_above_threshold:"), shown(dash), F.lit(f">{config.max_dash_share:.4f}")))
    )
    if label is not None:
        score = F.lit(1.0) if score is None else score
        reason = (
            reason.when(label.isNull(), F.lit("classifier_no_prediction"))
            .when(~label.isin(*config.keep_labels), F.concat(F.lit("classifier_label_not_allowed:"), label))
            .when(score < config.min_label_score, F.concat(F.lit("classifier_score_below_threshold:"), label, F.lit("="), shown(score), F.lit(f"<{config.min_label_score:.4f}")))
        )
    return reason


def chunks(blocks: DataFrame, dedup: bool = True) -> DataFrame:
    """blocks that passed, with hash, is_emitted, chunk_index and chunk_id; the first block of each text is emitted.

    First is by (doc_seq, block_id): the least place of each hash is aggregated, so the copies of a common block never
    meet. The index counts a document's emitted chunks so far; a duplicate shows the next.
    """
    marked = blocks.withColumn("hash", F.sha1(T.dedup_text(F.col("text"))))
    if dedup:
        place = F.struct("doc_seq", "block_id")
        first = marked.groupBy("hash").agg(F.min(place).alias("_first"))
        marked = marked.join(first, "hash").withColumn("is_emitted", place == F.col("_first")).drop("_first")
    else:
        marked = marked.withColumn("is_emitted", F.lit(True))
    before = Window.partitionBy("doc_seq").orderBy("block_id").rowsBetween(Window.unboundedPreceding, -1)
    indexed = marked.withColumn("chunk_index", F.coalesce(F.sum(F.col("is_emitted").cast("long")).over(before), F.lit(0)).cast("long"))
    return indexed.withColumn("chunk_id", H.chunk_id(F.col("doc_id"), F.col("chunk_index"), F.col("text")))


def rejects(blocks: DataFrame, marked: DataFrame) -> DataFrame:
    """(stage, reason, doc_seq, block_id, chunk_id, text_preview) of rejected blocks and of duplicate chunks."""
    first = blocks.where("reason is not null").select(F.lit("block").alias("stage"), "reason", "doc_seq", "block_id", F.lit(None).cast("string").alias("chunk_id"), T.preview(F.col("text")).alias("text_preview"))
    second = marked.where("not is_emitted").select(F.lit("chunk").alias("stage"), F.lit("duplicate_chunk_text").alias("reason"), "doc_seq", "block_id", F.concat_ws(":", "doc_id", F.col("chunk_index").cast("string")).alias("chunk_id"), T.preview(F.col("text")).alias("text_preview"))
    return first.unionByName(second)


def about(docs: DataFrame) -> DataFrame:
    """(doc_seq, url, title, source_domain) of documents; url is the final one, if there is one. Missing columns are null."""
    has = lambda name: F.nullif(F.trim(F.col(name).cast("string")), F.lit("")) if name in docs.columns else F.lit(None).cast("string")
    return docs.select(F.col("doc_seq").cast("long").alias("doc_seq"), F.coalesce(has("final_url"), has("url")).alias("url"), has("title").alias("title"), has("source_domain").alias("source_domain"))


def chunk_records(marked: DataFrame, docs: DataFrame) -> DataFrame:
    """Records of the emitted chunks: ids, what is known of their documents, text, counts, metadata."""
    rows = marked.where("is_emitted").join(about(docs), "doc_seq", "left")
    return rows.select(
        "chunk_id", "doc_id", "url", "title", "source_domain", "text", F.array(F.col("block_id").cast("int")).alias("block_ids"), "char_count", "word_count",
        F.struct(F.col("chunk_index"), F.col("word_count").alias("token_count_estimate"), F.lit(1).alias("block_count")).alias("metadata"),
    )


def reject_records(judged: DataFrame, marked: DataFrame, docs: DataFrame, config: ChunkConfig = ChunkConfig(), created_at: str | None = None) -> DataFrame:
    """Records of rejected blocks, with their text and what the filter saw, and of duplicate chunks. metadata is JSON."""
    text, none = F.col("text"), F.lit(None).cast("string")
    label, score = (F.col(c) if c in judged.columns else F.lit(None).cast(t) for c, t in (("label", "string"), ("score", "double")))
    seen = F.to_json(F.struct(
        label.alias("quality_label"), score.alias("quality_score"), T.word_count(text).alias("word_count_total"), T.token_count(text, r"\|").alias("pipe_token_count"), T.token_share(text, r"\|").alias("pipe_token_fraction"), F.lit(config.max_pipe_share).alias("max_pipe_token_fraction"),
        T.token_count(text, "-+").alias("dash_token_count"), T.token_share(text, "-+").alias("dash_token_fraction"), F.lit(config.max_dash_share).alias("max_dash_token_fraction"),
    ), {"ignoreNullFields": "false"})
    when = F.lit(created_at)
    first = judged.where("reason is not null").select(F.lit("block").alias("stage"), "reason", "doc_seq", "doc_id", F.col("block_id").cast("int").alias("block_id"), none.alias("chunk_id"), text.alias("text"), T.preview(text).alias("text_preview"), seen.alias("metadata"))
    second = marked.where("not is_emitted").select(F.lit("chunk").alias("stage"), F.lit("duplicate_chunk_text").alias("reason"), "doc_seq", "doc_id", F.lit(None).cast("int").alias("block_id"), F.concat_ws(":", "doc_id", F.col("chunk_index").cast("string")).alias("chunk_id"), none.alias("text"), T.preview(text).alias("text_preview"), F.to_json(F.struct("chunk_index", F.array(F.col("block_id").cast("int")).alias("block_ids"))).alias("metadata"))
    both = first.unionByName(second).join(about(docs), "doc_seq", "left")
    return both.select("stage", "reason", "doc_id", "block_id", "chunk_id", "url", "source_domain", "text", "text_preview", "metadata", when.alias("created_at"))


def length_rows(docs: DataFrame, judged: DataFrame, marked: DataFrame) -> DataFrame:
    """(name, count, total, avg, min, max) of words and characters of documents, blocks and chunks, taken and kept.

    docs: doc_seq, text; judged: all blocks with reason; marked: the blocks that passed, with is_emitted.
    """
    kept_docs = marked.where("is_emitted").select("doc_seq").distinct()
    sized = docs.select(F.col("doc_seq").cast("long").alias("doc_seq"), T.word_count(F.col("text")).alias("w"), T.char_count(F.col("text")).alias("c")).join(kept_docs.withColumn("kept", F.lit(True)), "doc_seq", "left")
    keep = lambda when, c: F.when(when, F.col(c))
    out = stats.lengths(sized, docs_input_words=F.col("w"), docs_input_chars=F.col("c"), docs_kept_words=keep(F.col("kept"), "w"), docs_kept_chars=keep(F.col("kept"), "c"))
    passed = F.col("reason").isNull()
    out = out.unionByName(stats.lengths(judged, blocks_input_words=F.col("word_count"), blocks_input_chars=F.col("char_count"), blocks_kept_words=keep(passed, "word_count"), blocks_kept_chars=keep(passed, "char_count")))
    emitted = F.col("is_emitted")
    return out.unionByName(stats.lengths(marked, chunks_output_words=keep(emitted, "word_count"), chunks_output_chars=keep(emitted, "char_count")))


def histogram_rows(docs: DataFrame, judged: DataFrame, marked: DataFrame) -> DataFrame:
    """(name, bucket, n) of words of documents and blocks taken and of chunks made."""
    parts = (
        ("doc_words_input", docs.select(T.word_count(F.col("text")).alias("w")), stats.DOCUMENT_WORDS),
        ("block_words_input", judged.select(F.col("word_count").alias("w")), stats.BLOCK_WORDS),
        ("chunk_words_output", marked.where("is_emitted").select(F.col("word_count").alias("w")), stats.CHUNK_WORDS),
    )
    out = None
    for name, rows, bounds in parts:
        part = stats.histogram(rows, F.col("w"), bounds).select(F.lit(name).alias("name"), "bucket", "n")
        out = part if out is None else out.unionByName(part)
    return out


def rejection_rows(judged: DataFrame, marked: DataFrame, docs: DataFrame) -> DataFrame:
    """(reason, stage, domain, n) of rejections, each grouped by reason, by stage, by domain, and by stage and domain."""
    rows = judged.where("reason is not null").select("doc_seq", "reason", F.lit("block").alias("stage")).unionByName(marked.where("not is_emitted").select("doc_seq", F.lit("duplicate_chunk_text").alias("reason"), F.lit("chunk").alias("stage")))
    named = rows.join(about(docs).select("doc_seq", "source_domain"), "doc_seq", "left").withColumn("domain", stats.domain_key(F.col("source_domain")))
    return named.groupingSets([["reason"], ["stage"], ["domain"], ["stage", "domain"]], "reason", "stage", "domain").agg(F.count(F.lit(1)).alias("n"))


def counters(docs: DataFrame, judged: DataFrame, marked: DataFrame) -> DataFrame:
    """One row of the run's counters and rates."""
    d = docs.agg(F.count(F.lit(1))).first()[0]
    b = judged.agg(F.count(F.lit(1)), F.count_if(F.col("reason").isNull())).first()
    c = marked.agg(F.count_if("is_emitted"), F.count_if(~F.col("is_emitted")), F.countDistinct(F.when(F.col("is_emitted"), F.col("doc_seq")))).first()
    share = lambda part, whole: part / whole if whole else 0.0
    row = {
        "docs_input": d, "docs_kept": c[2], "docs_rejected": 0, "blocks_input": b[0], "blocks_kept": b[1], "blocks_rejected": b[0] - b[1], "chunks_output": c[0], "chunks_rejected": c[1], "chunks_deduped": c[1],
        "docs_keep_rate": share(c[2], d), "blocks_keep_rate": share(b[1], b[0]), "chunks_per_doc_kept": share(c[0], c[2]), "chunks_per_block_kept": share(c[0], b[1]),
    }
    return docs.sparkSession.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'double' if isinstance(v, float) else 'long'}" for k, v in row.items()))


def summary(docs: DataFrame, judged: DataFrame, marked: DataFrame, config: ChunkConfig, started_at: str, finished_at: str) -> dict[str, Any]:
    """Nested statistics of a run; only counts by domain, reason and bucket come to the driver."""
    from datetime import datetime

    core = counters(docs, judged, marked).first().asDict()
    rates = {k: core.pop(k) for k in ("docs_keep_rate", "blocks_keep_rate", "chunks_per_doc_kept", "chunks_per_block_kept")}
    lengths = {r.name: {k: r[k] for k in ("count", "total", "avg", "min", "max")} for r in length_rows(docs, judged, marked).collect()}
    histograms: dict[str, dict[str, int]] = {"doc_words_input": {}, "block_words_input": {}, "chunk_words_output": {}}
    for r in histogram_rows(docs, judged, marked).collect():
        histograms[r.name][r.bucket] = r.n
    by: dict[str, Any] = {"by_reason": {}, "by_stage": {}, "by_domain": {}, "by_stage_domain": {}}
    for r in rejection_rows(judged, marked, docs).collect():
        if r.reason is not None:
            by["by_reason"][r.reason] = r.n
        elif r.stage is not None and r.domain is not None:
            by["by_stage_domain"].setdefault(r.stage, {})[r.domain] = r.n
        elif r.stage is not None:
            by["by_stage"][r.stage] = r.n
        else:
            by["by_domain"][r.domain] = r.n
    by["top_domains"] = [{"domain": d, "count": n} for d, n in sorted(by["by_domain"].items(), key=lambda x: (-x[1], x[0]))[:10]]
    known = about(docs).select("doc_seq", stats.domain_key(F.col("source_domain")).alias("domain"))
    domains = {"docs_by_domain": dict(map(tuple, known.groupBy("domain").count().collect())), "chunks_by_domain": dict(map(tuple, marked.where("is_emitted").join(known, "doc_seq").groupBy("domain").count().collect()))}
    seconds = max(0.0, (datetime.fromisoformat(finished_at) - datetime.fromisoformat(started_at)).total_seconds())
    return core | {"started_at": started_at, "finished_at": finished_at, "duration_seconds": seconds, "rates": rates, "lengths": lengths, "histograms": histograms, "rejections": by, "domains": domains, "config": asdict(config)}


@dataclass(frozen=True)
class Result:
    """judged: all blocks with reason; marked: the blocks that passed, with is_emitted."""

    docs: DataFrame
    judged: DataFrame
    marked: DataFrame
    config: ChunkConfig

    @property
    def chunks(self) -> DataFrame:
        return chunk_records(self.marked, self.docs)

    @property
    def rejected(self) -> DataFrame:
        return reject_records(self.judged, self.marked, self.docs, self.config)


def limited(docs: DataFrame, max_docs: int | None) -> DataFrame:
    """The first max_docs documents in order of doc_seq, which counts from 0."""
    if max_docs is not None and max_docs <= 0:
        raise ValueError("max_docs must be positive")
    return docs if max_docs is None else docs.where(F.col("doc_seq") < max_docs)


def run_pipeline(docs: DataFrame, config: ChunkConfig = ChunkConfig(), predict=None, max_docs: int | None = None, store=None) -> Result:
    """Split, judge, deduplicate. docs: doc_seq (from 0), doc_id, text and what records show.

    predict: a function of a text column to array<struct<label, score>>, the best first, asked for every block; without
    one no label is asked for. store: a function of (DataFrame, name) that writes the blocks down once for all that is
    derived from them.
    """
    docs = limited(docs, max_docs)
    blocks = split_blocks(docs, config)
    label = score = None
    if predict is not None:
        best = F.try_element_at("_best", F.lit(1))
        blocks = blocks.withColumn("_best", predict(T.collapse(F.col("text")))).withColumns({"label": best["label"], "score": best["score"]}).drop("_best")
        label, score = F.col("label"), F.col("score")
    judged = blocks.withColumn("reason", block_reason(config, label=label, score=score))
    if store is not None:
        judged = store(judged, "blocks")
    marked = chunks(judged.where("reason is null"), config.dedup)
    return Result(docs, judged, store(marked, "chunks") if store is not None else marked, config)
