"""Sources and sinks: document JSON and JSONL, manifests, query files, embeddings, raw content, chunk stores."""

from __future__ import annotations

import json
from collections.abc import Iterable
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.storage import stored

DOCUMENT = "doc_id string, id string, url string, final_url string, title string, text string, content_type string, content_kind string, crawl_time string, source_domain string, metadata string"


def _or_null(name: str):
    return F.nullif(F.trim(F.col(name)), F.lit("")).alias(name)


def coerce_documents(rows: DataFrame, skip_invalid: bool = True) -> DataFrame:
    """Identifier from doc_id or id, text required, other strings trimmed and null if empty."""
    named = rows.withColumn("doc_id", F.coalesce(F.nullif(F.trim("doc_id"), F.lit("")), F.nullif(F.trim("id"), F.lit(""))))
    good = F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    checked = named.where(good) if skip_invalid else named.withColumn("doc_id", F.when(good, F.col("doc_id")).otherwise(F.raise_error(F.lit("a document needs an id and a text"))))
    metadata = F.coalesce(F.when(F.col("metadata").rlike(r"^\s*\{"), F.col("metadata")), F.lit("{}")).alias("metadata")
    return checked.select("doc_id", "text", *(_or_null(c) for c in ("url", "final_url", "title", "content_type", "content_kind", "crawl_time", "source_domain")), metadata)


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """JSON lines; a line that can't be read ends the job if strict and goes otherwise. Blank lines go."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    lines = spark.read.text(path).where("trim(value) != ''")
    read = lines.select(F.from_json("value", schema + ", _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    return read.where("r._corrupt is null").select("r.*").drop("_corrupt")


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a JSON file of any known shape: a list, one under docs, documents or items, a map of ids, or one."""
    whole = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("v"))
    inner = F.coalesce(*(F.try_variant_get("v", f"$.{k}", "variant") for k in ("docs", "documents", "items")))
    one = (F.try_variant_get("v", "$.text", "string").isNotNull()) & inner.isNull()
    root = F.when(one, F.to_json("v")).otherwise(F.to_json(F.coalesce(inner, "v")))
    listed = whole.select(one.alias("one"), root.alias("j"))
    entries = listed.select(
        F.when(F.col("one"), F.array(F.struct(F.lit(None).cast("string").alias("k"), F.col("j").alias("d"))))
        .when(F.col("j").rlike(r"^\s*\["), F.transform(F.from_json("j", "array<string>"), lambda d: F.struct(F.lit(None).cast("string").alias("k"), d.alias("d"))))
        .otherwise(F.transform(F.map_entries(F.from_json("j", "map<string,string>")), lambda e: F.struct(e["key"].alias("k"), e["value"].alias("d"))))
        .alias("e")
    ).select(F.inline("e"))
    documents = entries.where(F.col("d").rlike(r"^\s*\{")).select("k", F.from_json("d", DOCUMENT).alias("d"))
    return documents.select("d.*", "k").withColumn("id", F.coalesce("id", "k")).drop("k")


def read_documents(spark: SparkSession, path: str, skip_invalid: bool = True) -> DataFrame:
    """By suffix: .json of any shape, all else JSON lines."""
    rows = read_json(spark, path) if path.endswith(".json") else read_jsonl(spark, path, DOCUMENT, not skip_invalid)
    return coerce_documents(rows, skip_invalid)


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """(ord, id, question) of a JSON list; an entry without either ends the job."""
    rows = spark.read.schema("id string, question string").option("multiLine", True).json(path).withColumn("ord", F.monotonically_increasing_id())
    bad = F.coalesce(F.trim("id"), F.lit("")) == ""
    bad = bad | (F.coalesce(F.trim("question"), F.lit("")) == "")
    return rows.withColumn("id", F.when(bad, F.raise_error(F.lit("a query needs an id and a question"))).otherwise(F.col("id"))).select("ord", "id", "question")


def answers_json(answers: Iterable[tuple[str, str]], **head: str) -> str:
    """One JSON object: the head, then answers in order; a repeated id keeps its last answer."""
    return json.dumps(head | dict(answers), ensure_ascii=False, indent=2)


def append_visited(urls: DataFrame, path: str) -> int:
    """Append the URLs not yet in the manifest, and return how many those were."""
    from ..plans.storage import stored

    spark = urls.sparkSession
    try:
        old = spark.read.text(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        old = spark.createDataFrame([], "value string")
    # written down first: the manifest must not be read and appended to by one plan
    new = stored(urls.where("url is not null").select(F.col("url").alias("value")).distinct().join(old, "value", "left_anti"), "visited")
    count = new.count()
    if count:
        new.write.mode("append").text(path)
    return count


def parsed_urls(docs: DataFrame) -> DataFrame:
    return docs.select("url").union(docs.select("final_url")).where("url is not null").distinct()


def raw_path(url, kind):
    """kind/host/digest of a URL's stored content."""
    from ..functions import url as U

    name = F.regexp_replace(F.coalesce(F.nullif(U.host(url), F.lit("")), F.lit("unknown")), "[^A-Za-z0-9._-]", "_")
    suffix = F.when(kind == "html", ".html").when(kind == "pdf", ".pdf").when(kind == "text", ".txt").otherwise(".bin")
    return F.concat_ws("/", F.lit("raw"), kind, name, F.concat(F.sha2(url.cast("binary"), 256), suffix))


def store_raw(rows: DataFrame, path: str, overwrite: bool = False) -> None:
    """rows (url, kind, body), partitioned by kind; URLs already stored stay unless overwrite."""
    spark = rows.sparkSession
    if not overwrite:
        try:
            rows = rows.join(spark.read.parquet(path).select("url"), "url", "left_anti")
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
    rows.write.mode("overwrite" if overwrite else "append").partitionBy("kind").parquet(path)


def chunk_store(rows: DataFrame, last_wins: bool = False) -> DataFrame:
    """One row for each chunk_uid: the first by row_id, or the last; blank uids go."""
    pick = F.max_by if last_wins else F.min_by
    payload = F.struct(*(c for c in rows.columns if c not in ("row_id", "chunk_uid")))
    return rows.where("trim(chunk_uid) != ''").groupBy("chunk_uid").agg(pick(payload, "row_id").alias("p")).select("chunk_uid", "p.*")


def number_rows(rows: DataFrame, order: str | list[str], name: str = "row_id") -> DataFrame:
    """Consecutive numbers from 0 in order, without meeting in one task: ranges are counted, then shifted.

    The ranged rows are written down with their places and counted from there: ranges that are dealt twice may begin
    elsewhere the second time.
    """
    order = [order] if isinstance(order, str) else order
    ranged = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_ranged", F.monotonically_increasing_id()), "ranged")
    part, within = F.shiftright("_ranged", 33), F.col("_ranged").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()  # a row for each range
    before = dict(zip((r.part for r in sizes), accumulate((r.n for r in sizes), initial=0)))
    shifts = rows.sparkSession.createDataFrame(list(before.items()), "_range long, _before long")
    return ranged.withColumn("_range", part).join(F.broadcast(shifts), "_range").withColumn(name, F.col("_before") + within).drop("_range", "_ranged", "_before")


def chunk_payload(rows: DataFrame, uid: str = "chunk_uid") -> DataFrame:
    """What is shown of a chunk: uid, title, text, url, and doc_id, source_domain, metadata where rows have them."""
    more = [c for c in ("doc_id", "source_domain", "metadata") if c in rows.columns]
    has = lambda name: F.col(name) if name in rows.columns else F.lit(None).cast("string").alias(name)
    return rows.select(F.col(uid).alias("chunk_uid"), has("title"), has("text"), has("url"), *more)


def write_embeddings(rows: DataFrame, path: str, dim: int) -> None:
    """(row_id, chunk_uid, embedding) as Parquet; a vector of another size or a blank uid ends the job."""
    checked = F.when(F.size("embedding") == dim, F.col("embedding")).otherwise(F.raise_error(F.lit(f"an embedding is not of size {dim}")))
    uid = F.when(F.coalesce(F.trim("chunk_uid"), F.lit("")) != "", F.trim("chunk_uid")).otherwise(F.raise_error(F.lit("a chunk_uid is blank")))
    rows.select("row_id", uid.alias("chunk_uid"), checked.cast("array<float>").alias("embedding")).write.mode("overwrite").parquet(path)


def write_embedded(rows: DataFrame, folder: str, dim: int) -> dict[str, int]:
    """Embeddings, row map and chunk store of rows (row_id, chunk_uid, embedding, payload columns); returns the counts.

    The store has one row for each uid, the first by row_id. Without rows all three are written empty.
    """
    spark = rows.sparkSession
    write_embeddings(rows, f"{folder}/embeddings", dim)
    spark.read.parquet(f"{folder}/embeddings").select("row_id", "chunk_uid").write.mode("overwrite").parquet(f"{folder}/embedding_to_uid")
    chunk_store(rows.drop("embedding")).write.mode("overwrite").parquet(f"{folder}/chunk_store")
    n, unique = spark.read.parquet(f"{folder}/embedding_to_uid").agg(F.count(F.lit(1)), F.countDistinct("chunk_uid")).first()
    return {"num_rows": n, "dim": dim if n else 0, "num_unique_chunks": unique}


def checked_row_map(rows: DataFrame, expected: int) -> DataFrame:
    """(row_id, chunk_uid) of a row map; ValueError for ids out of range, blank uids, missing or repeated rows."""
    uid = F.coalesce(F.trim("chunk_uid"), F.lit(""))
    seen = rows.agg(F.count_if(F.col("row_id").isNull() | (F.col("row_id") < 0) | (F.col("row_id") >= expected)).alias("out"), F.count_if(uid == "").alias("blank"), F.countDistinct("row_id").alias("ids")).first()
    if seen.out:
        raise ValueError(f"{seen.out} row_ids are not within 0 to {expected - 1}")
    if seen.blank:
        raise ValueError(f"{seen.blank} rows have no chunk_uid")
    if seen.ids != expected:
        raise ValueError(f"{expected - seen.ids} rows have no mapping")
    return rows.groupBy("row_id").agg(F.last("chunk_uid").alias("chunk_uid"))


def read_embedded(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(row_id, embedding) and (row_id, chunk_uid, payload) of what write_embedded wrote, checked against each other."""
    vectors = spark.read.parquet(f"{folder}/embeddings").select("row_id", "embedding")
    rows = checked_row_map(spark.read.parquet(f"{folder}/embedding_to_uid"), vectors.count())
    return vectors, rows.join(spark.read.parquet(f"{folder}/chunk_store"), "chunk_uid", "left")


def count_lines(spark: SparkSession, path: str, most: int | None = None) -> int | None:
    """Lines that are not blank of a JSON-lines file, or `most`; None for files of other kinds."""
    if most is not None:
        return most
    if not path.lower().endswith(".jsonl"):
        return None
    return spark.read.text(path).where("trim(value) != ''").count()
