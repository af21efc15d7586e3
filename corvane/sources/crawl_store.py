"""A crawl's files: raw content, parsed documents and errors as JSON lines, manifests; all in one folder of any file system.

JSON lines and the list of visited URLs are folders that Spark's committer appends to; the two JSON manifests are single
files, written beside their place and then moved over it in one step.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import url as U
from . import readers

DOCUMENT = "doc_id string, url string, final_url string, title string, text string, content_type string, content_kind string, crawl_time string, source_domain string, metadata map<string,string>"
ERROR = "stage string, url string, message string, error_type string, doc_id string, referrer string, status_code int, created_at string, metadata map<string,string>"
URL_META = "url string, final_url string, status_code int, content_type string, content_length long, body_sha256 string, backend string, fetched_at string, error string"
#: Content kinds in the order in which a stored copy is looked for.
KINDS = ("html", "pdf", "text", "binary", "unknown")


def as_json(*columns: str | Column) -> Column:
    """A JSON object of the columns, nulls included, keys in order."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def json_lines(rows: DataFrame) -> DataFrame:
    return rows.select(as_json(*sorted(rows.columns)).alias("value"))


def write_json(spark: SparkSession, payload: Mapping[str, Any], path: str) -> None:
    """One JSON file, replaced as a whole."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), conf)
    system = place.getFileSystem(conf)
    system.mkdirs(place.getParent())
    out = system.create(beside, True)
    out.write(bytearray((json.dumps(payload, indent=2, ensure_ascii=False, sort_keys=True, default=str) + "\n").encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(beside, place, options)


def read_json(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


class CrawlStore:
    """Places under one folder, and what is in them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.paths = {
            "output_dir": self.folder, "raw_dir": f"{self.folder}/raw", "parsed_docs": f"{self.folder}/parsed/docs.jsonl", "parsed_errors": f"{self.folder}/parsed/errors.jsonl", "visited_urls": f"{self.folder}/manifests/visited_urls.txt",
            "url_meta": f"{self.folder}/manifests/url_meta.jsonl", "crawl_config": f"{self.folder}/manifests/crawl_config.json", "crawl_stats": f"{self.folder}/manifests/crawl_stats.json", "log_dir": f"{self.folder}/logs",
        }

    def exists(self, name: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths[name])
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def _lines(self, name: str, schema: str) -> DataFrame:
        """Rows of JSON lines; those that can't be read are left out."""
        if not self.exists(name):
            return self.spark.createDataFrame([], schema)
        return readers.read_jsonl(self.spark, self.paths[name], schema, strict=False)

    def documents(self) -> DataFrame:
        return self._lines("parsed_docs", DOCUMENT)

    def errors(self) -> DataFrame:
        return self._lines("parsed_errors", ERROR)

    def url_meta(self) -> DataFrame:
        return self._lines("url_meta", URL_META)

    def visited(self) -> DataFrame:
        """url of every line that is not blank."""
        if not self.exists("visited_urls"):
            return self.spark.createDataFrame([], "url string")
        return self.spark.read.text(self.paths["visited_urls"]).select(F.trim("value").alias("url")).where("url != ''").distinct()

    def parsed(self) -> DataFrame:
        """url of every document, as asked for and as found."""
        return readers.parsed_urls(self.documents())

    def raw(self) -> DataFrame:
        """(url, kind, body): the stored copy of each URL, the first kind in the order of KINDS."""
        if not self.exists("raw_dir"):
            return self.spark.createDataFrame([], "url string, body binary, kind string")
        rows = self.spark.read.schema("url string, body binary, kind string").parquet(self.paths["raw_dir"])
        order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
        return rows.groupBy("url").agg(F.min_by(F.struct("kind", "body"), order).alias("r")).select("url", "r.kind", "r.body")

    def append_lines(self, rows: DataFrame, name: str) -> None:
        json_lines(rows).write.mode("append").text(self.paths[name])

    def append_visited(self, urls: DataFrame) -> int:
        """Add the URLs that are not there yet; returns how many those were."""
        return readers.append_visited(urls, self.paths["visited_urls"])

    def save_raw(self, rows: DataFrame, overwrite: bool = False) -> None:
        """rows (url, kind, body), one for each URL. A URL and kind that is stored stays, or is replaced by overwrite."""
        new = rows.select("url", "body", "kind")
        if self.exists("raw_dir"):
            old = self.spark.read.schema("url string, body binary, kind string").parquet(self.paths["raw_dir"])
            if overwrite:
                from ..plans.storage import stored

                kept = old.join(new.select("url", "kind"), ["url", "kind"], "left_anti").select("url", "body", "kind")
                stored(kept.unionByName(new), "raw").write.mode("overwrite").partitionBy("kind").parquet(self.paths["raw_dir"])
                return
            new = new.join(old.select("url", "kind"), ["url", "kind"], "left_anti").select("url", "body", "kind")
        new.write.mode("append").partitionBy("kind").parquet(self.paths["raw_dir"])

    def cached(self, urls: DataFrame) -> DataFrame:
        """(url, kind, body, content_type) of the URLs with a stored copy."""
        kinds = F.when(F.col("kind") == "html", "text/html; charset=utf-8").when(F.col("kind") == "pdf", "application/pdf").when(F.col("kind") == "text", "text/plain; charset=utf-8")
        return urls.select("url").join(self.raw(), "url").withColumn("content_type", kinds)

    def candidates(self) -> DataFrame:
        """(url), in order: canonical URLs of good fetches with a stored copy; without any, those of the visited list."""
        raw = self.raw().select("url")
        blank = lambda c: F.nullif(F.trim(c), F.lit(""))
        good = self.url_meta().where(blank("error").isNull() & (F.col("status_code").isNull() | F.col("status_code").between(200, 299)))
        found = good.select(U.normalize(F.coalesce(blank("final_url"), F.col("url"))).alias("url")).join(raw, "url", "left_semi").distinct()
        if not found.take(1):
            found = self.visited().select(U.normalize(F.col("url")).alias("url")).join(raw, "url", "left_semi").distinct()
        return found.orderBy("url")

    def save_config(self, payload: Mapping[str, Any]) -> None:
        write_json(self.spark, payload, self.paths["crawl_config"])

    def save_stats(self, payload: Mapping[str, Any]) -> None:
        write_json(self.spark, payload, self.paths["crawl_stats"])
