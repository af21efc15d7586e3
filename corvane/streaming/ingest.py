"""Streaming ingest: documents in, packed blocks out, each text once within the watermark; counts by time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.chunking import ChunkConfig, split_blocks


def blocks(stream: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:
    """Blocks of a stream of (doc_seq, doc_id, text); stateless."""
    return split_blocks(stream, config)


def once(stream: DataFrame, time: str, delay: str = "1 hour") -> DataFrame:
    """The first row of each normalised text; state is dropped behind the watermark."""
    keyed = stream.withColumn("hash", F.sha1(T.dedup_text(F.col("text"))))
    return keyed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["hash"])


def counts(stream: DataFrame, time: str, key: str, window: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    return stream.withWatermark(time, delay).groupBy(F.window(time, window), key).agg(F.count(F.lit(1)).alias("n"))


def append(stream: DataFrame, path: str, checkpoint: str):
    """Append to a Parquet table; the checkpoint makes each micro-batch count once."""
    return stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
