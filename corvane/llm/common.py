"""What the operators share: scratch tables in the cluster's shared folder, Arrow batch limits, document columns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..batches import bounded_batches, freed


def scratch(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a temporary one only where a local session names none."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="corvane-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives the loss of any executor.

    The table is deleted when the driver ends. options: of Parquet's writer.
    """
    spark = df.sparkSession
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with null texts as empty; every other column and rows without a doc_id are left behind."""
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def over_batches(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, done: Callable[[], None] | None = None) -> DataFrame:
    """mapInArrow with a function of one batch; done is called at the end of a task."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = f(batch)
                if out is not None and out.num_rows:
                    yield out
        if done:
            done()
        freed()

    return df.mapInArrow(run, schema)


def bucket(column: str, modulus: int):
    """crc32 of the column's decimal text, modulo."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus
