"""Limits of the Arrow batches that are handed to Python: what a worker holds hangs on them, not on the table."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import SparkSession

#: Limits of one Arrow batch handed to Python; a batch always holds at least one row.
BATCH_ROWS = 1024
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession, times: int = 1) -> None:
    """Keep Arrow batches small whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(times * BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(times * BATCH_BYTES))


def freed() -> None:
    """Give what a task has freed back to the system: the worker process may idle beside others."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
