"""The register of this subpackage and the text helpers its operators share."""

from __future__ import annotations

import gc
import string
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemerge.session import work_path

# Python workers live on from stage to stage; the system's allocator gives their memory back in between
pa.set_memory_pool(pa.system_memory_pool())

BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers ``f(spark, folder)`` under ``name``; ``sql`` is what DuckDB runs on the same tables."""

    def register(f):
        QUERIES[name] = small_batches(f)
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def small_batches(f):
    """``f(spark, ...)`` with ``BATCH_ROWS`` rows in a batch that goes to Python, unless the session asks for its own
    number: texts can be long, and Spark bounds batches by rows alone."""

    @wraps(f)
    def run(spark: SparkSession, *args):
        if spark.conf.get(_BATCH) == "10000":
            spark.conf.set(_BATCH, str(BATCH_ROWS))
        return f(spark, *args)

    return run


def give_back(spark: SparkSession) -> None:
    """Frees what the driver holds of earlier work: both of its heaps shrink to what is still in use."""
    gc.collect()
    spark._jvm.System.gc()


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns or "*")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % by


def content_key(text: Column) -> Column:
    """16 bytes that stand for a text; null and empty texts share one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` below the shared folder and reads it back: later steps neither repeat the work nor lose it."""
    path = work_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_chunks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to about ``most``, so that a task holds little at a time."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
