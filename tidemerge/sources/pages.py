"""Landed API pages: JSON text, one page per line, in files, a stream of files or a column."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemerge.functions.scalars import is_json_object

# --- fixed values: shape of a page. Records stay variants, so unknown members survive.
ENVELOPE_PAGE = ("struct<data: array<struct<contacts: array<variant>, messages: array<variant>, "
                 "statuses: array<variant>>>, paging: struct<next: string>>")
CONTACT_PAGE = "struct<data: array<variant>, paging: struct<next: string>>"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page files as lines of text (column ``value``); parsing is left to ``envelopes``."""
    return spark.read.text(path)


def stream_pages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def over_all_cores(pages: DataFrame) -> DataFrame:
    """Pages spread over the cores when they arrive in fewer splits than there are cores.

    Opening a page costs far more than moving it; input with enough splits is left as it is. Meant for
    pages straight from a scan, whose number of splits is known without running anything.
    """
    cores = pages.sparkSession.sparkContext.defaultParallelism
    return pages if pages.rdd.getNumPartitions() >= cores else pages.repartition(cores)


def page_faults(pages: DataFrame, field: str | None, page: Column | str = "value", shape: str = ENVELOPE_PAGE) -> DataFrame:
    """How pages keep to their shape, in one pass: pages, broken ones, records, and non-objects.

    A page is broken if it is no JSON of the shape: cut text, or a record with a repeated member (which ``envelopes``
    reads all the same). Blank pages count as broken. ``field`` names the record list of an envelope; None for pages of records.
    """
    text = F.col(page) if isinstance(page, str) else page
    # records as plain text show which lists are there; a list that is only missing as variants is broken
    read = pages.select(F.from_json(text, shape)["data"].alias("data"),
                        F.from_json(text, shape.replace("variant", "string"))["data"].alias("plain"))
    torn = F.exists(F.arrays_zip("data", "plain"), lambda e: F.coalesce(
        e["plain"][field].isNotNull() & e["data"][field].isNull(), F.lit(False))) if field else F.lit(False)
    records = F.flatten(F.transform("data", lambda e: F.coalesce(e[field], F.array().cast("array<variant>")))) if field \
        else F.col("data")
    counted = read.select((F.col("data").isNull() | torn).alias("bad"), F.coalesce(F.size(records), F.lit(0)).alias("n"),
                          F.coalesce(F.size(F.filter(records, lambda r: ~is_json_object(r))), F.lit(0)).alias("odd"))
    zero = F.lit(0).cast("bigint")
    return counted.agg(F.count(F.lit(1)).alias("pages_read"), F.count_if("bad").alias("bad_pages"),
                       F.coalesce(F.sum(F.when(~F.col("bad"), F.col("n"))), zero).alias("records_read"),
                       F.coalesce(F.sum(F.when(~F.col("bad"), F.col("odd"))), zero).alias("not_object"))


_LISTS = ("contacts", "messages", "statuses")
_REPEATS = "spark.sql.variant.allowDuplicateKeys"


@contextmanager
def last_member_wins(spark: SparkSession) -> Iterator[None]:
    """JSON opened inside keeps the last of repeated members, as most JSON readers do, instead of refusing the text. It
    holds for plans made inside and for streams started inside."""
    before = spark.conf.get(_REPEATS, None)
    spark.conf.set(_REPEATS, "true")
    try:
        yield
    finally:
        spark.conf.unset(_REPEATS) if before is None else spark.conf.set(_REPEATS, before)


def envelopes(pages: DataFrame, page: Column | str = "value", shape: str = ENVELOPE_PAGE) -> DataFrame:
    """One row per item of ``data`` in column ``envelope``; other columns of ``pages`` are kept.

    A page is opened whole, as one variant, so numbers keep their digits. Of repeated members the last counts, at any
    depth; items and records of another kind than expected are null and leave the others of their page alone. Cut or
    blank pages, and pages whose ``data`` is no list, give no rows.
    """
    kept = [c for c in pages.columns if c != page]
    with last_member_wins(pages.sparkSession):
        items = F.try_variant_get(F.try_parse_json(F.col(page) if isinstance(page, str) else page), "$.data", "array<variant>")
        # the outer form keeps Spark from opening each page twice for an inferred "not empty" filter
        rows = pages.select(*kept, F.explode_outer(items).alias("item"))
        if shape == ENVELOPE_PAGE:
            lists = [F.try_variant_get("item", f"$.{name}", "array<variant>").alias(name) for name in _LISTS]
            rows = rows.where(is_json_object("item")).select(*kept, F.struct(*lists).alias("envelope"))
        else:
            rows = rows.where("item is not null").select(*kept, F.col("item").alias("envelope"))
        rows.schema  # the setting is taken in here
    return rows


def page_rejects(pages: DataFrame, field: str | None, page: Column | str = "value", shape: str = ENVELOPE_PAGE) -> DataFrame:
    """What ``envelopes`` and the flattening make of pages: pages read, pages without rows, records, and records that are
    no objects and are left out alone."""
    with last_member_wins(pages.sparkSession):
        items = F.try_variant_get(F.try_parse_json(F.col(page) if isinstance(page, str) else page), "$.data", "array<variant>")
        records = F.flatten(F.transform(items, lambda e: F.coalesce(
            F.try_variant_get(e, f"$.{field}", "array<variant>"), F.array().cast("array<variant>")))) if field else items
        counted = pages.select(items.isNull().alias("bad"), F.coalesce(F.size(records), F.lit(0)).alias("n"),
                               F.coalesce(F.size(F.filter(records, lambda r: ~F.coalesce(is_json_object(r), F.lit(False)))), F.lit(0)).alias("odd"))
        out = counted.agg(F.count(F.lit(1)).alias("pages_read"), F.count_if("bad").alias("pages_without_rows"),
                          F.coalesce(F.sum("n"), F.lit(0)).alias("records_read"), F.coalesce(F.sum("odd"), F.lit(0)).alias("records_rejected"))
        out.schema
    return out
