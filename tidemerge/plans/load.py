"""What to load next per table: resume point, watermark, fallback, and the full plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemerge import settings as S
from tidemerge.functions.scalars import watermark_from_json, watermark_number, watermark_text
from tidemerge.plans.chunks import chunk_array, tier_value


def resume_point(manifest: DataFrame, loaded: DataFrame, column: str) -> DataFrame:
    """Manifest with ``resume_from``: day of the highest loaded value, else the history start."""
    top = loaded.groupBy("table_key").agg(F.max(column).cast("date").alias("_top"))
    return manifest.join(top, "table_key", "left").withColumn(
        "resume_from", F.coalesce("_top", F.col("history_start").cast("date"))).drop("_top")


def fallback_watermark(stored: Column, as_of, days: int) -> Column:
    return F.coalesce(stored, F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days)))


def with_fallback(state: DataFrame, as_of, days: int = S.FALLBACK_DAYS) -> DataFrame:
    """Adds the watermark to read from: the stored one, or ``days`` days before ``as_of``."""
    stored = watermark_from_json("last_watermark_value", "timestamp_ntz")
    return state.withColumns({"watermark": fallback_watermark(stored, as_of, days), "used_fallback": stored.isNull()})


def incremental_chunk(state: DataFrame, as_of, days: int = S.FALLBACK_DAYS) -> DataFrame:
    """One open-ended chunk per table, rows strictly after the watermark."""
    return with_fallback(state, as_of, days).select(
        "table_key", F.col("watermark").alias("read_after"),
        F.date_format(F.lit(as_of).cast("date"), "yyyy-MM-dd").alias("watermark_end"),
        F.lit("incremental").alias("label"), F.lit("incremental").alias("run_type"))


def plan_load(manifest: DataFrame, state: DataFrame, loaded: DataFrame, as_of, column: str) -> DataFrame:
    """One row per chunk over all tables.

    A completed table gets one incremental chunk; a light one a full load; any other the months or
    quarters from its resume point up to the day of ``as_of``.
    """
    day = F.lit(as_of).cast("date")
    text = lambda d: F.date_format(d, "yyyy-MM-dd")
    base = resume_point(manifest, loaded, column).join(
        state.select("table_key", "last_watermark_value", "historical_completed_at"), "table_key", "left")
    stored = watermark_from_json("last_watermark_value", "timestamp_ntz")
    times = F.date_format(fallback_watermark(stored, as_of, S.FALLBACK_DAYS), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    number = F.when(watermark_number("last_watermark_value").isNotNull(), watermark_text("last_watermark_value"))
    after = F.coalesce(number, times)
    months = tier_value("chunk_months")

    def chunk(kind: str, label: Column, start: Column, end: Column) -> Column:
        return F.struct(F.lit(kind).alias("run_type"), label.alias("label"), start.alias("watermark_start"),
                        end.alias("watermark_end"))

    history = F.transform(chunk_array(F.col("resume_from"), day, months), lambda c: chunk(
        "historical", c["label"], text(c["chunk_start"]), text(c["chunk_end"])))
    chunks = (F.when(F.col("historical_completed_at").isNotNull(),
                     F.array(chunk("incremental", F.lit("incremental"), after, text(day))))
              .when(months.isNull(),
                    F.array(chunk("historical", F.lit("full"), F.col("history_start").cast("string"), text(day))))
              .otherwise(history))
    return base.select("table_key", "size_tier", F.inline(chunks))
