"""Date chunks of a historical load. A chunk is a row or a column here, never a job of its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemerge import settings as S


def chunk_array(start: Column, end: Column, months: Column | int) -> Column:
    """Array of [chunk_start, chunk_end) structs from day 1 of the first month; empty if start >= end."""
    months = F.lit(months) if isinstance(months, int) else months
    first = F.trunc(start, "MM").cast("date")
    # the stop is kept on or after the first month, so that the sequence never runs backwards
    starts = F.sequence(first, F.greatest(first, F.date_sub(end, 1)), F.make_ym_interval(F.lit(0), months))
    pieces = F.transform(starts, lambda d: F.struct(
        d.alias("chunk_start"), F.least(F.add_months(d, months), end).alias("chunk_end"),
        F.date_format(d, "yyyy-MM").alias("label")))
    return F.when(first < end, pieces)


def month_chunks(spans: DataFrame, months: int, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """One row per chunk of ``months`` months, with the other columns of the span."""
    kept = [c for c in spans.columns if c not in (start, end)]
    return spans.select(*kept, F.inline(chunk_array(F.col(start), F.col(end), months)))


def full_chunk(tables: DataFrame, as_of, start: str = "history_start") -> DataFrame:
    """Single chunk without a predicate for every table of the light tier."""
    light = tables.where("size_tier = 'light'")
    kept = [c for c in light.columns if c != start]
    return light.select(*kept, F.col(start).cast("string").alias("watermark_start"),
                        F.date_format(F.lit(as_of).cast("date"), "yyyy-MM-dd").alias("watermark_end"),
                        F.lit("full").alias("label"), F.lit("historical").alias("run_type"))


def tier_for_rows(rows: Column | str) -> Column:
    rows = F.col(rows) if isinstance(rows, str) else rows
    return F.when(rows > S.HEAVY_ABOVE_ROWS, "heavy").when(rows >= S.MEDIUM_FROM_ROWS, "medium").otherwise("light")


def tier_value(name: str, tier: Column | str = "size_tier") -> Column:
    """A setting of the row's tier, read from a literal map (three entries; no join)."""
    entries = [F.lit(x) for t, v in S.TIERS.items() for x in (t, v[name])]
    tier = F.col(tier) if isinstance(tier, str) else tier
    return F.try_element_at(F.create_map(*entries).cast("map<string,int>"), F.coalesce(tier, F.lit(S.DEFAULT_TIER)))


def with_tier(manifest: DataFrame, override: str = "batch_rows") -> DataFrame:
    """Adds the settings of the tier; a batch size given for the table wins."""
    chosen = tier_value("batch_rows").cast("bigint")
    if override in manifest.columns:
        chosen = F.coalesce(F.col(override).cast("bigint"), chosen)
    return manifest.withColumns({
        "batch_rows": chosen,
        **{n: tier_value(n).cast("bigint") for n in ("chunk_months", "retries", "retry_minutes")}})


def chunk_stats(df: DataFrame, column: str, months: int, start: str, end: str, keys: list[str]) -> DataFrame:
    """Rows, null-key rows and highest watermark per planned chunk in one aggregate.

    Rows with a null or out-of-range value go to ``unassigned``.
    """
    day, first, stop = F.to_date(column), F.trunc(F.lit(start).cast("date"), "MM"), F.lit(end).cast("date")
    gap = (F.year(day) - F.year(first)) * 12 + F.month(day) - F.month(first)
    begin = F.add_months(first, (F.floor(gap / months) * months).cast("int"))
    inside = (day >= first) & (day < stop)
    label = F.when(inside, F.date_format(begin, "yyyy-MM")).otherwise("unassigned")
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return df.groupBy(label.alias("label")).agg(
        F.count(F.lit(1)).alias("rows_read"), F.count_if(~null_key).alias("rows_kept"),
        F.count_if(null_key).alias("rows_skipped"),
        F.max(F.when(~null_key, F.col(column))).alias("watermark_end"))
