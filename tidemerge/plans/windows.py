"""Read windows of the cursor-based entities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemerge import settings as S


def entity_settings(name: str, entity: Column | str = "entity_type") -> Column:
    """A setting of the row's entity, read from a literal map (three entries; no join)."""
    entries = [F.lit(x) for e, v in S.ENTITIES.items() for x in (e, v[name])]
    return F.try_element_at(F.create_map(*entries), F.col(entity) if isinstance(entity, str) else entity)


def _seconds(n: Column | int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n if isinstance(n, Column) else F.lit(n))


def cursor_window(state: DataFrame, as_of, lag_seconds: int = S.SAFETY_LAG_SECONDS,
                  cursor: str = "last_cursor_at") -> DataFrame:
    """Adds [window_from, window_until): a lag behind now, overlapping the cursor, or a lookback
    where there is no cursor yet."""
    until = F.lit(as_of).cast("timestamp_ntz") - _seconds(lag_seconds)
    start = F.coalesce(F.col(cursor).cast("timestamp_ntz") - _seconds(entity_settings("overlap_seconds")),
                       until - _seconds(entity_settings("lookback_minutes") * 60))
    return state.withColumns({"window_from": start, "window_until": until})


def backfill_window(requests: DataFrame, start: str = "from_iso", end: str = "until_iso") -> DataFrame:
    """Typed bounds of explicit requests. Unreadable text gives NULL; the cursor never moves."""
    return requests.withColumns({
        "window_from": F.col(start).try_cast("timestamp"), "window_until": F.col(end).try_cast("timestamp"),
        "advance_cursor": F.lit(False)})


def subwindows(windows: DataFrame, days: Column | int, start: str = "window_from",
               end: str = "window_until") -> DataFrame:
    """Pieces of ``days`` days of each window, the last one cut at the end. Empty windows give none."""
    step = F.make_dt_interval(days if isinstance(days, Column) else F.lit(days))
    a, b = F.col(start), F.col(end)
    pieces = F.transform(F.sequence(a, F.greatest(a, b), step),
                         lambda t: F.struct(t.alias("piece_from"), F.least(t + step, b).alias("piece_until")))
    pieces = F.filter(pieces, lambda p: p["piece_from"] < b)
    kept = [c for c in windows.columns if c not in (start, end)]
    return windows.select(*kept, F.inline(F.when(a < b, pieces)))


def sample_window(tables: dict[str, tuple[DataFrame, str]], as_of) -> DataFrame:
    """Rows of each entity inside its sample lookback: count and time range. The range reaches the scan."""
    parts = []
    for entity, (df, ts) in tables.items():
        end = F.lit(as_of).cast(df.schema[ts].dataType)
        hours = F.make_dt_interval(F.lit(0), F.lit(S.ENTITIES[entity]["sample_hours"]))
        inside = df.where((F.col(ts) >= end - hours) & (F.col(ts) < end))
        parts.append(inside.agg(F.count(F.lit(1)).alias("row_count"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))
                     .select(F.lit(entity).alias("entity_type"), "row_count", "min_ts", "max_ts"))
    return reduce(DataFrame.unionByName, parts)
