"""Streams run to completion over the event files, results read back from their sinks."""

from pyspark.sql import functions as F

from tidemerge.operators.bucketed import buckets_for, read_target
from tidemerge.queries import stand_ins as SI
from tidemerge.queries.base import INPUT_TABLES, query, stamp_sql
from tidemerge.queries.normalized import _STATUS_TIME
from tidemerge.session import work_path
from tidemerge.streaming import (
    collect_orphans, dedupe_stream, dropped_rows, ingest_stream, late_rows, run_available, volume_stream,
)


class _EventStream:
    """The event files as a stream, in the place of ``Tables``."""

    def __init__(self, t):
        self.spark, self.folder = t.spark, t.folder

    @property
    def events(self):
        reader = self.spark.readStream.schema(INPUT_TABLES["events"]).option("pathGlobFilter", "events*.parquet")
        return reader.parquet(self.folder)


@query("stream_ingest_statuses", f"""
    SELECT 'm' || event_id AS turn_message_id, {stamp_sql(_STATUS_TIME)} AS status_timestamp,
           CASE event_type WHEN 'signup' THEN 'sent' WHEN 'view' THEN 'delivered' WHEN 'click' THEN 'read' ELSE 'failed' END AS status
    FROM events WHERE event_type <> 'error' AND value <= 200""")
def _(t):
    pages = SI.status_pages(_EventStream(t))
    twice = pages.unionAll(SI.status_pages(_EventStream(t)))  # overlapping reads deliver everything again
    path = work_path(t.spark, "statuses")
    ingest_stream(twice, "statuses", path, work_path(t.spark, "checkpoint"), "run-1", buckets=buckets_for(t.events.count()),
                  tasks=t.spark.sparkContext.defaultParallelism)
    return read_target(t.spark, path).select("turn_message_id", "status_timestamp", "status")


@query("stream_dedupe_events", "SELECT event_id, user_id, event_type FROM events")
def _(t):
    source = _EventStream(t)
    rows = source.events.unionAll(source.events).withColumn("ts", F.col("ts").cast("timestamp"))
    # the delay spans the whole range of the events, so no row counts as late
    unique = dedupe_stream(rows, ["event_id"], "ts", "60 days").select("event_id", "user_id", "event_type")
    path = work_path(t.spark, "unique")
    run_available(unique, work_path(t.spark, "checkpoint"),
                  lambda b, n: b.write.mode("overwrite").parquet(f"{path}/batch_id={n}"))
    return t.spark.read.parquet(path).drop("batch_id")


@query("stream_volume_daily", """
    SELECT strftime(ts, '%Y-%m-%d') AS metric_date, event_type, COUNT(*) AS row_count FROM events GROUP BY ALL""")
def _(t):
    rows = _EventStream(t).events.withColumn("ts", F.col("ts").cast("timestamp"))
    path = work_path(t.spark, "volume")
    volume_stream(rows, "ts", ["event_type"], path, work_path(t.spark, "checkpoint"))
    return read_target(t.spark, path)


@query("stream_late_data", f"""
    SELECT COUNT(*) AS rows_seen, COUNT(*) FILTER (WHERE s < TIMESTAMP '2024-01-15 11:53:00') AS rows_late,
           {stamp_sql("MIN(CASE WHEN s < TIMESTAMP '2024-01-15 11:53:00' THEN s END)")} AS oldest_late
    FROM (SELECT CASE WHEN event_type = 'error' THEN ts - INTERVAL 2 DAY ELSE ts END AS s FROM events)""")
def _(t):
    shifted = F.when(F.col("event_type") == "error", F.col("ts") - F.expr("INTERVAL 2 DAYS")).otherwise(F.col("ts"))
    rows = _EventStream(t).events.select("event_id", shifted.cast("timestamp").alias("ts"))
    path = work_path(t.spark, "late")
    late_rows(rows, "ts", "2024-01-15 12:00:00", "420 SECONDS", path, work_path(t.spark, "checkpoint"))
    batches = t.spark.read.parquet(path)
    return batches.agg(F.sum("rows_seen").alias("rows_seen"), F.sum("rows_late").alias("rows_late"),
                       F.min("oldest_late").alias("oldest_late"))


_LANDED = "CAST(floor(date_diff('day', TIMESTAMP '2024-01-01', s) / 7.0) AS BIGINT)"


def _landed_by_week(t):
    """Events as they land: errors twelve days late; one file a week of landing, in order."""
    at = F.when(F.col("event_type") == "error", F.col("ts") + F.expr("INTERVAL 12 DAYS")).otherwise(F.col("ts"))
    rows = t.events.select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"),
                           F.floor(F.datediff(at, F.lit("2024-01-01")) / 7).alias("week"))
    path = work_path(t.spark, "landed")
    weeks = sorted(r[0] for r in rows.select("week").distinct().collect())
    for week in weeks:
        rows.where(F.col("week") == week).drop("week").coalesce(1).write.mode("append").parquet(path)
    return t.spark.readStream.schema("event_id bigint, user_id bigint, event_type string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(path)


@query("stream_dropped_rows", f"""
    WITH e AS (SELECT ts, CASE WHEN event_type = 'error' THEN ts + INTERVAL 12 DAY ELSE ts END AS s FROM events),
    w AS (SELECT ts, {_LANDED} AS week FROM e),
    m AS (SELECT week, MAX(date_trunc('millisecond', ts)) AS top FROM w GROUP BY week),
    b AS (SELECT week, MAX(top) OVER (ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - INTERVAL 1 DAY AS mark FROM m)
    SELECT COUNT(*) AS rows_seen, COUNT(*) FILTER (WHERE ts <= mark) AS rows_dropped, COUNT(*) FILTER (WHERE mark IS NULL OR ts > mark) AS rows_kept
    FROM w JOIN b USING (week)""")
def _(t):
    path = work_path(t.spark, "dropped")
    _, report = dropped_rows(_landed_by_week(t), "ts", ["event_id"], "1 day", path, work_path(t.spark, "checkpoint"))
    figures = report.agg(F.sum("rows_seen").alias("rows_seen"), F.sum("rows_dropped").alias("rows_dropped"))
    return figures.crossJoin(t.spark.read.parquet(f"{path}/rows").agg(F.count(F.lit(1)).alias("rows_kept")))


@query("stream_orphans", """
    SELECT event_id, user_id FROM events s WHERE event_type = 'purchase' AND NOT EXISTS (
        SELECT 1 FROM events m WHERE m.event_type = 'view' AND m.user_id = s.user_id AND m.ts <= s.ts AND m.ts >= s.ts - INTERVAL 2 DAY)""")
def _(t):
    """Purchases that no view of the same user came before within two days; the last ones, which the watermarks leave
    open at the end of the stream, are decided by a join of the days that can matter."""
    events = _EventStream(t).events.withColumn("ts", F.col("ts").cast("timestamp"))
    bought = events.where("event_type = 'purchase'").select("event_id", "user_id", F.col("ts").alias("bought_at"))
    seen = events.where("event_type = 'view'").select("user_id", F.col("ts").alias("seen_at"))
    path = work_path(t.spark, "orphans")
    run = collect_orphans(bought, seen, "user_id", "bought_at", "seen_at", "2 DAYS", "1 hour", path, work_path(t.spark, "checkpoint"))
    mark = F.to_timestamp(F.lit(run.lastProgress["eventTime"].get("watermark"))) - F.expr("INTERVAL 1 MINUTE")
    rows = t.events.withColumn("ts", F.col("ts").cast("timestamp")).where(F.col("ts") >= mark - F.expr("INTERVAL 2 DAYS"))
    late = rows.where((F.col("event_type") == "purchase") & (F.col("ts") >= mark)).alias("s")
    views = rows.where("event_type = 'view'").alias("m")
    left = late.join(views, F.expr("m.user_id = s.user_id and m.ts <= s.ts and m.ts >= s.ts - INTERVAL 2 DAYS"), "left_anti")
    return t.spark.read.parquet(path).select("event_id", "user_id").union(left.select("event_id", "user_id")).distinct()
