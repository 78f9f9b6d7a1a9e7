"""Control state, run logs and status reports."""

from pyspark.sql import functions as F

from tidemerge.operators import state as ST
from tidemerge.operators.views import card
from tidemerge.queries import stand_ins as SI
from tidemerge.queries.base import Tables, columns_sql, query, report_columns_sql, stamp_sql
from tidemerge.queries.stand_in_sql import EVENTS_AS_OF

_CURSORS = ("pipeline_name string, entity_type string, last_cursor_at timestamp_ntz, last_window_start timestamp_ntz, "
            "last_window_end timestamp_ntz, last_run_id bigint, last_success_at timestamp_ntz, "
            "rows_seen_last_run bigint, rows_written_last_run bigint")


def empty_cursors(spark):
    return spark.createDataFrame([], _CURSORS)


def _halves(t: Tables):
    """State after the historical runs, and the incremental runs that come on top. Failed runs report a watermark too."""
    r = SI.runs(t).withColumn("watermark_end", F.col("started_at"))
    before = ST.fold_runs(ST.empty_state(t.spark), r.where("run_type = 'historical'"), "proj")
    return before, r.where("run_type = 'incremental'")


@query("sync_state_update", f"""
    WITH b AS (SELECT table_key, MAX(started_at) FILTER (WHERE status = 'success') AS wm, SUM(rows_transferred) AS n
          FROM s_runs GROUP BY table_key),
    l AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY table_key ORDER BY CASE WHEN run_type = 'incremental' THEN 0 ELSE 1 END,
                                started_at DESC, run_id DESC) AS k FROM s_runs) WHERE k = 1)
    SELECT table_key, 'proj' AS bq_project, 'ds' AS bq_dataset, split_part(table_key, '.', 2) AS bq_table,
           '"' || strftime(wm, '%Y-%m-%dT%H:%M:%S.%f') || '"' AS last_watermark_value, {stamp_sql('finished_at')} AS last_synced_at,
           rows_transferred AS rows_synced_last_run, CAST(n AS BIGINT) AS total_rows_synced, status AS last_run_status,
           CASE WHEN status <> 'success' THEN error_message END AS error_message
    FROM b JOIN l USING (table_key)""")
def _(t):
    before, later = _halves(t)
    return ST.fold_runs(before, later, "proj").select(
        "table_key", "bq_project", "bq_dataset", "bq_table", "last_watermark_value", "last_synced_at",
        "rows_synced_last_run", "total_rows_synced", "last_run_status", "error_message")


@query("historical_completion", """
    WITH c AS (SELECT 'ds.c' || o_custkey AS table_key, COUNT(*) AS n,
                      COUNT(*) FILTER (WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)) AS m,
                      bool_and(o_orderstatus <> 'P') AS historical FROM orders GROUP BY ALL)
    SELECT table_key, CASE WHEN historical AND CAST(m AS DOUBLE) / n >= 0.99 THEN '2024-01-31 00:00:00.000000' END AS historical_completed_at
    FROM c""")
def _(t):
    orders = t.orders.select("o_orderkey", "o_orderstatus", F.concat(F.lit("ds.c"), "o_custkey").alias("table_key"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("_hit", F.lit(1))
    counts = orders.join(lines, "o_orderkey", "left").groupBy("table_key").agg(
        F.count(F.lit(1)).alias("source_count"), F.count("_hit").alias("target_count"))
    modes = orders.select("table_key", F.when(F.col("o_orderstatus") == "P", "incremental").otherwise("historical").alias("run_type"))
    state = orders.select("table_key").distinct().withColumn("historical_completed_at", F.lit(None).cast("timestamp_ntz"))
    return ST.mark_complete(state, counts, modes, EVENTS_AS_OF).select("table_key", "historical_completed_at")


@query("sync_state_reset", """
    SELECT table_key, CASE WHEN last_run_status <> 'failed' THEN last_watermark_value END AS last_watermark_value,
           CASE WHEN last_run_status <> 'failed' THEN strftime(historical_completed_at, '%Y-%m-%d %H:%M:%S.%f') END AS historical_completed_at,
           total_rows_synced FROM s_state""")
def _(t):
    return ST.reset(SI.state(t), F.col("last_run_status") == "failed").select(
        "table_key", "last_watermark_value", "historical_completed_at", "total_rows_synced")


@query("sync_state_list", f"""
    SELECT table_key, last_watermark_value, {stamp_sql('last_synced_at')} AS last_synced_at, last_run_status, total_rows_synced,
           error_message, ROW_NUMBER() OVER (ORDER BY table_key) AS position FROM s_state""")
def _(t):
    return card(SI.state(t), ["table_key"], rank="position", columns=[
        "table_key", "last_watermark_value", "last_synced_at", "last_run_status", "total_rows_synced", "error_message"])


@query("transfer_run_log", f"""
    SELECT run_id, table_key, run_type, {stamp_sql('started_at')} AS started_at,
           CASE WHEN job <> 'view' THEN {stamp_sql('finished_at')} END AS finished_at,
           CASE WHEN job = 'view' THEN 'running' ELSE status END AS status,
           CASE WHEN job = 'view' THEN 0 ELSE rows_transferred END AS rows_transferred,
           CASE WHEN job = 'view' THEN 0 ELSE bytes_scanned END AS bytes_scanned,
           CASE WHEN job <> 'view' THEN {stamp_sql('watermark_end')} END AS watermark_end,
           CASE WHEN job <> 'view' THEN error_message END AS error_message FROM s_runs""")
def _(t):
    r = SI.runs(t)
    return ST.close_runs(r.select("run_id", "table_key", "run_type", "started_at"), r.where("job <> 'view'"))


def _positioned(columns: dict[str, str], order: str) -> str:
    """Columns over ``s_state`` and the position of each row in an order of these columns."""
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM (SELECT {columns_sql(columns)} FROM s_state)"


@query("transfer_freshness", _positioned({
    "error_message": "error_message", "historical_done": "historical_completed_at IS NOT NULL",
    "total_rows_synced": "total_rows_synced", "rows_synced_last_run": "rows_synced_last_run", "last_run_status": "last_run_status",
    "minutes_since_sync": f"round(date_diff('microsecond', last_synced_at, TIMESTAMP '{EVENTS_AS_OF}') / 6e7, 2)",
    "last_synced_at": stamp_sql("last_synced_at"), "incremental_column": "incremental_column",
    "pg_full_id": "concat_ws('.', pg_schema, pg_table)", "bq_full_id": "concat_ws('.', bq_project, bq_dataset, bq_table)",
    "table_key": "table_key"}, "last_synced_at DESC NULLS LAST, table_key"))
def _(t):
    return card(ST.transfer_freshness(SI.state(t), EVENTS_AS_OF), [F.desc_nulls_last("last_synced_at"), "table_key"], rank="position")


@query("sync_status_report", _positioned({
    "urgency": "coalesce(list_position(['failed', 'running'], last_run_status), 3)::BIGINT - 1",
    "total_rows_synced": "total_rows_synced", "bq_table": "bq_table", "status": "last_run_status", **report_columns_sql()},
    "urgency, total_rows_synced, bq_table"))
def _(t):
    return card(ST.status_report(SI.state(t)), ["urgency", "total_rows_synced", "bq_table"], rank="position")


_CURSOR_SQL = f"""
    SELECT table_key AS pipeline_name, entity_type, {stamp_sql('window_end')} AS last_cursor_at,
           {stamp_sql('window_start')} AS last_window_start, {stamp_sql('window_end')} AS last_window_end, run_id AS last_run_id,
           {stamp_sql('finished_at')} AS last_success_at, rows_transferred AS rows_seen_last_run,
           rows_written AS rows_written_last_run FROM s_good_runs"""


@query("cursor_state_update", _CURSOR_SQL)
@query("pipeline_state_update", _CURSOR_SQL)
def _(t):
    runs = SI.pipeline_runs(t)
    earlier = ST.upsert_cursor(empty_cursors(t.spark), runs.where("entity_type = 'statuses'"))
    return ST.upsert_cursor(earlier, runs)


@query("ingestion_run_log", f"""
    SELECT run_id, entity_type, {stamp_sql('started_at')} AS started_at,
           CASE WHEN job <> 'view' THEN {stamp_sql('finished_at')} END AS finished_at,
           CASE WHEN job = 'view' THEN 'running' ELSE status END AS status,
           CASE WHEN job = 'view' THEN 0 ELSE rows_transferred END AS rows_seen,
           CASE WHEN job = 'view' THEN 0 ELSE rows_written END AS rows_written,
           CASE WHEN job = 'view' THEN 0 ELSE greatest(rows_transferred - rows_written, 0) END AS rows_deduped,
           CASE WHEN job = 'view' THEN '{{}}' ELSE '{{"job":"' || job || '"}}' END AS details,
           CASE WHEN job <> 'view' THEN error_message END AS error_message FROM s_runs""")
def _(t):
    r = SI.runs(t)
    starts = r.select("run_id", "entity_type", "started_at")
    again = starts.withColumn("started_at", F.col("started_at") + F.expr("INTERVAL 1 HOUR"))  # a repeated start is ignored
    finishes = r.where("job <> 'view'").select(
        "run_id", "finished_at", "status", F.col("rows_transferred").alias("rows_seen"), "rows_written",
        F.to_json(F.struct("job")).alias("details"), "error_message")
    return ST.run_log(starts.unionAll(again), finishes)


@query("ingestion_error_log", """
    SELECT run_id, entity_type, 'extract' AS error_stage, error_message,
           '{"table_key":"' || table_key || '","rows_written":' || rows_written || '}' AS error_context
    FROM s_runs WHERE status = 'failed'""")
def _(t):
    return ST.error_log(SI.runs(t), "extract", ["table_key", "rows_written"])
