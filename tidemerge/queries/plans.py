"""Load plans over manifests and state that grow with the tables."""

from pyspark.sql import functions as F

from tidemerge import plans as P
from tidemerge.queries import stand_ins as SI
from tidemerge.queries.base import query, stamp_sql
from tidemerge.queries.stand_in_sql import EVENTS_AS_OF

_SPANS_SQL = """SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS a, CAST(MAX(o_orderdate) AS DATE) AS b
                FROM orders GROUP BY o_custkey"""


def _spans(t):
    """First and last order day per customer."""
    return t.orders.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("start_date"),
                                             F.to_date(F.max("o_orderdate")).alias("end_date"))


def _chunks_sql(months: int) -> str:
    return f"""
        SELECT o_custkey, strftime(s, '%Y-%m-%d') AS chunk_start,
               strftime(least(s + INTERVAL {months} MONTH, CAST(b AS TIMESTAMP)), '%Y-%m-%d') AS chunk_end, strftime(s, '%Y-%m') AS label
        FROM (SELECT o_custkey, b, unnest(generate_series(date_trunc('month', CAST(a AS TIMESTAMP)), CAST(b AS TIMESTAMP) - INTERVAL 1 DAY,
                                                          INTERVAL {months} MONTH)) AS s FROM ({_SPANS_SQL}))"""


@query("plan_month_chunks", _chunks_sql(1))
def _(t):
    return P.month_chunks(_spans(t), 1)


@query("plan_quarter_chunks", _chunks_sql(3))
def _(t):
    return P.month_chunks(_spans(t), 3)


def _manifest(t):
    return SI.state(t).select("table_key", "size_tier", F.lit("2022-01-01").alias("history_start"),
                              F.when(F.col("last_run_status") == "failed", 1000).alias("batch_rows"))


@query("plan_full_load", """
    SELECT table_key, size_tier, '2022-01-01' AS watermark_start, '2024-01-31' AS watermark_end, 'full' AS label,
           'historical' AS run_type FROM s_state WHERE size_tier = 'light'""")
def _(t):
    return P.full_chunk(_manifest(t).drop("batch_rows"), EVENTS_AS_OF)


@query("plan_tier_settings", """
    SELECT table_key, size_tier, CAST(CASE WHEN last_run_status = 'failed' THEN 1000 ELSE b END AS BIGINT) AS batch_rows,
           CAST(m AS BIGINT) AS chunk_months, CAST(r AS BIGINT) AS retries, CAST(w AS BIGINT) AS retry_minutes FROM s_state
    JOIN (VALUES ('heavy', 50000, 1, 3, 10), ('medium', 25000, 3, 3, 5), ('light', 10000, NULL, 2, 2)) v(k, b, m, r, w)
      ON k = size_tier""")
def _(t):
    return P.with_tier(_manifest(t)).drop("history_start")


_RESUME_SQL = """SELECT table_key, size_tier, last_watermark_value, historical_completed_at,
        COALESCE(CAST(top AS DATE), DATE '2022-01-01') AS resume_from
    FROM s_state LEFT JOIN (SELECT 'ds.t' || user_id AS table_key, MAX(ts) FILTER (WHERE value > 200) AS top FROM events GROUP BY ALL)
    USING (table_key)"""


def _loaded(t):
    """Rows in the targets: all events; only the large ones carry a loaded time, so some tables have none."""
    return t.events.select(F.concat(F.lit("ds.t"), "user_id").alias("table_key"), F.when(F.col("value") > 200, F.col("ts")).alias("ts"))


@query("plan_resume_point", f"""
    SELECT table_key, strftime(resume_from, '%Y-%m-%d') AS resume_from FROM ({_RESUME_SQL})""")
def _(t):
    return P.resume_point(_manifest(t), _loaded(t), "ts").select("table_key", "resume_from")


@query("plan_load_mode", f"""
    WITH b AS ({_RESUME_SQL}), h AS (
        SELECT table_key, size_tier, CASE WHEN size_tier = 'heavy' THEN 1 ELSE 3 END AS n, unnest(generate_series(
                   date_trunc('month', CAST(resume_from AS TIMESTAMP)), TIMESTAMP '2024-01-30',
                   CASE WHEN size_tier = 'heavy' THEN INTERVAL 1 MONTH ELSE INTERVAL 3 MONTH END)) AS s
        FROM b WHERE historical_completed_at IS NULL AND size_tier <> 'light')
    SELECT table_key, size_tier, 'incremental' AS run_type, 'incremental' AS label,
           COALESCE(replace(last_watermark_value, '"', ''), '2024-01-28T00:00:00.000000') AS watermark_start,
           '2024-01-31' AS watermark_end FROM b WHERE historical_completed_at IS NOT NULL
    UNION ALL SELECT table_key, size_tier, 'historical', 'full', '2022-01-01', '2024-01-31' FROM b
              WHERE historical_completed_at IS NULL AND size_tier = 'light'
    UNION ALL SELECT table_key, size_tier, 'historical', strftime(s, '%Y-%m'), strftime(s, '%Y-%m-%d'),
                     strftime(least(s + to_months(n), TIMESTAMP '2024-01-31'), '%Y-%m-%d') FROM h""")
def _(t):
    return P.plan_load(_manifest(t), SI.state(t), _loaded(t), EVENTS_AS_OF, "ts")


_WM_SQL = "CAST(replace(replace(last_watermark_value, '\"', ''), 'T', ' ') AS TIMESTAMP)"


@query("plan_incremental_chunk", f"""
    SELECT table_key, {stamp_sql(f"COALESCE({_WM_SQL}, TIMESTAMP '2024-01-28 00:00:00')")} AS read_after,
           '2024-01-31' AS watermark_end, 'incremental' AS label, 'incremental' AS run_type FROM s_state""")
def _(t):
    return P.incremental_chunk(SI.state(t), EVENTS_AS_OF)


@query("plan_fallback_window", f"""
    SELECT table_key, {stamp_sql(f"COALESCE({_WM_SQL}, TIMESTAMP '2024-01-26 00:00:00')")} AS watermark,
           last_watermark_value IS NULL AS used_fallback FROM s_state""")
def _(t):
    return P.with_fallback(SI.state(t), EVENTS_AS_OF, 5).select("table_key", "watermark", "used_fallback")


@query("plan_cursor_window", f"""
    SELECT pipeline_name, entity_type,
           {stamp_sql('''COALESCE(last_cursor_at - to_seconds(CASE entity_type WHEN 'contacts' THEN 600 ELSE 300 END),
               TIMESTAMP '2024-01-30 23:58:00' - to_minutes(CASE entity_type WHEN 'contacts' THEN 1440 ELSE 240 END))''')} AS window_from,
           '2024-01-30 23:58:00.000000' AS window_until FROM s_cursors""")
def _(t):
    return P.cursor_window(SI.cursors(t), EVENTS_AS_OF).select("pipeline_name", "entity_type", "window_from", "window_until")


@query("plan_backfill_window", f"""
    SELECT o_orderkey, {stamp_sql('o_orderdate')} AS window_from,
           CASE WHEN o_orderstatus <> 'P' THEN {stamp_sql('o_orderdate + INTERVAL 6 HOUR')} END AS window_until,
           FALSE AS advance_cursor FROM orders""")
def _(t):
    until = F.when(F.col("o_orderstatus") == "P", "soon").otherwise(
        F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 8 HOURS"), "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
    requests = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("from_iso"),
                               until.alias("until_iso"))
    return P.backfill_window(requests).select("o_orderkey", "window_from", "window_until", "advance_cursor")


@query("plan_api_subwindows", f"""
    SELECT user_id, {stamp_sql('s')} AS piece_from, {stamp_sql('least(s + INTERVAL 7 DAY, b)')} AS piece_until
    FROM (SELECT user_id, b, unnest(generate_series(a, b, INTERVAL 7 DAY)) AS s
          FROM (SELECT user_id, MIN(ts) AS a, MAX(ts) AS b FROM events GROUP BY user_id)) WHERE s < b""")
def _(t):
    spans = t.events.groupBy("user_id").agg(F.min("ts").alias("window_from"), F.max("ts").alias("window_until"))
    return P.subwindows(spans, 7)


@query("chunk_row_counts", f"""
    SELECT CASE WHEN d >= DATE '1996-02-01' AND d < DATE '2001-06-15'
                THEN strftime(DATE '1996-02-01' + to_months(CAST(floor(((year(d) - 1996) * 12 + month(d) - 2) / 3) * 3 AS INTEGER)), '%Y-%m')
                ELSE 'unassigned' END AS label,
           COUNT(*) AS rows_read, COUNT(turn_message_id) AS rows_kept, COUNT(*) - COUNT(turn_message_id) AS rows_skipped,
           {stamp_sql('MAX(CASE WHEN turn_message_id IS NOT NULL THEN message_timestamp END)')} AS watermark_end
    FROM (SELECT *, CAST(message_timestamp AS DATE) AS d FROM s_faulty) GROUP BY label""")
def _(t):
    return P.chunk_stats(SI.faulty(t), "message_timestamp", 3, "1996-02-17", "2001-06-15", ["turn_message_id"])


@query("sample_window_rows", " UNION ALL ".join(
    f"SELECT '{e}' AS entity_type, COUNT(*) AS row_count, {stamp_sql(f'MIN({c})')} AS min_ts, {stamp_sql(f'MAX({c})')} AS max_ts "
    f"FROM s_{e} WHERE {c} >= TIMESTAMP '2000-06-01 06:00:00' - INTERVAL {h} HOUR AND {c} < TIMESTAMP '2000-06-01 06:00:00'"
    for e, c, h in (("messages", "message_timestamp", 72), ("statuses", "status_timestamp", 72),
                    ("contacts", "turn_updated_at", 168))))
def _(t):
    return P.sample_window({"messages": (SI.messages(t), "message_timestamp"), "statuses": (SI.statuses(t), "status_timestamp"),
                            "contacts": (SI.contacts(t), "turn_updated_at")}, "2000-06-01 06:00:00")
