"""Daily and sanity views, and the report queries over them."""

from pyspark.sql import functions as F

from tidemerge.operators import increments as I
from tidemerge.operators import views as V
from tidemerge.operators.bucketed import buckets_for
from tidemerge.operators.state import upsert_cursor
from tidemerge.operators.published import read_months, refresh_months
from tidemerge.queries import stand_ins as SI
from tidemerge.queries.base import query, stamp_sql
from tidemerge.queries.control import empty_cursors
from tidemerge.queries.stand_in_sql import AS_OF, EVENTS_AS_OF
from tidemerge.session import work_path

_VOLUME_SQL = """
    SELECT strftime(message_timestamp, '%Y-%m-%d') AS metric_date, direction, message_type, COUNT(*) AS message_count,
           COUNT(DISTINCT contact_wa_id) AS unique_contacts FROM s_messages GROUP BY ALL"""


@query("view_message_volume_daily", _VOLUME_SQL)
def volume(t):
    return V.message_volume_daily(SI.messages(t))


_FUNNEL_SQL = """
    SELECT metric_date, COALESCE(outbound_messages, 0) AS outbound_messages, COALESCE(sent_messages, 0) AS sent_messages,
           COALESCE(delivered_messages, 0) AS delivered_messages, COALESCE(read_messages, 0) AS read_messages,
           COALESCE(failed_messages, 0) AS failed_messages,
           round(CAST(delivered_messages AS DOUBLE) * 100.0 / NULLIF(sent_messages, 0), 2) AS delivery_rate_pct,
           round(CAST(read_messages AS DOUBLE) * 100.0 / NULLIF(delivered_messages, 0), 2) AS read_rate_pct
    FROM (SELECT strftime(message_timestamp, '%Y-%m-%d') AS metric_date, COUNT(*) AS outbound_messages
          FROM s_messages WHERE direction = 'outbound' GROUP BY ALL)
    FULL JOIN (SELECT strftime(status_timestamp, '%Y-%m-%d') AS metric_date,
                      COUNT(DISTINCT CASE WHEN status = 'sent' THEN turn_message_id END) AS sent_messages,
                      COUNT(DISTINCT CASE WHEN status = 'delivered' THEN turn_message_id END) AS delivered_messages,
                      COUNT(DISTINCT CASE WHEN status = 'read' THEN turn_message_id END) AS read_messages,
                      COUNT(DISTINCT CASE WHEN status = 'failed' THEN turn_message_id END) AS failed_messages
               FROM s_statuses GROUP BY ALL) USING (metric_date)"""


@query("view_status_funnel_daily", _FUNNEL_SQL)
def funnel(t):
    return V.status_funnel_daily(SI.messages(t), SI.statuses(t))


_CONTACTS_SQL = """
    SELECT strftime(turn_updated_at, '%Y-%m-%d') AS metric_date, COUNT(*) AS snapshot_count,
           COUNT(DISTINCT turn_contact_id) AS contacts_touched, COUNT(*) FILTER (WHERE opted_in) AS opted_in_snapshots,
           COUNT(*) FILTER (WHERE onboarded) AS onboarded_snapshots FROM s_contacts GROUP BY ALL"""


@query("view_contact_snapshots_daily", _CONTACTS_SQL)
def contact_days(t):
    return V.contact_snapshots_daily(SI.contacts(t))


_FRESHNESS_SQL = f"""
    SELECT table_key AS pipeline_name, entity_type,
           round((epoch_us(TIMESTAMP '{EVENTS_AS_OF}') - epoch_us(finished_at)) / 6e7, 2) AS freshness_minutes,
           rows_transferred AS rows_seen_last_run, rows_written AS rows_written_last_run,
           {stamp_sql('finished_at')} AS last_success_at FROM s_good_runs"""


@query("view_pipeline_freshness", _FRESHNESS_SQL)
def freshness(t):
    state = upsert_cursor(empty_cursors(t.spark), SI.pipeline_runs(t))
    return V.pipeline_freshness(state, EVENTS_AS_OF)


_SNAPSHOT_SQL = f"""
    SELECT {stamp_sql(f"TIMESTAMP '{AS_OF}'")} AS generated_at,
        (SELECT round((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(MAX(received_at))) / 6e7, 2) FROM s_webhooks) AS webhook_freshness_minutes,
        (SELECT round((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(MAX(message_timestamp))) / 6e7, 2) FROM s_redelivered) AS message_freshness_minutes,
        (SELECT round((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(MAX(status_timestamp))) / 6e7, 2) FROM s_statuses) AS status_freshness_minutes,
        (SELECT round((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(MAX(turn_updated_at))) / 6e7, 2) FROM s_contacts) AS contact_freshness_minutes,
        (SELECT COUNT(turn_message_id) - COUNT(DISTINCT turn_message_id) FROM s_redelivered) AS duplicate_messages,
        (SELECT COUNT(*) FROM s_contacts) - (SELECT COUNT(*) FROM (SELECT DISTINCT turn_contact_id, turn_updated_at FROM s_contacts)) AS duplicate_contact_snapshots,
        (SELECT COUNT(*) FROM s_statuses s WHERE NOT EXISTS (SELECT 1 FROM s_redelivered m WHERE m.turn_message_id = s.turn_message_id)) AS orphan_status_events,
        (SELECT COUNT(*) FROM s_redelivered WHERE trim(COALESCE(direction, '')) = '') AS messages_missing_direction,
        (SELECT COUNT(*) FROM s_redelivered WHERE trim(COALESCE(message_type, '')) = '') AS messages_missing_type,
        (SELECT COUNT(*) FROM s_runs WHERE status = 'failed' AND started_at - INTERVAL 8217 DAY > TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR
            AND started_at - INTERVAL 8217 DAY <= TIMESTAMP '{AS_OF}') AS failed_runs_24h"""


@query("view_sanity_snapshot", _SNAPSHOT_SQL)
def snapshot(t):
    return V.sanity_snapshot(SI.redelivered(t), SI.statuses(t), SI.contacts(t), SI.webhooks(t), SI.shifted_runs(t), AS_OF)


def _per_day(name, ts, table, extra=""):
    return (f"LEFT JOIN (SELECT CAST({ts} AS DATE) AS d, COUNT(*) AS {name} FROM {table} {extra} GROUP BY ALL) "
            f"AS j_{name} ON j_{name}.d = spine.d")


_TREND_SQL = f"""
    SELECT strftime(spine.d, '%Y-%m-%d') AS metric_date, COALESCE(webhook_deliveries, 0) AS webhook_deliveries,
           COALESCE(raw_messages, 0) AS raw_messages, COALESCE(raw_statuses, 0) AS raw_statuses,
           COALESCE(raw_contact_snapshots, 0) AS raw_contact_snapshots, COALESCE(failed_runs, 0) AS failed_runs
    FROM (SELECT CAST(g AS DATE) AS d FROM generate_series(TIMESTAMP '2001-07-04', TIMESTAMP '2001-08-02', INTERVAL 1 DAY) AS x(g)) spine
    {_per_day('webhook_deliveries', 'received_at', 's_webhooks')}
    {_per_day('raw_messages', 'message_timestamp', 's_messages')}
    {_per_day('raw_statuses', 'status_timestamp', 's_statuses')}
    {_per_day('raw_contact_snapshots', 'turn_updated_at', 's_contacts')}
    {_per_day('failed_runs', 'started_at - INTERVAL 8217 DAY', 's_runs', "WHERE status = 'failed'")}"""


@query("view_sanity_trend_30d", _TREND_SQL)
def trend(t):
    return V.sanity_trend(SI.messages(t), SI.statuses(t), SI.contacts(t), SI.webhooks(t), SI.shifted_runs(t), AS_OF)


# ---------------------------------------------------------------- report queries

def _ranked(sql: str, order: str) -> str:
    return f"SELECT *, ROW_NUMBER() OVER (ORDER BY {order}) AS position FROM ({sql})"


@query("card_pipeline_freshness", _ranked(_FRESHNESS_SQL, "freshness_minutes ASC NULLS LAST, pipeline_name"))
def card_freshness(t):
    return V.card(freshness(t), [F.asc_nulls_last("freshness_minutes"), "pipeline_name"], rank="position")


@query("card_sanity_snapshot", _SNAPSHOT_SQL)
def _(t):
    return V.card(snapshot(t))


@query("card_ingestion_trend", _ranked(_TREND_SQL, "metric_date"))
def _(t):
    return V.card(trend(t), ["metric_date"], rank="position")


@query("card_delivery_funnel", f"""
    SELECT *, ROW_NUMBER() OVER (ORDER BY metric_date DESC) AS position
    FROM (SELECT * FROM ({_FUNNEL_SQL}) ORDER BY metric_date DESC LIMIT 30)""")
def _(t):
    return V.card(funnel(t), [V.latest_first()], 30, rank="position")


@query("card_message_volume", f"""
    SELECT *, ROW_NUMBER() OVER (ORDER BY metric_date DESC, direction, message_type) AS position
    FROM (SELECT * FROM ({_VOLUME_SQL}) ORDER BY metric_date DESC, direction, message_type LIMIT 100)""")
def card_volume(t):
    return V.card(volume(t), [V.latest_first(), "direction", "message_type"], 100, rank="position")


_VOLUME_CARD_SQL = f"""
    SELECT *, ROW_NUMBER() OVER (ORDER BY metric_date DESC, direction, message_type) AS position
    FROM (SELECT * FROM ({_VOLUME_SQL}) ORDER BY metric_date DESC, direction, message_type LIMIT 100)"""


@query("published_volume_card", _VOLUME_CARD_SQL)
def _(t):
    """The report over published months: first the outbound messages, then all months that the others changed. The
    newest 100 months hold the 100 newest rows, whatever else was published."""
    path, messages = work_path(t.spark, "months"), SI.messages(t)
    refresh_months(V.message_volume_daily(messages.where("direction = 'outbound'")), path)
    refresh_months(V.message_volume_daily(messages), path, messages.select(F.to_date("message_timestamp").alias("metric_date")))
    return V.card(read_months(t.spark, path, 100), [V.latest_first(), "direction", "message_type"], 100, rank="position")


@query("published_funnel_card", f"""
    SELECT *, ROW_NUMBER() OVER (ORDER BY metric_date DESC) AS position
    FROM (SELECT * FROM ({_FUNNEL_SQL}) ORDER BY metric_date DESC LIMIT 30)""")
def _(t):
    path = work_path(t.spark, "months")
    refresh_months(funnel(t), path)
    return V.card(read_months(t.spark, path, 30), [V.latest_first()], 30, rank="position")


@query("card_contact_snapshots", _ranked(_CONTACTS_SQL, "metric_date"))
def _(t):
    return V.card(contact_days(t), ["metric_date"], rank="position")


_RETYPED_SQL = """
    SELECT strftime(message_timestamp, '%Y-%m-%d') AS metric_date, direction,
           CASE WHEN direction = 'inbound' THEN 'changed' ELSE message_type END AS message_type,
           COUNT(*) AS message_count, COUNT(DISTINCT contact_wa_id) AS unique_contacts FROM s_messages GROUP BY ALL"""


@query("view_volume_by_changes", _RETYPED_SQL)
def _(t):
    """Outbound messages, then the inbound ones, then a batch that retypes these; the view reads its counts alone."""
    path, messages = work_path(t.spark, "counts"), SI.messages(t)
    inbound = messages.where("direction = 'inbound'")
    I.add_counts(I.signed(I.volume_rows(messages.where("not (direction <=> 'inbound')"))), path, I.VOLUME, 1, buckets_for(messages.count()))
    I.add_counts(I.signed(I.volume_rows(inbound)), path, I.VOLUME, 2)
    retyped = inbound.withColumn("message_type", F.lit("changed"))
    I.add_counts(I.signed(I.volume_rows(retyped), I.volume_rows(inbound)), path, I.VOLUME, 3)
    return I.volume_daily(I.counts(t.spark, path))


@query("view_funnel_by_changes", """
    SELECT strftime(status_timestamp, '%Y-%m-%d') AS metric_date,
           COUNT(DISTINCT CASE WHEN status = 'sent' THEN turn_message_id END) AS sent_messages,
           COUNT(DISTINCT CASE WHEN status = 'delivered' THEN turn_message_id END) AS delivered_messages,
           COUNT(DISTINCT CASE WHEN status = 'read' THEN turn_message_id END) AS read_messages,
           COUNT(DISTINCT CASE WHEN status = 'failed' THEN turn_message_id END) AS failed_messages
    FROM s_statuses WHERE turn_message_id IS NOT NULL GROUP BY ALL""")
def _(t):
    """Statuses in two batches; the second withdraws and repeats the failed ones of the first."""
    path, statuses = work_path(t.spark, "funnel"), SI.statuses(t)
    early, late = statuses.where("status in ('sent', 'failed')"), statuses.where("status not in ('sent', 'failed')")
    failed = early.where("status = 'failed'")
    I.add_counts(I.signed(I.funnel_rows(early)), path, I.FUNNEL, 1, buckets_for(statuses.count()))
    I.add_counts(I.signed(I.funnel_rows(late.unionByName(failed)), I.funnel_rows(failed)), path, I.FUNNEL, 2)
    return I.status_daily(I.counts(t.spark, path))


@query("view_volume_sketched", f"""
    SELECT metric_date, direction, message_type, message_count, unique_contacts, TRUE AS estimate_within_error FROM ({_VOLUME_SQL})""")
def _(t):
    """Sketches of two batches whose days overlap, merged; exact counts of contacts beside them to show the error (5 sigma)."""
    path, messages = work_path(t.spark, "sketches"), I.volume_rows(SI.messages(t))
    by = I.VOLUME[:3]
    for batch, part in enumerate((messages.where("direction = 'outbound'"), messages.where("not (direction <=> 'outbound')"))):
        I.add_sketches(part, path, by, "contact_wa_id", batch, 8)
    exact = V.message_volume_daily(SI.messages(t)).withColumnsRenamed({c: f"e_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"e_{c}")) for c in by]
    joined = I.sketch_estimates(t.spark, path).join(exact, same)
    near = F.abs(F.col("unique_values") - F.col("unique_contacts")) <= F.col("unique_contacts") * (5 * 1.04 / 2 ** (I.SKETCH_BITS / 2))
    return joined.where("n = message_count").select(*by, "message_count", "unique_contacts", near.alias("estimate_within_error"))
