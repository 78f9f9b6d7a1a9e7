"""The input tables in the roles of messages, statuses, contacts, runs and state: SQL form."""

# --- fixed values: the instants that stand for "now"
AS_OF = "2001-08-02 00:00:00"       # after the last order
EVENTS_AS_OF = "2024-01-31 00:00:00"  # after the last event
CALENDAR_SHIFT_DAYS = 8217          # moves the events under the order calendar

STAND_INS = {
    "s_messages": """
        SELECT o_orderkey AS turn_message_id, o_custkey AS contact_wa_id, o_orderstatus AS message_type,
               o_orderdate AS message_timestamp, o_orderpriority AS priority, o_totalprice AS amount,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'outbound'
                    ELSE 'inbound' END AS direction
        FROM orders""",
    "s_faulty": """
        SELECT CASE WHEN priority = '4-NOT SPECIFIED' AND message_type = 'P' THEN NULL
                    ELSE turn_message_id END AS turn_message_id,
               contact_wa_id, message_timestamp, priority,
               CASE WHEN priority = '1-URGENT' AND amount > 400000 THEN NULL ELSE message_type END AS message_type,
               CASE WHEN priority = '5-LOW' AND message_type = 'P' THEN ' ' ELSE direction END AS direction
        FROM s_messages""",
    "s_redelivered": """
        SELECT * FROM s_faulty
        UNION ALL SELECT * FROM s_faulty WHERE priority = '1-URGENT'""",
    "s_statuses": """
        SELECT l_orderkey AS turn_message_id, CAST(l_linenumber AS BIGINT) AS seq, l_shipdate AS status_timestamp,
               l_suppkey AS recipient_id,
               CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN 'failed' WHEN l_returnflag = 'R' THEN 'read'
                    WHEN l_returnflag = 'A' THEN 'delivered' ELSE 'sent' END AS status
        FROM lineitem""",
    "s_contacts": """
        SELECT o_custkey AS turn_contact_id, o_orderdate AS turn_updated_at, c_name AS whatsapp_profile_name,
               c_mktsegment AS segment, c_mktsegment = 'MACHINERY' AS opted_in, c_acctbal > 0 AS onboarded
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "s_webhooks": """
        SELECT event_id, ts - INTERVAL 8217 DAY AS received_at FROM events""",
    "s_runs": """
        SELECT event_id AS run_id, 'ds.t' || CAST(user_id AS VARCHAR) AS table_key, event_type AS job,
               CASE WHEN event_type IN ('signup', 'view') THEN 'messages' WHEN event_type = 'click' THEN 'statuses'
                    ELSE 'contacts' END AS entity_type,
               ts AS started_at, ts + to_seconds(CAST(floor(value) AS BIGINT)) AS finished_at,
               value AS elapsed_seconds,
               CASE WHEN event_type = 'error' THEN 0 ELSE CAST(floor(value) AS BIGINT) END AS rows_transferred,
               CASE WHEN event_type = 'error' THEN 0 ELSE CAST(floor(value / 2) AS BIGINT) END AS rows_written,
               CAST(floor(value * 1000) AS BIGINT) AS bytes_scanned,
               CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
               CASE WHEN event_type = 'error' THEN 'boom ' || props END AS error_message,
               CASE WHEN event_type = 'signup' THEN 'historical' ELSE 'incremental' END AS run_type,
               CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS watermark_end,
               date_trunc('day', ts) AS window_start, ts AS window_end, value < 200 AS count_match
        FROM events""",
    "s_last_runs": """
        SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY table_key ORDER BY started_at DESC, run_id DESC) AS rn
                       FROM s_runs) WHERE rn = 1""",
    "s_state": """
        SELECT table_key, 'proj' AS bq_project, 'ds' AS bq_dataset, split_part(table_key, '.', 2) AS bq_table,
               'bq_import' AS pg_schema, split_part(table_key, '.', 2) AS pg_table, 'updated_at' AS incremental_column,
               '"' || strftime(watermark_end, '%Y-%m-%dT%H:%M:%S.%f') || '"' AS last_watermark_value,
               finished_at AS last_synced_at, rows_transferred AS rows_synced_last_run, total_rows_synced,
               status AS last_run_status, CASE WHEN status <> 'success' THEN error_message END AS error_message,
               historical_completed_at, rows_transferred * 60000 AS size_rows,
               CASE WHEN rows_transferred * 60000 > 5000000 THEN 'heavy'
                    WHEN rows_transferred * 60000 >= 100000 THEN 'medium' ELSE 'light' END AS size_tier
        FROM s_last_runs JOIN (
            SELECT table_key, CAST(SUM(rows_transferred) AS BIGINT) AS total_rows_synced,
                   CASE WHEN COUNT(*) FILTER (WHERE job = 'signup') > COUNT(*) FILTER (WHERE job = 'error')
                        THEN MAX(CASE WHEN job = 'signup' THEN started_at END) END AS historical_completed_at
            FROM s_runs GROUP BY table_key) USING (table_key)""",
    "s_cursors": """
        SELECT table_key AS pipeline_name, entity_type, watermark_end AS last_cursor_at FROM s_last_runs""",
    "s_good_runs": """
        SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY table_key ORDER BY finished_at DESC, run_id DESC) AS rn2
                       FROM s_runs WHERE status = 'success') WHERE rn2 = 1""",
    "s_target": """
        SELECT o_orderkey AS message_id, CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS seq, o_orderstatus AS status, o_totalprice AS amount,
               o_orderdate AS ts FROM orders""",
    "s_batch": """
        SELECT l_orderkey AS message_id, CAST(l_linenumber AS BIGINT) AS seq, l_linestatus AS status,
               l_extendedprice AS amount, l_shipdate AS ts FROM lineitem""",
    "s_batch_ranked": """
        SELECT *, ROW_NUMBER() OVER (PARTITION BY message_id, seq ORDER BY ts, status, amount) AS rf,
               ROW_NUMBER() OVER (PARTITION BY message_id, seq ORDER BY ts DESC, status DESC, amount DESC) AS rl
        FROM s_batch""",
}
