"""Dedupe, merges, appends, schema growth and loads."""

from pyspark.sql import functions as F

from tidemerge.functions import scalars as S
from tidemerge.operators import load as L
from tidemerge.operators import merge as M
from tidemerge.operators.published import publish
from tidemerge.operators.views import message_volume_daily
from tidemerge.queries import stand_ins as SI
from tidemerge.queries.base import INPUT_TABLES, columns_of, query, stamp_sql
from tidemerge.queries.scalars import _STATUS_KEY_SQL, status_key_of
from tidemerge.queries.stand_in_sql import AS_OF
from tidemerge.session import work_path

_KEYS, _ORDER = SI.MERGE_KEYS, SI.MERGE_ORDER
_COLS = f"message_id, seq, status, amount, {stamp_sql('ts')} AS ts"


@query("dedupe_first", f"SELECT {_COLS} FROM s_batch_ranked WHERE rf = 1")
def _(t):
    return M.dedupe(SI.merge_batch(t), _KEYS, _ORDER, "first")


@query("dedupe_last", f"SELECT {_COLS} FROM s_batch_ranked WHERE rl = 1")
def _(t):
    return M.dedupe(SI.merge_batch(t), _KEYS, _ORDER, "last")


@query("merge_insert_only", f"""
    SELECT {_COLS} FROM s_target
    UNION ALL SELECT {_COLS} FROM s_batch_ranked b WHERE rf = 1 AND NOT EXISTS (
        SELECT 1 FROM s_target t WHERE t.message_id = b.message_id AND t.seq = b.seq)""")
def _(t):
    return M.merge_insert_only(SI.merge_target(t), SI.merge_batch(t), _KEYS, _ORDER)


@query("merge_insert_filtered", f"""
    SELECT {_COLS} FROM s_batch_ranked WHERE rf = 1
    UNION ALL SELECT {_COLS} FROM s_target t WHERE NOT EXISTS (
        SELECT 1 FROM s_batch b WHERE t.message_id = b.message_id AND t.seq = b.seq)""")
def _(t):
    """The orders into the line items: few keys against many, which their filter keeps out of the shuffle."""
    held = M.dedupe(SI.merge_batch(t), _KEYS, _ORDER, "first")
    return M.merge_insert_only(held, SI.merge_target(t), _KEYS, _ORDER, batch_rows=t.orders.count())


@query("merge_update_columns", f"""
    SELECT COALESCE(t.message_id, f.message_id) AS message_id, COALESCE(t.seq, f.seq) AS seq,
           CASE WHEN l.message_id IS NOT NULL THEN l.status ELSE t.status END AS status,
           COALESCE(t.amount, f.amount) AS amount, {stamp_sql('COALESCE(t.ts, f.ts)')} AS ts
    FROM s_target t FULL JOIN (SELECT * FROM s_batch_ranked WHERE rf = 1) f ON t.message_id = f.message_id AND t.seq = f.seq
    LEFT JOIN (SELECT * FROM s_batch_ranked WHERE rl = 1) l ON l.message_id = f.message_id AND l.seq = f.seq""")
def _(t):
    return M.merge_update(SI.merge_target(t), SI.merge_batch(t), _KEYS, ["status"], _ORDER)


@query("merge_update_all", f"""
    SELECT {_COLS} FROM s_batch_ranked WHERE rl = 1
    UNION ALL SELECT {_COLS} FROM s_target t WHERE NOT EXISTS (
        SELECT 1 FROM s_batch b WHERE t.message_id = b.message_id AND t.seq = b.seq)""")
def _(t):
    return M.merge_replace(SI.merge_target(t), SI.merge_batch(t), _KEYS, _ORDER)


@query("append_rows", f"SELECT {_COLS} FROM s_target UNION ALL SELECT {_COLS} FROM s_batch")
def _(t):
    return M.append(SI.merge_target(t), SI.merge_batch(t))


@query("drop_null_keys", """
    SELECT turn_message_id, contact_wa_id, message_type, direction FROM s_faulty WHERE turn_message_id IS NOT NULL""")
def _(t):
    return M.drop_null_keys(SI.faulty(t), ["turn_message_id"]).select(
        "turn_message_id", "contact_wa_id", "message_type", "direction")


@query("drop_null_keys_stats", """
    SELECT COUNT(turn_message_id) AS rows_kept, COUNT(*) - COUNT(turn_message_id) AS rows_skipped FROM s_faulty""")
def _(t):
    return M.null_key_stats(SI.faulty(t), ["turn_message_id"])


@query("stamp_loaded_at", f"SELECT o_orderkey, {stamp_sql(f'''TIMESTAMP '{AS_OF}' ''')} AS _loaded_at FROM orders")
def _(t):
    return M.stamp(t.orders.select("o_orderkey"), AS_OF)


_TARGET_NAMES = {"int": "bigint", "array<float>": "string"}


def _schema_sql() -> str:
    parts = []
    for table in INPUT_TABLES:
        for i, (c, kind) in enumerate(columns_of(table)):
            parts.append(f"SELECT '{table}' AS table_name, CAST({i} AS BIGINT) AS position, '{c}' AS column_name, "
                         f"'{_TARGET_NAMES.get(kind, kind)}' AS target_type, COUNT(*) - COUNT({c}) AS null_count FROM {table}")
        parts.append(f"SELECT '{table}', {len(columns_of(table))}, '_loaded_at', 'timestamp', 0")
    return f"SELECT *, null_count = 0 AS can_be_required FROM ({' UNION ALL '.join(parts)})"


@query("create_target_schema", _schema_sql())
def _(t):
    return M.schema_table(t.discovered, t.paths)


@query("evolve_add_columns", """
    SELECT p_partkey AS id, p_name AS name, p_size AS size, CAST(NULL AS DOUBLE) AS balance FROM part
    UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def _(t):
    target = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                           F.col("p_size").alias("size"))
    batch = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return M.evolve(target, batch)


@query("insert_returning_stats", """
    SELECT COUNT(*) AS rows_seen, COUNT(*) FILTER (WHERE rf = 1 AND NOT hit) AS rows_written,
           COUNT(*) - COUNT(*) FILTER (WHERE rf = 1 AND NOT hit) AS rows_deduped
    FROM (SELECT rf, EXISTS (SELECT 1 FROM s_target t WHERE t.message_id = b.message_id AND t.seq = b.seq) AS hit
          FROM s_batch_ranked b)""")
def _(t):
    return M.insert_stats(SI.merge_target(t), SI.merge_batch(t), _KEYS)


@query("load_messages_raw", f"""
    WITH t AS (SELECT 'export_messages' AS source, o_orderkey || '-1' AS turn_message_id, o_orderstatus AS message_type,
                      o_orderdate AS message_timestamp FROM orders),
    b AS (SELECT 'export_messages' AS source, l_orderkey || '-' || l_linenumber AS turn_message_id,
                 l_returnflag AS message_type, l_shipdate AS message_timestamp FROM lineitem),
    f AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY turn_message_id ORDER BY message_timestamp, message_type) AS rf FROM b),
    u AS (SELECT * FROM t UNION ALL SELECT * EXCLUDE (rf) FROM f WHERE rf = 1
          AND turn_message_id NOT IN (SELECT turn_message_id FROM t))
    SELECT source, turn_message_id, message_type, {stamp_sql('message_timestamp')} AS message_timestamp FROM u""")
def _(t):
    def rows(df, key, kind, ts):
        return df.select(F.lit("export_messages").alias("source"), key.alias("turn_message_id"),
                         F.col(kind).alias("message_type"), F.col(ts).cast("timestamp").alias("message_timestamp"))
    target = rows(t.orders, F.concat("o_orderkey", F.lit("-1")), "o_orderstatus", "o_orderdate")
    batch = rows(t.lineitem, F.concat_ws("-", "l_orderkey", "l_linenumber"), "l_returnflag", "l_shipdate")
    return L.load_messages(target, batch)


@query("load_statuses_raw", f"""
    WITH b AS (SELECT turn_message_id, status, status_timestamp, recipient_id FROM s_statuses
               UNION ALL SELECT o_orderkey, 'sent', o_orderdate, o_custkey FROM orders)
    SELECT DISTINCT 'export_statuses' AS source, {_STATUS_KEY_SQL} AS status_event_key, turn_message_id, status,
           {stamp_sql('status_timestamp')} AS status_timestamp FROM b""")
def _(t):
    def rows(df):
        return S.evaluated_once(
            status_key_of(df).withColumnRenamed("status_event_key", "_key"), status_event_key=F.col("_key")).select(F.lit("export_statuses").alias("source"), "status_event_key", "turn_message_id",
                                        "status", F.col("status_timestamp").cast("timestamp").alias("status_timestamp"))
    loaded = t.orders.select(F.col("o_orderkey").alias("turn_message_id"), F.lit("sent").alias("status"),
                             F.col("o_orderdate").alias("status_timestamp"), F.col("o_custkey").alias("recipient_id"))
    return L.load_statuses(rows(loaded), rows(SI.statuses(t).drop("seq")))


@query("load_contacts_snapshots", f"""
    WITH b AS (SELECT turn_contact_id, turn_updated_at, segment FROM s_contacts
               UNION ALL SELECT c_custkey, TIMESTAMP '1995-01-01', c_mktsegment FROM customer)
    SELECT DISTINCT 'export_contacts' AS source, turn_contact_id, {stamp_sql('turn_updated_at')} AS turn_updated_at,
           sha256('{{"id":' || turn_contact_id || ',"segment":"' || segment || '"}}') AS payload_hash FROM b""")
def _(t):
    def rows(df):
        payload = F.to_json(F.struct("segment", F.col("turn_contact_id").alias("id")))
        hashed = S.evaluated_once(df.withColumn("_payload", payload), _hash=S.payload_hash(F.col("_payload")))
        return hashed.select(F.lit("export_contacts").alias("source"), "turn_contact_id",
                             F.col("turn_updated_at").cast("timestamp").alias("turn_updated_at"), F.col("_hash").alias("payload_hash"))
    loaded = t.customer.select(F.col("c_custkey").alias("turn_contact_id"), F.lit("1995-01-01").alias("turn_updated_at"),
                               F.col("c_mktsegment").alias("segment"))
    return L.load_contacts(rows(loaded), rows(SI.contacts(t)))


@query("publish_view", """
    SELECT strftime(message_timestamp, '%Y-%m-%d') AS metric_date, direction, message_type, COUNT(*) AS message_count,
           COUNT(DISTINCT contact_wa_id) AS unique_contacts FROM s_messages GROUP BY ALL""")
def _(t):
    return publish(message_volume_daily(SI.messages(t)), work_path(t.spark, "publish"), "1")
