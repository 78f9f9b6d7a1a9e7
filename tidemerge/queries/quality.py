"""Reconciliation, orphans, duplicates, summaries."""

from pyspark.sql import functions as F

from tidemerge.operators import digest as D
from tidemerge.operators import quality as Q
from tidemerge.operators.views import card
from tidemerge.queries import stand_ins as SI
from tidemerge.queries.base import query, stamp_sql


@query("reconcile_counts", """
    SELECT table_key, CAST(SUM(s) AS BIGINT) AS source_count, CAST(SUM(t) AS BIGINT) AS target_count,
           CAST(SUM(s) - SUM(t) AS BIGINT) AS difference, SUM(s) = SUM(t) AS count_match
    FROM (SELECT date_part('year', o_orderdate) AS table_key, 1 AS s, 0 AS t FROM orders
          UNION ALL SELECT date_part('year', l_shipdate), 0, 1 FROM lineitem) GROUP BY table_key""")
def _(t):
    year = lambda c: F.year(c).cast("bigint").alias("table_key")
    return Q.reconcile_counts(t.orders.select(year("o_orderdate")), t.lineitem.select(year("l_shipdate")), ["table_key"])


@query("reconcile_keys", """
    SELECT message_id, seq, 'missing' AS finding FROM (
        SELECT message_id, seq FROM s_batch EXCEPT SELECT message_id, seq FROM s_target)
    UNION ALL SELECT message_id, seq, 'extra' FROM (
        SELECT message_id, seq FROM s_target EXCEPT SELECT message_id, seq FROM s_batch)""")
def _(t):
    return Q.reconcile_keys(SI.merge_batch(t), SI.merge_target(t), SI.MERGE_KEYS)


_ODD_SQL = "o_orderpriority = '1-URGENT' AND o_totalprice > 200000"


def _drifted(t):
    """A copy of the orders that lost some rows, holds others under new keys, and drifted in one column."""
    odd = F.expr(_ODD_SQL)
    status = F.col("o_orderstatus")
    return t.orders.where(~(odd & (status == "F"))).select(
        F.when(odd & (status == "O"), -F.col("o_orderkey")).otherwise(F.col("o_orderkey")).alias("o_orderkey"), "o_custkey", "o_orderstatus",
        F.when(odd & (status == "P"), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"))


@query("reconcile_rows", f"""
    SELECT k AS o_orderkey, finding FROM (
        SELECT o_orderkey AS k, CASE o_orderstatus WHEN 'P' THEN 'changed' ELSE 'missing' END AS finding FROM orders WHERE {_ODD_SQL}
        UNION ALL SELECT -o_orderkey, 'extra' FROM orders WHERE {_ODD_SQL} AND o_orderstatus = 'O')""")
def _(t):
    return D.reconcile(t.orders, _drifted(t), ["o_orderkey"], ["o_custkey", "o_orderstatus", "o_totalprice"])


@query("reconcile_parts", """
    SELECT COUNT(*) AS source_count, COUNT(*) AS target_count, CAST(0 AS BIGINT) AS difference, TRUE AS count_match,
           CAST(0 AS BIGINT) AS unequal_leaves FROM lineitem""")
def _(t):
    """A table against two batches that make it up: the batches' digests are added, no row is compared."""
    keys, early = ["l_orderkey", "l_linenumber"], F.col("l_shipdate") < F.lit("1995-06-17").cast("timestamp_ntz")
    parts = [D.leaf_digests(t.lineitem.where(c), keys) for c in (early, ~early | F.col("l_shipdate").isNull())]
    added, whole = D.folded(parts[0].unionByName(parts[1]), 0), D.leaf_digests(t.lineitem, keys)
    return D.counted(whole, added).withColumn("unequal_leaves", F.lit(len(D.unequal(whole, added))).cast("long"))


@query("orphan_status_events", f"""
    SELECT turn_message_id, seq, status, {stamp_sql('status_timestamp')} AS status_timestamp FROM s_statuses s
    WHERE NOT EXISTS (SELECT 1 FROM s_messages m WHERE m.turn_message_id = s.turn_message_id AND direction = 'outbound')""")
def _(t):
    found = Q.orphans(SI.statuses(t), SI.messages(t).where("direction = 'outbound'"))
    return found.select("turn_message_id", "seq", "status", "status_timestamp")


@query("dup_messages", """
    SELECT turn_message_id, seq, COUNT(*) AS copies FROM s_statuses GROUP BY ALL HAVING COUNT(*) > 1""")
def _(t):
    return Q.duplicates(SI.statuses(t), ["turn_message_id", "seq"])


@query("dup_contact_snapshots", f"""
    SELECT turn_contact_id, {stamp_sql('turn_updated_at')} AS turn_updated_at, COUNT(*) AS copies
    FROM s_contacts GROUP BY turn_contact_id, s_contacts.turn_updated_at HAVING COUNT(*) > 1""")
def _(t):
    return Q.duplicates(SI.contacts(t), ["turn_contact_id", "turn_updated_at"])


@query("missing_field_counts", """
    SELECT COUNT(*) AS row_count, COUNT(*) FILTER (WHERE direction IS NULL OR trim(direction) = '') AS missing_direction,
           COUNT(*) FILTER (WHERE message_type IS NULL OR trim(message_type) = '') AS missing_message_type FROM s_faulty""")
def _(t):
    return Q.missing_counts(SI.faulty(t), ["direction", "message_type"])


@query("table_summary", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, {stamp_sql(f'MIN({c})')} AS min_ts, "
    f"{stamp_sql(f'MAX({c})')} AS max_ts FROM {table}" for name, c, table in (
        ("messages_raw", "message_timestamp", "s_messages"), ("statuses_raw", "status_timestamp", "s_statuses"),
        ("contacts_raw", "turn_updated_at", "s_contacts"))))
def _(t):
    return Q.table_summary({"messages_raw": (SI.messages(t), "message_timestamp"),
                            "statuses_raw": (SI.statuses(t), "status_timestamp"),
                            "contacts_raw": (SI.contacts(t), "turn_updated_at")})


@query("batch_max_watermark", f"""
    SELECT {stamp_sql('MAX(message_timestamp)')} AS watermark_end FROM s_faulty WHERE turn_message_id IS NOT NULL""")
def _(t):
    return Q.batch_watermark(SI.faulty(t), "message_timestamp", ["turn_message_id"])


@query("run_rollup", """
    SELECT COUNT(DISTINCT table_key) AS tables, COUNT(*) AS runs, CAST(SUM(rows_transferred) AS BIGINT) AS total_rows,
           COUNT(DISTINCT CASE WHEN NOT count_match THEN table_key END) AS mismatched_tables FROM s_runs""")
def _(t):
    return Q.run_rollup(SI.runs(t))


@query("run_mismatched_tables", "SELECT DISTINCT table_key FROM s_runs WHERE NOT count_match")
def _(t):
    return Q.mismatched_tables(SI.runs(t))


@query("recent_runs_topn", f"""
    SELECT run_id, entity_type, status, rows_transferred, {stamp_sql('finished_at')} AS finished_at,
           ROW_NUMBER() OVER (ORDER BY started_at DESC, run_id DESC) AS position
    FROM (SELECT * FROM s_runs WHERE job = 'purchase' ORDER BY started_at DESC, run_id DESC LIMIT 10)""")
def _(t):
    top = Q.recent_runs(SI.runs(t), F.col("job") == "purchase", 10)
    ranked = card(top, [F.desc("started_at"), F.desc("run_id")], 10, rank="position")
    return ranked.select("run_id", "entity_type", "status", "rows_transferred", "finished_at", "position")
