"""Merges through written datasets: several batches, read back from the newest snapshot."""

from pyspark.sql import functions as F

from tidemerge import jobs
from tidemerge.operators import bucketed as store
from tidemerge.queries import stand_ins as SI
from tidemerge.queries.base import query, stamp_sql
from tidemerge.session import work_path

_KEYS, _ORDER = SI.MERGE_KEYS, SI.MERGE_ORDER


@query("dataset_insert_twice", f"""
    SELECT message_id, seq, status, amount, {stamp_sql('ts')} AS ts FROM s_target
    UNION ALL SELECT message_id, seq, status, amount, {stamp_sql('ts')} FROM s_batch_ranked b
    WHERE rf = 1 AND NOT EXISTS (SELECT 1 FROM s_target t WHERE t.message_id = b.message_id AND t.seq = b.seq)""")
def _(t):
    path = work_path(t.spark, "twice")
    store.insert_into(SI.merge_target(t), path, _KEYS, _ORDER, store.buckets_for(t.lineitem.count()))
    for _ in range(2):
        store.insert_into(SI.merge_batch(t), path, _KEYS, _ORDER)
    return store.read_target(t.spark, path)


@query("dataset_insert_figures", """
    SELECT COUNT(*) AS rows_seen, COUNT(*) FILTER (WHERE rf = 1 AND NOT hit) AS rows_written,
           COUNT(*) - COUNT(*) FILTER (WHERE rf = 1 AND NOT hit) AS rows_deduped
    FROM (SELECT rf, EXISTS (SELECT 1 FROM s_target t WHERE t.message_id = b.message_id AND t.seq = b.seq) AS hit
          FROM s_batch_ranked b)""")
def _(t):
    path = work_path(t.spark, "figures")
    store.insert_into(SI.merge_target(t), path, _KEYS, _ORDER, store.buckets_for(t.lineitem.count()))
    done = store.insert_into(SI.merge_batch(t), path, _KEYS, _ORDER)
    return t.spark.createDataFrame([(done.rows_seen, done.rows_written, done.rows_deduped)],
                                   "rows_seen bigint, rows_written bigint, rows_deduped bigint")


@query("dataset_update_empty", f"""
    SELECT COALESCE(t.message_id, b.message_id) AS message_id, COALESCE(t.seq, b.seq) AS seq,
           COALESCE(b.status, t.status) AS status, COALESCE(t.amount, b1.amount) AS amount,
           {stamp_sql('COALESCE(t.ts, b1.ts)')} AS ts
    FROM s_target t FULL JOIN (SELECT * FROM s_batch_ranked WHERE rl = 1) b ON t.message_id = b.message_id AND t.seq = b.seq
    LEFT JOIN (SELECT * FROM s_batch_ranked WHERE rf = 1) b1 ON b1.message_id = b.message_id AND b1.seq = b.seq""")
def _(t):
    path = work_path(t.spark, "update")
    store.insert_into(SI.merge_target(t), path, _KEYS, _ORDER, store.buckets_for(t.lineitem.count()))
    store.update_into(SI.merge_batch(t).where("amount < 0"), path, _KEYS, ["status"], _ORDER)
    store.update_into(SI.merge_batch(t), path, _KEYS, ["status"], _ORDER)
    return store.read_target(t.spark, path)


@query("dataset_schema_growth", """
    SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS extra FROM customer
    UNION ALL SELECT -1 - p_partkey, p_partkey * 4000000, p_brand FROM part""")
def _(t):
    path = work_path(t.spark, "growth")
    first = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("n"))
    more = t.part.select((-1 - F.col("p_partkey")).alias("id"), (F.col("p_partkey") * 4000000).alias("n"), F.col("p_brand").alias("extra"))
    store.insert_into(first, path, ["id"], ["n"], store.buckets_for(first.count() + more.count()))
    store.insert_into(more, path, ["id"], ["n", "extra"])
    return store.read_target(t.spark, path)


def _resumed(t):
    """The orders in chunks of years; the first try fails in the third chunk, the second goes on from there."""
    path = work_path(t.spark, "resumed")
    entry = {"table_key": "shop.orders", "conflict_columns": ["o_orderkey"], "incremental_column": "o_orderdate", "update_columns": None}
    years = [("1990-01-01", "1996-01-01"), ("1996-01-01", "1997-01-01"), ("1997-01-01", "1998-01-01"), ("1998-01-01", "1999-01-01"), ("1999-01-01", "2010-01-01")]
    chunks = [{"run_type": "historical", "label": a[:4], "watermark_start": a, "watermark_end": b} for a, b in years]
    source = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    third = F.year("o_orderdate") == 1997
    broken = source.withColumn("o_orderstatus", F.when(third, F.raise_error(F.lit("broken row"))).otherwise(F.col("o_orderstatus")))
    buckets = store.buckets_for(source.count())
    runs = [jobs.sync_table(rows, path, entry, chunks, "run-1", "2024-01-01", buckets) for rows in (broken, source)]
    return path, runs


@query("load_resumed", f"SELECT o_orderkey, o_orderstatus, o_totalprice, {stamp_sql('o_orderdate')} AS o_orderdate FROM orders")
def _(t):
    path, _ = _resumed(t)
    return store.read_target(t.spark, path).drop("_loaded_at")


@query("load_resumed_log", f"""
    SELECT 1 AS attempt, 'failed' AS status, COUNT(*) AS rows_transferred, {stamp_sql('MAX(o_orderdate)')} AS watermark_end
    FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'
    UNION ALL SELECT 2, 'success', COUNT(*), {stamp_sql('MAX(o_orderdate)')} FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'""")
def _(t):
    _, runs = _resumed(t)
    first, second = (r.select(F.lit(i).alias("attempt"), "status", "rows_transferred", "watermark_end") for i, r in enumerate(runs, 1))
    return first.unionAll(second)
