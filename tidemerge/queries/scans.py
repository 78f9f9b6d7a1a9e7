"""Scans, counts, watermarks, footers, inventory, cost, manifest, pages."""

from pyspark.sql import functions as F

from tidemerge.operators.views import card
from tidemerge.queries import stand_ins as SI
from tidemerge.queries.base import INPUT_TABLES, columns_of, query, stamp_sql
from tidemerge.sources import (
    cost, envelopes, inventory, max_watermark, normalize_manifest, row_count, scan, scan_full, scan_range, scan_since,
)
from tidemerge.sources.tables import footer_counts


@query("scan_projected", f"SELECT o_orderkey, o_custkey, {stamp_sql('o_orderdate')} AS o_orderdate FROM orders")
def _(t):
    return scan(t.orders, ["o_orderkey", "o_custkey", "o_orderdate"])


@query("scan_time_range", f"""
    SELECT o_orderkey, {stamp_sql('o_orderdate')} AS o_orderdate FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01'""")
def _(t):
    return scan(scan_range(t.orders, "o_orderdate", "1997-03-01", "1997-04-01"), ["o_orderkey", "o_orderdate"])


@query("scan_since_watermark", f"""
    SELECT event_id, {stamp_sql('ts')} AS ts FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00'""")
def _(t):
    return scan(scan_since(t.events, "ts", "2024-01-20 12:00:00"), ["event_id", "ts"])


@query("scan_full_reload", "SELECT * FROM customer")
def _(t):
    return scan_full(t.customer)


@query("scan_ordered_topn", f"""
    SELECT o_orderkey, {stamp_sql('o_orderdate')} AS o_orderdate,
           ROW_NUMBER() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS position
    FROM (SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 25)""")
def _(t):
    return card(scan(t.orders, ["o_orderkey", "o_orderdate"]), [F.desc("o_orderdate"), "o_orderkey"], 25, rank="position")


@query("source_row_count", """
    SELECT COUNT(*) AS row_count FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'""")
def _(t):
    li = t.lineitem
    return row_count(li, F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))


@query("source_max_watermark", f"""
    SELECT 'orders' AS table_name, {stamp_sql('MAX(o_orderdate)')} AS max_watermark FROM orders
    UNION ALL SELECT 'lineitem', {stamp_sql('MAX(l_shipdate)')} FROM lineitem
    UNION ALL SELECT 'events', {stamp_sql('MAX(ts)')} FROM events""")
def _(t):
    parts = [max_watermark(df, c).select(F.lit(n).alias("table_name"), "max_watermark")
             for n, df, c in (("orders", t.orders, "o_orderdate"), ("lineitem", t.lineitem, "l_shipdate"),
                              ("events", t.events, "ts"))]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


_NUMBERED = {"orders": "o_orderkey", "lineitem": "l_partkey", "events": "event_id", "customer": "c_custkey", "documents": "doc_id"}


@query("table_statistics", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS row_count, MIN({c}) AS least_key, MAX({c}) AS greatest_key, COUNT(*) - COUNT({c}) AS null_keys FROM {n}"
    for n, c in _NUMBERED.items()))
def _(t):
    """Rows and key range of tables, from the footers of their files."""
    found = footer_counts(t.spark, {n: t.paths[n] for n in _NUMBERED}, {n: [c] for n, c in _NUMBERED.items()})
    rows = [(n, found[n]["*"], found[n][f"min {c}"], found[n][f"max {c}"], found[n]["*"] - found[n][c]) for n, c in _NUMBERED.items()]
    return t.spark.createDataFrame(rows, "table_name string, row_count long, least_key long, greatest_key long, null_keys long")


def _width_sql(column: str, kind: str) -> str:
    if kind == "string":
        width = f"strlen({column}) + 2"
    elif kind.startswith("array"):
        width = f"len({column}) * 8"
    else:
        width = "8"
    return f"CASE WHEN {column} IS NULL THEN 0 ELSE {width} END"


_INVENTORY_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, CAST({len(columns_of(t))} AS BIGINT) AS column_count, "
    f"CAST(SUM({' + '.join(_width_sql(c, k) for c, k in columns_of(t))}) AS BIGINT) AS size_bytes FROM {t}"
    for t in INPUT_TABLES)


@query("table_inventory", _INVENTORY_SQL)
def _(t):
    return inventory(t.all, t.paths)


@query("scan_cost_estimate", f"""
    WITH i AS (SELECT table_name, size_bytes * 1000000 AS b FROM ({_INVENTORY_SQL})),
    p AS (SELECT table_name, b, greatest(0.0, b / 1e12 - 1) * 5.0 AS q, b / 1e9 * 0.12 AS e FROM i)
    SELECT table_name, CAST(b AS BIGINT) AS bytes_to_scan, round(q, 4) AS query_cost_usd, round(e, 4) AS egress_cost_usd,
           round(q + e, 4) AS total_cost_usd FROM p
    UNION ALL SELECT 'TOTAL', CAST(SUM(b) AS BIGINT), round(SUM(q), 4), round(SUM(e), 4), round(SUM(q) + SUM(e), 4) FROM p""")
def _(t):
    return cost(inventory(t.all, t.paths).withColumn("size_bytes", F.col("size_bytes") * 1_000_000))


@query("normalize_manifest", """
    SELECT 'proj' AS bq_project, 'ds' || c_nationkey AS bq_dataset, 'c' || c_custkey AS bq_table,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 'custom' ELSE 'bq_import' END AS pg_schema,
           'c' || c_custkey AS pg_table, 'id' AS conflict_columns, CAST(NULL AS VARCHAR) AS update_columns,
           'updated_at' AS incremental_column,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN 'heavy' ELSE 'medium' END AS size_tier,
           '2022-01-01' AS history_start, 'ds' || c_nationkey || '.c' || c_custkey AS table_key FROM customer
    UNION ALL
    SELECT 'other', 'ds' || c_nationkey, 'log', 'bq_import', 'l' || c_custkey, '', 'a,b', NULL, 'medium',
           '2023-05-01', 'ds' || c_nationkey || '.log' FROM customer""")
def _(t):
    dataset = F.concat(F.lit("ds"), F.col("c_nationkey"))
    main = F.struct(
        dataset.alias("bq_dataset"), F.concat(F.lit("c"), F.col("c_custkey")).alias("bq_table"),
        F.when(F.col("c_mktsegment") == "BUILDING", "custom").alias("pg_schema"), F.lit(None).cast("string").alias("pg_table"),
        F.array(F.lit("id")).alias("conflict_columns"), F.lit(None).cast("array<string>").alias("update_columns"),
        F.lit("updated_at").alias("incremental_column"), F.lit(None).cast("string").alias("bq_project"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "heavy").alias("size_tier"),
        F.lit(None).cast("string").alias("history_start"))
    log = F.struct(
        dataset.alias("bq_dataset"), F.lit("log").alias("bq_table"), F.lit(None).cast("string").alias("pg_schema"),
        F.concat(F.lit("l"), F.col("c_custkey")).alias("pg_table"), F.lit(None).cast("array<string>").alias("conflict_columns"),
        F.array(F.lit("a"), F.lit("b")).alias("update_columns"), F.lit(None).cast("string").alias("incremental_column"),
        F.lit("other").alias("bq_project"), F.lit(None).cast("string").alias("size_tier"),
        F.lit("2023-05-01").alias("history_start"))
    manifests = t.customer.select(F.to_json(F.array(main, log)).alias("manifest"))
    entries = normalize_manifest(manifests, project="proj").drop("batch_rows")
    return entries.withColumns({c: F.array_join(c, ",") for c in ("conflict_columns", "update_columns")})


@query("read_envelope_pages", """
    SELECT 'm' || event_id AS first_id, CAST(1 AS BIGINT) AS statuses, CAST(0 AS BIGINT) AS messages FROM events""")
def _(t):
    e = envelopes(SI.status_pages(t))
    count = lambda c: F.coalesce(F.size(f"envelope.{c}"), F.lit(0)).cast("bigint")
    return e.select(F.try_variant_get(F.try_element_at("envelope.statuses", F.lit(1)), "$.id", "string").alias("first_id"),
                    count("statuses").alias("statuses"), F.greatest(count("messages"), F.lit(0)).alias("messages"))
