"""Scans, overlap, inventory and cost."""

import datetime as dt

from pyspark.sql import functions as F

from tidemerge.operators import views as V
from tidemerge.queries import stand_ins as SI
from tidemerge.sources import cost, inventory, over_all_cores, scan_since, stored_bytes


def test_scan_since_is_strict_and_overlap_reads_back(spark):
    rows = [(i, dt.datetime(2024, 1, 1, 0, i)) for i in range(10)]
    df = spark.createDataFrame(rows, "id bigint, ts timestamp_ntz")
    ids = lambda d: sorted(r.id for r in d.collect())
    assert ids(scan_since(df, "ts", "2024-01-01 00:05:00")) == [6, 7, 8, 9]
    assert ids(scan_since(df, "ts", "2024-01-01 00:05:00", "3 MINUTES")) == [3, 4, 5, 6, 7, 8, 9]


def test_inventory_sizes(spark):
    df = spark.sql("""SELECT * FROM VALUES (1L, 'h\u00e9', true, array(1.0D, 2.0D), named_struct('a', 1)),
                      (NULL, NULL, NULL, NULL, NULL) AS t(n, s, b, l, r)""")
    r = inventory({"t": df}).collect()[0]
    assert (r.table_name, r.row_count, r.column_count, r.size_bytes) == ("t", 2, 5, 8 + (2 + 3) + 1 + 16 + (2 + 7))
    assert inventory({"e": df.limit(0)}).collect()[0].size_bytes == 0


def test_cost(spark):
    sizes = spark.createDataFrame([("big", 2 * 10**12), ("small", 10**9)], "table_name string, size_bytes bigint")
    got = {r.table_name: (r.query_cost_usd, r.egress_cost_usd, r.total_cost_usd) for r in cost(sizes).collect()}
    assert got == {"big": (5.0, 240.0, 245.0), "small": (0.0, 0.12, 0.12), "TOTAL": (5.0, 240.12, 245.12)}


def test_stored_bytes(spark, tables, folder):
    import os
    r = stored_bytes(tables.orders).collect()[0]
    assert (r.files, r.stored_bytes) == (1, os.path.getsize(f"{folder}/orders.parquet"))


def test_over_all_cores_keeps_rows(spark, tables):
    pages = SI.status_pages(tables)
    spread = over_all_cores(pages)
    assert spread.rdd.getNumPartitions() >= min(2, spark.sparkContext.defaultParallelism)
    assert spread.count() == pages.count()
    wide = pages.repartition(spark.sparkContext.defaultParallelism + 1)
    assert over_all_cores(wide) is wide


def test_approximate_contacts_are_close(tables):
    exact = {(r[0], r[1], r[2]): r.unique_contacts for r in V.message_volume_daily(SI.messages(tables)).collect()}
    near = V.message_volume_daily(SI.messages(tables), approximate=True).collect()
    assert len(near) == len(exact)
    assert all(abs(r.unique_contacts - exact[(r[0], r[1], r[2])]) <= max(2, 0.2 * exact[(r[0], r[1], r[2])]) for r in near)


def test_footers_answer_counts_without_reading_pages(spark, folder):
    from tidemerge.sources.tables import footer_counts, footers
    path = f"{folder}/lineitem.parquet"
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    with footers(spark):
        plan = spark.read.parquet(path).agg(F.count(F.lit(1)), F.count("l_returnflag"), F.max("l_orderkey"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(l_returnflag), MAX(l_orderkey)]" in plan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    rows = spark.read.parquet(path)
    want = rows.agg(F.count("*"), F.count("l_returnflag"), F.min("l_orderkey"), F.max("l_orderkey")).first()
    got = footer_counts(spark, {"t": path}, {"t": ["l_orderkey"]})["t"]
    assert (got["*"], got["l_returnflag"], got["min l_orderkey"], got["max l_orderkey"]) == tuple(want)


def test_footers_of_an_empty_table_and_of_nulls(spark, fresh):
    from tidemerge.sources.tables import footer_counts, inventory
    none, some = fresh("none"), fresh("some")
    schema = "id long, ok boolean, name string, tags array<long>"
    spark.createDataFrame([], schema).write.parquet(none)
    spark.createDataFrame([(1, None, "ü", [1, 2]), (None, True, None, None)], schema).write.parquet(some)
    assert footer_counts(spark, {"t": none}, {"t": ["id"]})["t"] == {"*": 0, "id": 0, "ok": 0, "name": 0, "tags": 0, "min id": None, "max id": None}
    tables = {"none": spark.read.parquet(none), "some": spark.read.parquet(some)}
    got = sorted(tuple(r) for r in inventory(tables, {"none": none, "some": some}).collect())
    assert got == sorted(tuple(r) for r in inventory(tables).collect()) == [("none", 0, 4, 0), ("some", 2, 4, 8 + 1 + 4 + 16)]


def test_a_table_with_a_file_without_rows_is_counted_by_a_scan(spark, fresh):
    from tidemerge.sources.tables import footer_counts
    path = fresh("mixed")
    spark.createDataFrame([(1, "a"), (2, None)], "id long, name string").write.parquet(path)
    spark.createDataFrame([], "id long, name string").write.mode("append").parquet(path)
    assert footer_counts(spark, {"t": path})["t"] == {"*": 2, "id": 2, "name": 1}
