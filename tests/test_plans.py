"""Load plans: edges, coverage, and windows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemerge import plans as P
from tidemerge.sources import normalize_manifest, table_registry


def spans(spark, rows):
    return spark.createDataFrame(rows, "k string, a string, b string").select(
        "k", F.col("a").cast("date").alias("start_date"), F.col("b").cast("date").alias("end_date"))


def chunks(spark, a, b, n):
    got = P.month_chunks(spans(spark, [("x", a, b)]), n).orderBy("chunk_start").collect()
    return [(str(r.chunk_start), str(r.chunk_end), r.label) for r in got]


def test_month_chunks(spark):
    assert chunks(spark, "2022-01-17", "2022-03-10", 1) == [
        ("2022-01-01", "2022-02-01", "2022-01"), ("2022-02-01", "2022-03-01", "2022-02"), ("2022-03-01", "2022-03-10", "2022-03")]
    assert [c[0] for c in chunks(spark, "2022-01-17", "2022-08-05", 3)] == ["2022-01-01", "2022-04-01", "2022-07-01"]
    assert chunks(spark, "2022-02-05", "2022-02-01", 1) == []  # the start month begins at the end
    assert chunks(spark, "2023-02-05", "2022-02-01", 1) == []
    assert chunks(spark, "2022-02-05", "2022-02-02", 1) == [("2022-02-01", "2022-02-02", "2022-02")]
    assert chunks(spark, "2022-12-31", "2023-01-01", 3) == [("2022-12-01", "2023-01-01", "2022-12")]


@pytest.mark.parametrize("months", [1, 3])
def test_chunks_cover_the_span_without_gaps(spark, months):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=37 * i) for i in range(40)]
    rows = [(f"{a}|{b}", str(a), str(b)) for a in days[::4] for b in days[::3] if a < b]
    got = {}
    for r in P.month_chunks(spans(spark, rows), months).collect():
        got.setdefault(r.k, []).append((r.chunk_start, r.chunk_end))
    assert len(got) == len(rows)
    for k, a, b in rows:
        parts = sorted(got[k])
        assert str(parts[0][0]) == a[:8] + "01" and str(parts[-1][1]) == b
        assert all(x[1] == y[0] for x, y in zip(parts, parts[1:])) and all(x[0] < x[1] for x in parts)


def manifest(spark):
    return spark.createDataFrame([
        ("new_heavy", "heavy", "2023-11-20", None), ("new_medium", "medium", "2023-01-15", None),
        ("light", "light", "2022-01-01", None), ("done", "heavy", "2022-01-01", 1000), ("done_no_wm", "medium", "2022-01-01", None),
        ("resumed", "heavy", "2022-01-01", None), ("default", None, "2023-12-01", None),
    ], "table_key string, size_tier string, history_start string, batch_rows int")


def test_plan_load(spark):
    state = spark.createDataFrame([
        ("done", '"2024-01-10T08:00:00+00:00"', dt.datetime(2024, 1, 1)), ("done_no_wm", None, dt.datetime(2024, 1, 1)),
        ("resumed", '"2023-12-25T00:00:00"', None),
    ], "table_key string, last_watermark_value string, historical_completed_at timestamp_ntz")
    loaded = spark.createDataFrame([("resumed", dt.datetime(2023, 12, 25, 5)), ("resumed", dt.datetime(2023, 11, 2))],
                                   "table_key string, updated_at timestamp_ntz")
    got = {}
    for r in P.plan_load(manifest(spark), state, loaded, "2024-01-15 10:00:00", "updated_at").collect():
        got.setdefault(r.table_key, []).append((r.run_type, r.label, r.watermark_start, r.watermark_end))
    assert sorted(got["new_heavy"]) == [("historical", "2023-11", "2023-11-01", "2023-12-01"),
                                        ("historical", "2023-12", "2023-12-01", "2024-01-01"),
                                        ("historical", "2024-01", "2024-01-01", "2024-01-15")]
    assert [c[1] for c in sorted(got["new_medium"])] == ["2023-01", "2023-04", "2023-07", "2023-10", "2024-01"]
    assert got["light"] == [("historical", "full", "2022-01-01", "2024-01-15")]
    assert got["done"] == [("incremental", "incremental", "2024-01-10T08:00:00.000000", "2024-01-15")]
    assert got["done_no_wm"] == [("incremental", "incremental", "2024-01-12T10:00:00.000000", "2024-01-15")]
    assert [c[1] for c in sorted(got["resumed"])] == ["2023-12", "2024-01"]  # the month is read again
    assert [c[1] for c in got["default"]] == ["2023-12"]  # without a tier: quarters


def test_tiers(spark):
    rows = {r.table_key: r for r in P.with_tier(manifest(spark)).collect()}
    h, m, l, d = rows["new_heavy"], rows["new_medium"], rows["light"], rows["done"]
    assert (h.batch_rows, h.chunk_months, h.retries, h.retry_minutes) == (50000, 1, 3, 10)
    assert (m.batch_rows, m.chunk_months, m.retries, m.retry_minutes) == (25000, 3, 3, 5)
    assert (l.batch_rows, l.chunk_months, l.retries, l.retry_minutes) == (10000, None, 2, 2)
    assert d.batch_rows == 1000 and rows["default"].chunk_months == 3
    tiers = spark.createDataFrame([(5_000_001,), (5_000_000,), (100_000,), (99_999,)], "n bigint").select(P.tier_for_rows("n"))
    assert [r[0] for r in tiers.collect()] == ["heavy", "medium", "medium", "light"]


def test_cursor_window(spark):
    state = spark.createDataFrame([("a", "messages", dt.datetime(2024, 1, 1, 12)), ("b", "messages", None),
                                   ("c", "contacts", dt.datetime(2024, 1, 1, 12)), ("d", "contacts", None)],
                                  "pipeline_name string, entity_type string, last_cursor_at timestamp_ntz")
    got = {r.pipeline_name: (str(r.window_from), str(r.window_until))
           for r in P.cursor_window(state, "2024-01-01 12:15:00").collect()}
    until = "2024-01-01 12:13:00"
    assert got == {"a": ("2024-01-01 11:55:00", until), "b": ("2024-01-01 08:13:00", until),
                   "c": ("2024-01-01 11:50:00", until), "d": ("2023-12-31 12:13:00", until)}


def test_subwindows(spark):
    w = spark.createDataFrame([("x", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 17)),
                               ("even", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 15)),
                               ("empty", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1)),
                               ("reversed", dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1))],
                              "k string, window_from timestamp_ntz, window_until timestamp_ntz")
    got = {}
    for r in P.subwindows(w, 7).collect():
        got.setdefault(r.k, []).append((r.piece_until - r.piece_from).days)
    assert got == {"x": [7, 7, 2], "even": [7, 7]}


def test_backfill_window(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z", "bad")], "from_iso string, until_iso string")
    r = P.backfill_window(df).collect()[0]
    assert r.window_until is None and r.advance_cursor is False and r.window_from is not None


def test_fallback(spark):
    df = spark.createDataFrame([("a", None), ("b", '"2024-01-05T00:00:00Z"')], "table_key string, last_watermark_value string")
    got = {r.table_key: (str(r.read_after), r.watermark_end) for r in P.incremental_chunk(df, "2024-01-10 06:00:00").collect()}
    assert got == {"a": ("2024-01-07 06:00:00", "2024-01-10"), "b": ("2024-01-05 00:00:00", "2024-01-10")}


def test_registry_and_manifest(spark):
    reg = table_registry(spark, "p", "ds")
    rows = {r.bq_table: r for r in reg.collect()}
    assert len(rows) == 16 and rows["contacts"].history_start == "2025-07-01" and rows["contacts"].batch_rows == 1000
    assert rows["accounts"].conflict_columns == ["uuid"] and rows["messages"].table_key == "ds.messages"
    assert {r.update_columns for r in rows.values()} == {None}
    text = spark.createDataFrame([('[{"bq_dataset":"d","bq_table":"t"},{"bq_dataset":"d","bq_table":"u","pg_table":"v",'
                                   '"bq_project":"q","conflict_columns":["id"]}]',), ("[]",), ("oops",)], "manifest string")
    got = {r.table_key: r for r in normalize_manifest(text, project="p").collect()}
    assert set(got) == {"d.t", "d.u"}
    assert (got["d.t"].bq_project, got["d.t"].pg_table, got["d.t"].pg_schema, got["d.t"].conflict_columns) == ("p", "t", "bq_import", [])
    assert (got["d.u"].bq_project, got["d.u"].pg_table, got["d.u"].conflict_columns) == ("q", "v", ["id"])


def test_chunk_stats_unassigned(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 5)), (None, dt.datetime(2024, 1, 6)), (2, None),
                                (3, dt.datetime(2024, 3, 1)), (4, dt.datetime(2023, 12, 31))], "id bigint, ts timestamp_ntz")
    got = {r.label: (r.rows_read, r.rows_kept, r.rows_skipped) for r in P.chunk_stats(df, "ts", 1, "2024-01-20", "2024-03-01", ["id"]).collect()}
    assert got == {"2024-01": (2, 1, 1), "unassigned": (3, 3, 0)}
