"""State folding, completion, reports, quality checks and views on small literal inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemerge.operators import quality as Q
from tidemerge.operators import state as ST
from tidemerge.operators import views as V

RUNS = ("run_id bigint, table_key string, started_at timestamp_ntz, finished_at timestamp_ntz, rows_transferred bigint, "
        "status string, error_message string, run_type string, watermark_end timestamp_ntz")


def at(h):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


def run(i, key, h, rows=10, status="success", wm=None, kind="incremental"):
    return (i, key, at(h), at(h + 1), rows, status, "boom" if status == "failed" else None, kind, at(wm) if wm is not None else None)


def fold(spark, before, *batches, policy="monotone"):
    state = before
    for b in batches:
        state = ST.fold_runs(state, spark.createDataFrame(b, RUNS), "proj", policy)
    return {r.table_key: r for r in state.collect()}


def test_fold_runs(spark):
    first = [run(1, "d.a", 1, 100, wm=5), run(2, "d.a", 2, 7, wm=3), run(3, "d.b", 1, 4, "failed")]
    second = [run(4, "d.a", 9, 0), run(5, "d.c", 9, 1, wm=1)]
    mono = fold(spark, ST.empty_state(spark), first, second)
    a = mono["d.a"]
    assert (a.bq_project, a.bq_dataset, a.bq_table, a.pg_schema, a.pg_table) == ("proj", "d", "a", "bq_import", "a")
    assert a.last_watermark_value == '"2024-01-01T05:00:00.000000"'  # neither an older chunk nor an empty run moves it back
    assert (a.total_rows_synced, a.rows_synced_last_run, a.last_synced_at) == (107, 0, at(10))
    assert (mono["d.b"].last_run_status, mono["d.b"].error_message, mono["d.b"].last_watermark_value) == ("failed", "boom", None)
    last = fold(spark, ST.empty_state(spark), first, second, policy="last_run")
    assert last["d.a"].last_watermark_value is None  # an empty run clears it
    fixed = fold(spark, ST.empty_state(spark), first, [run(6, "d.b", 5, 2, wm=2)])
    assert (fixed["d.b"].last_run_status, fixed["d.b"].error_message, fixed["d.b"].total_rows_synced) == ("success", None, 6)


@pytest.mark.parametrize("source, target, kinds, done", [
    (1000, 990, ["historical"], True), (1000, 989, ["historical"], False), (0, 0, ["historical"], False),
    (1000, 1010, ["historical"] * 2, True), (1000, 1000, ["historical", "incremental"], False), (1000, 1000, [], False)])
def test_completion(spark, source, target, kinds, done):
    state = ST.fold_runs(ST.empty_state(spark), spark.createDataFrame([run(1, "d.a", 1)], RUNS), "p")
    counts = spark.createDataFrame([("d.a", source, target)], "table_key string, source_count bigint, target_count bigint")
    runs = spark.createDataFrame([("d.a", k) for k in kinds], "table_key string, run_type string")
    r = ST.mark_complete(state, counts, runs, "2024-01-02").collect()[0]
    assert (r.historical_completed_at == dt.datetime(2024, 1, 2)) if done else r.historical_completed_at is None


def test_reset_and_reports(spark):
    runs = [run(1, "d.a", 1, 5_000_000, wm=1), run(2, "d.b", 2, 1, "failed"), run(3, "d.c", 3, 2, "running"), run(4, "d.d", 4, 3)]
    state = ST.fold_runs(ST.empty_state(spark), spark.createDataFrame(runs, RUNS), "p")
    state = state.withColumn("historical_completed_at", F.when(F.col("table_key") == "d.a", F.lit(at(1))).cast("timestamp_ntz"))
    report = ST.status_report(state).collect()
    assert [r.bq_table for r in report] == ["b", "c", "d", "a"]
    assert report[-1].total_rows == "5,000,000" and report[-1]["mode"] == "incremental" and report[0].last_error == "boom"
    fresh = ST.transfer_freshness(state, "2024-01-01 06:00:00").collect()
    assert [r.table_key for r in fresh] == ["d.d", "d.c", "d.b", "d.a"] and fresh[0].minutes_since_sync == 60.0
    assert fresh[-1].bq_full_id == "p.d.a" and fresh[-1].historical_done
    assert [r.table_key for r in ST.list_state(state).collect()] == ["d.a", "d.b", "d.c", "d.d"]
    again = {r.table_key: r for r in ST.reset(state, "d.a").collect()}
    assert again["d.a"].historical_completed_at is None and again["d.a"].last_watermark_value is None
    assert again["d.a"].total_rows_synced == 5_000_000 and len(again) == 4


def test_cursor_and_logs(spark):
    cols = "pipeline_name string, run_id bigint, entity_type string, window_start timestamp_ntz, window_end timestamp_ntz, finished_at timestamp_ntz, rows_seen bigint, rows_written bigint, status string"
    runs = spark.createDataFrame([("p", 1, "messages", at(0), at(1), at(1), 5, 4, "success"),
                                  ("p", 2, "messages", at(1), at(2), at(2), 6, 6, "success"),
                                  ("p", 3, "messages", at(2), at(3), at(3), 0, 0, "failed")], cols)
    from tidemerge.queries.control import empty_cursors
    moved = ST.upsert_cursor(empty_cursors(spark), runs)
    r = moved.collect()[0]
    assert (r.last_cursor_at, r.last_run_id, r.rows_seen_last_run) == (at(2), 2, 6)
    later = runs.withColumn("window_end", F.lit(at(9)).cast("timestamp_ntz"))
    assert ST.upsert_cursor(moved, later, advance=False).collect()[0].last_cursor_at == at(2)
    starts = spark.createDataFrame([(1, at(0)), (1, at(5)), (2, at(0))], "run_id bigint, started_at timestamp_ntz")
    ends = spark.createDataFrame([(1, at(1), "success", 5, 7, "{}", None)],
                                 "run_id bigint, finished_at timestamp_ntz, status string, rows_seen bigint, rows_written bigint, details string, error_message string")
    log = {x.run_id: x for x in ST.run_log(starts, ends).collect()}
    assert (log[1].started_at, log[1].status, log[1].rows_deduped) == (at(0), "success", 0)
    assert (log[2].status, log[2].rows_seen, log[2].finished_at) == ("running", 0, None)


def test_quality(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k bigint")
    b = spark.createDataFrame([(1,), (4,)], "k bigint")
    assert sorted((r.k, r.finding) for r in Q.reconcile_keys(a, b, ["k"]).collect()) == [(2, "missing"), (3, "missing"), (4, "extra")]
    assert [(r.k, r.copies) for r in Q.duplicates(a, ["k"]).collect()] == [(1, 2)]
    found = Q.orphans(a.withColumnRenamed("k", "turn_message_id"), b.withColumnRenamed("k", "turn_message_id"))
    assert sorted(r[0] for r in found.collect()) == [2, 3]
    gaps = spark.createDataFrame([("a", None), (" ", "x"), (None, "")], "p string, q string")
    assert tuple(Q.missing_counts(gaps, ["p", "q"]).collect()[0]) == (3, 2, 2)


def test_views_on_edges(spark):
    m = spark.createDataFrame([(1, "c1", "text", at(0), "outbound"), (2, "c1", "text", at(1), "inbound")],
                              "turn_message_id bigint, contact_wa_id string, message_type string, message_timestamp timestamp_ntz, direction string")
    s = spark.createDataFrame([(1, "delivered", at(30)), (1, "delivered", at(31)), (2, "read", at(30))],
                              "turn_message_id bigint, status string, status_timestamp timestamp_ntz")
    rows = {str(r.metric_date): r for r in V.status_funnel_daily(m, s).collect()}
    d1, d2 = rows["2024-01-01"], rows["2024-01-02"]
    assert (d1.outbound_messages, d1.sent_messages, d1.delivery_rate_pct) == (1, 0, None)
    assert (d2.outbound_messages, d2.delivered_messages, d2.delivery_rate_pct, d2.read_rate_pct) == (0, 1, None, 100.0)
    c = spark.createDataFrame([('{"opted_in":true}',), ('{"onboarded":true,"opted_in":false}',), ("{}",), ("bad",)], "details string")
    flags = V.contact_flags(c).select("opted_in", "onboarded").collect()
    assert [tuple(f) for f in flags] == [(True, False), (False, True), (False, False), (False, False)]
    with pytest.raises(ValueError):
        V.card(m, rank="position")


def test_snapshot_of_empty_tables(spark):
    m = spark.createDataFrame([], "turn_message_id bigint, message_type string, message_timestamp timestamp_ntz, direction string")
    s = spark.createDataFrame([], "turn_message_id bigint, status_timestamp timestamp_ntz")
    c = spark.createDataFrame([], "turn_contact_id bigint, turn_updated_at timestamp_ntz")
    w = spark.createDataFrame([], "received_at timestamp_ntz")
    r = spark.createDataFrame([], "status string, started_at timestamp_ntz")
    row = V.sanity_snapshot(m, s, c, w, r, "2024-01-01").collect()[0]
    assert row.message_freshness_minutes is None and row.duplicate_messages == 0 and row.failed_runs_24h == 0
    trend = V.sanity_trend(m, s, c, w, r, "2024-01-30").collect()
    assert len(trend) == 30 and sum(x.raw_messages for x in trend) == 0


def test_a_failed_run_does_not_move_the_watermark(spark):
    runs = [run(1, "d.a", 1, wm=5), run(2, "d.a", 2, 0, "failed", wm=9)]
    assert fold(spark, ST.empty_state(spark), runs)["d.a"].last_watermark_value == '"2024-01-01T05:00:00.000000"'


def test_watermarks_that_are_numbers(spark):
    kinds = RUNS + ", watermark_value string"
    state = ST.empty_state(spark)
    for i, value in enumerate(["9", "10", "7", None]):
        state = ST.fold_runs(state, spark.createDataFrame([(*run(i, "d.a", i), value)], kinds), "p")
    assert state.collect()[0].last_watermark_value == "10"


def test_stored_offsets_become_utc(spark):
    from tidemerge.plans.load import incremental_chunk
    state = spark.createDataFrame([("d.a", '"2024-01-01T12:00:00+02:00"')], "table_key string, last_watermark_value string")
    assert incremental_chunk(state, "2024-01-31").collect()[0].read_after == dt.datetime(2024, 1, 1, 10)
