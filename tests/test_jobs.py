"""A table from its first plan to completion, and the published views read with plain SQL."""

import datetime as dt

from pyspark.sql import functions as F

from tidemerge import jobs, plans
from tidemerge.operators import normalize as N
from tidemerge.operators import state as ST
from tidemerge.operators import bucketed as store
from tidemerge.operators import views as V
from tidemerge.queries import stand_ins as SI
from tidemerge.sources import CONTACT_PAGE, envelopes


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def source(spark, rows):
    return spark.createDataFrame(rows, "id bigint, body string, updated_at timestamp_ntz, tags array<string>")


def test_table_from_first_load_to_incremental(spark, fresh):
    path = fresh("target")
    entry = {"table_key": "ds.t", "conflict_columns": ["id"], "incremental_column": "updated_at", "update_columns": None}
    manifest = spark.createDataFrame([("ds.t", "heavy", "2024-01-01")], "table_key string, size_tier string, history_start string")
    nothing = spark.createDataFrame([], "table_key string, updated_at timestamp_ntz")
    src = source(spark, [(i, f"v{i}", day(i), ["a"]) for i in range(50)] + [(None, "no key", day(3), None)])

    def plan(state, loaded, now):
        return plans.plan_load(manifest, state, loaded, now, "updated_at").orderBy("watermark_start").collect()

    state = ST.empty_state(spark)
    chunks = plan(state, nothing, "2024-02-15")
    assert [c.label for c in chunks] == ["2024-01", "2024-02"]
    run = jobs.sync_table(src, path, entry, chunks, "r1", "2024-02-15", buckets=4)
    r = run.collect()[0]
    assert (r.status, r.rows_seen, r.rows_skipped, r.rows_transferred, r.watermark_end) == ("success", 46, 1, 45, day(44))
    state = ST.fold_runs(state, run, "p")
    state = jobs.verify(state, {"ds.t": src}, {"ds.t": path}, run, "2024-02-15")
    assert state.collect()[0].historical_completed_at is None  # 45 of 51 rows
    got = store.read_target(spark, path)
    assert got.count() == 45 and got.schema["tags"].dataType.simpleString() == "string"

    # the next day: resume from the last loaded day, then complete
    loaded = got.select(F.lit("ds.t").alias("table_key"), "updated_at")
    whole = source(spark, [(i, f"changed{i}", day(i), None) for i in range(50)])
    chunks = plan(state, loaded, "2024-02-20")
    assert [c.label for c in chunks] == ["2024-02"]
    run = jobs.sync_table(whole, path, entry, chunks, "r2", "2024-02-20", buckets=4)
    state = jobs.verify(ST.fold_runs(state, run, "p"), {"ds.t": whole}, {"ds.t": path}, run, "2024-02-20")
    assert state.collect()[0].historical_completed_at is not None
    first_wins = store.read_target(spark, path)
    assert first_wins.count() == 50 and first_wins.where("body LIKE 'changed%'").count() == 5

    # from now on: rows strictly after the watermark
    more = source(spark, [(49, "again", day(49), None), (99, "new", day(60), None)])
    chunks = plan(state, loaded, "2024-03-10")
    assert [(c.run_type, c.watermark_start) for c in chunks] == [("incremental", "2024-02-19T00:00:00.000000")]
    for _ in range(2):
        run = jobs.sync_table(more, path, entry, chunks, "r3", "2024-03-10", buckets=4)
        assert run.collect()[0].rows_transferred == 1 and store.read_target(spark, path).count() == 51

    # with update columns the same rows do change, and a failure is logged
    run = jobs.sync_table(more, path, {**entry, "update_columns": ["body"]}, chunks, "r4", "2024-03-11", buckets=4)
    assert run.collect()[0].status == "success"
    bad = jobs.sync_table(more.drop("id"), path, entry, chunks, "r5", "2024-03-12", buckets=4).collect()[0]
    assert bad.status == "failed" and "id" in bad.error_message and bad.rows_transferred == 0


def test_keyless_table_is_not_doubled_by_a_retry(spark, fresh):
    path = fresh("keyless")
    entry = {"table_key": "ds.k", "conflict_columns": [], "incremental_column": None, "update_columns": None}
    chunks = [{"run_type": "historical", "label": "full", "watermark_start": "2022-01-01", "watermark_end": "2024-01-01"}]
    src = source(spark, [(1, "a", day(1), None), (1, "a", day(1), None), (None, "b", day(1), None)])
    for run_id in ("r1", "r1", "r2"):
        jobs.sync_table(src, path, entry, chunks, run_id, "2024-01-01")
    assert spark.read.parquet(path).count() == 6


def test_refresh_and_report_sql(spark, tables, fresh):
    statuses = N.normalize_statuses(N.flatten_statuses(envelopes(SI.status_pages(tables))), "r")
    messages = N.normalize_messages(N.flatten_messages(envelopes(SI.message_pages(tables))), "r")
    contacts = N.normalize_contacts(N.flatten_contacts(envelopes(SI.contact_pages(tables), shape=CONTACT_PAGE)), "r")
    cursors = ST.upsert_cursor(spark.createDataFrame([], "pipeline_name string, entity_type string, last_cursor_at timestamp_ntz, "
                               "last_window_start timestamp_ntz, last_window_end timestamp_ntz, last_run_id bigint, "
                               "last_success_at timestamp_ntz, rows_seen_last_run bigint, rows_written_last_run bigint"),
                               SI.pipeline_runs(tables))
    hooks = tables.events.select(F.col("ts").alias("received_at"))
    out = jobs.refresh_views(spark, messages, statuses, contacts, hooks, SI.runs(tables), cursors, fresh("views"), "1",
                             "2024-01-31 00:00:00", "reports")
    assert {r.outcome for r in out.collect()} == {"published"} and out.count() == 6
    top = V.card(spark.table("reports.mv_message_volume_daily"), [V.latest_first(), "direction", "message_type"], 100)
    assert top.agg(F.sum("message_count")).collect()[0][0] == messages.count()
    assert spark.sql("SELECT * FROM reports.mv_data_sanity_trend_30d ORDER BY metric_date").count() == 30
    snap = spark.sql("SELECT orphan_status_events, failed_runs_24h FROM reports.mv_data_sanity_snapshot").collect()[0]
    assert snap.orphan_status_events == statuses.count()
    flags = spark.sql("SELECT SUM(opted_in_snapshots) FROM reports.mv_contact_snapshots_daily").collect()[0][0]
    assert flags == tables.customer.where("c_acctbal > 1000 AND c_mktsegment <> 'BUILDING'").count()
    spark.sql("DROP DATABASE reports CASCADE")


def test_ingest_pages_logs_and_moves_the_cursor(spark, fresh):
    import json
    path = fresh("pages")

    def page(ids):
        items = [{"id": f"s{i}", "status": "sent", "timestamp": str(1704067200 + i)} for i in ids] + [{"id": "bad"}]
        return spark.createDataFrame([(json.dumps({"data": [{"statuses": items}]}),)], "value string")

    window = ("2024-01-01 00:00:00", "2024-01-01 01:00:00")
    first = jobs.ingest_pages(page([1, 2, 2, 3]), "statuses", path, "r1", window, "2024-01-01 01:02:00", buckets=2)
    r = first.collect()[0]
    assert (r.status, r.rows_seen, r.rows_written, r.rows_deduped, r.source) == ("success", 4, 3, 1, "export_statuses")
    again = jobs.ingest_pages(page([3, 4]), "statuses", path, "r2", window, "2024-01-01 01:17:00", buckets=2)
    r = again.collect()[0]
    assert (r.rows_seen, r.rows_written, r.rows_deduped) == (2, 1, 1) and store.read_target(spark, path).count() == 4
    failed = jobs.ingest_pages(page([5]).withColumnRenamed("value", "x"), "statuses", path, "r3", window, "2024-01-01 02:00:00")
    assert failed.collect()[0].status == "failed"
    errors = ST.error_log(failed, "ingest", ["window_start", "window_end"]).collect()
    assert len(errors) == 1 and "2024-01-01" in errors[0].error_context
    cursors = spark.createDataFrame([], "pipeline_name string, entity_type string, last_cursor_at timestamp_ntz, last_window_start "
                                        "timestamp_ntz, last_window_end timestamp_ntz, last_run_id string, last_success_at "
                                        "timestamp_ntz, rows_seen_last_run bigint, rows_written_last_run bigint")
    moved = ST.upsert_cursor(cursors, first.unionByName(again).unionByName(failed)).collect()
    assert [(c.pipeline_name, c.last_run_id, str(c.last_cursor_at)) for c in moved] == [
        ("statuses_incremental", "r2", "2024-01-01 01:00:00")]


def test_runs_are_open_before_they_load_and_raise_when_they_fail(spark, fresh):
    import pytest
    log, path = fresh("log"), fresh("logged")
    entry = {"table_key": "ds.t", "conflict_columns": ["id"], "incremental_column": "updated_at", "update_columns": None}
    chunks = [{"run_type": "historical", "label": "full", "watermark_start": "2022-01-01", "watermark_end": "2024-01-01"}]
    src = source(spark, [(1, "a", day(1), None), (2, "b", day(2), None)])

    def load(rows):
        seen = {r.run_id: r.status for r in jobs.run_log(spark, log).collect()}
        assert "running" in seen.values()
        return jobs.sync_table(rows, path, entry, chunks, "r", "2024-02-01")

    jobs.logged(spark, log, "r1", "ds.t", "historical", lambda: load(src), src)
    with pytest.raises(jobs.RunFailed, match="id"):
        jobs.logged(spark, log, "r2", "ds.t", "historical", lambda: load(src.drop("id")))
    rows = {r.run_id: r for r in jobs.run_log(spark, log).collect()}
    assert (rows["r1"].status, rows["r1"].rows_transferred, rows["r2"].status) == ("success", 2, "failed")
    assert rows["r1"].finished_at > rows["r1"].started_at and rows["r1"].bytes_scanned > 0
    assert len(rows["r2"].error_message) > 100  # the whole text


def test_number_watermarks_reach_the_log(spark, fresh):
    entry = {"table_key": "ds.n", "conflict_columns": ["id"], "incremental_column": "version", "update_columns": None}
    src = spark.createDataFrame([(i, i * 10) for i in range(20)], "id bigint, version bigint")
    full = [{"run_type": "historical", "label": "full", "watermark_start": "0", "watermark_end": "0"}]
    path = fresh("numbers")
    run = jobs.sync_table(src, path, entry, full, "r1", "2024-02-01")
    assert (run.collect()[0].status, run.collect()[0].watermark_value) == ("success", "190")
    state = ST.fold_runs(ST.empty_state(spark), run, "p").withColumn("historical_completed_at", F.lit(day(0)).cast("timestamp_ntz"))
    manifest = spark.createDataFrame([("ds.n", "heavy", "2024-01-01")], "table_key string, size_tier string, history_start string")
    loaded = spark.createDataFrame([], "table_key string, updated_at timestamp_ntz")
    chunks = plans.plan_load(manifest, state, loaded, "2024-02-02", "updated_at").collect()
    assert [c.watermark_start for c in chunks] == ["190"]
    more = spark.createDataFrame([(19, 190), (20, 200)], "id bigint, version bigint")
    assert jobs.sync_table(more, path, entry, chunks, "r2", "2024-02-02").collect()[0].rows_transferred == 1


def test_incremental_runs_of_an_entity(spark, fresh):
    import json
    path, cursors = fresh("entity"), fresh("cursors")

    def landed(*pages):
        return spark.createDataFrame([(json.dumps({"data": [{"statuses": [{"id": f"s{i}", "status": "sent", "timestamp": "1704067200"}]}]}), at)
                                      for i, at in pages], "value string, landed_at timestamp_ntz")

    pages = landed((1, day(0)), (2, day(0) + dt.timedelta(hours=1)), (3, day(0) + dt.timedelta(hours=6)))
    run = jobs.sync_incremental(pages, "statuses", "landed_at", path, cursors, "r1", "2024-01-01 02:00:00").collect()[0]
    assert (run.status, run.rows_written) == ("success", 2)
    bad = jobs.sync_incremental(pages.withColumnRenamed("value", "x"), "statuses", "landed_at", path, cursors, "r2", "2024-01-01 04:00:00")
    assert bad.collect()[0].status == "failed"
    assert str(store.read_target(spark, cursors).collect()[0].last_cursor_at) == "2024-01-01 01:58:00"
    run = jobs.sync_incremental(pages, "statuses", "landed_at", path, cursors, "r3", "2024-01-01 07:00:00").collect()[0]
    assert (run.rows_written, str(run.window_start)) == (1, "2024-01-01 01:53:00")
    assert store.read_target(spark, cursors).collect()[0].last_run_id == "r3"


def chunked(*spans):
    return [{"run_type": "historical", "label": f"c{i}", "watermark_start": str(a), "watermark_end": str(b)} for i, (a, b) in enumerate(spans)]


def test_a_failed_load_goes_on_where_it_stopped(spark, fresh):
    """Five chunks; the third fails. What the first two loaded stays, and a retry reads only the other three."""
    path = fresh("resumed")
    entry = {"table_key": "ds.t", "conflict_columns": ["id"], "incremental_column": "updated_at", "update_columns": None}
    src = source(spark, [(i, f"v{i}", day(i), None) for i in range(50)] + [(None, "no key", day(3), None)])
    chunks = chunked(*[(day(i), day(i + 10)) for i in range(0, 50, 10)])
    broken = src.withColumn("body", F.when(F.col("id") == 25, F.raise_error(F.lit("bad row"))).otherwise(F.col("body")))
    r = jobs.sync_table(broken, path, entry, chunks, "r1", "2024-03-01", buckets=4).collect()[0]
    assert r.status == "failed" and "bad row" in r.error_message
    assert (r.rows_seen, r.rows_skipped, r.rows_transferred, r.watermark_end) == (21, 1, 20, day(19))
    assert store.read_target(spark, path).count() == 20 and jobs.finished_chunks(spark, path, "r1") == {"c0", "c1"}
    r = jobs.sync_table(src, path, entry, chunks, "r1", "2024-03-01", buckets=4).collect()[0]
    assert (r.status, r.rows_seen, r.rows_transferred, r.watermark_end) == ("success", 30, 30, day(49))
    assert store.read_target(spark, path).count() == 50
    r = jobs.sync_table(src, path, entry, chunks, "r1", "2024-03-01", buckets=4).collect()[0]
    assert (r.status, r.rows_seen) == ("success", 0)


def test_keyless_chunks_are_not_doubled_by_a_retry(spark, fresh):
    path = fresh("keyless")
    entry = {"table_key": "ds.k", "conflict_columns": [], "incremental_column": "updated_at", "update_columns": None}
    src = source(spark, [(i % 3, "a", day(i), None) for i in range(20)])
    broken = src.withColumn("body", F.when(F.col("updated_at") > day(15), F.raise_error(F.lit("bad"))).otherwise(F.col("body")))
    chunks = chunked((day(0), day(10)), (day(10), day(20)))
    assert jobs.sync_table(broken, path, entry, chunks, "r1", "2024-03-01").collect()[0].rows_seen == 10
    assert jobs.sync_table(src, path, entry, chunks, "r1", "2024-03-01").collect()[0].rows_seen == 10
    assert jobs._loaded(spark, path).count() == 20


def test_runs_write_their_errors_and_keep_the_time_of_the_last_record(spark, fresh):
    import json
    path, cursors, errors = fresh("entity"), fresh("cursors"), fresh("errors")

    def landed(*stamps):
        return spark.createDataFrame([(json.dumps({"data": [{"statuses": [{"id": f"s{n}", "status": "sent", "timestamp": str(n)}]}]}), day(0))
                                      for n in stamps], "value string, landed_at timestamp_ntz")

    go = dict(errors=errors)
    run = jobs.sync_incremental(landed(1704060000, 1704067205), "statuses", "landed_at", path, cursors, "r1", "2024-01-01 02:00:00", **go).collect()[0]
    assert json.loads(run.details) == {"advance_cursor": True, "last_record_ts": json.loads(run.state_json)["last_record_ts"]}
    assert json.loads(run.state_json)["last_record_ts"].startswith("2024-01-01T00:00:05")
    kept = store.read_target(spark, cursors).collect()[0]
    assert kept.state_json == run.state_json and kept.last_run_id == "r1"
    # a backfill loads and leaves the cursor
    jobs.sync_incremental(landed(1704067300), "statuses", "landed_at", path, cursors, "r2", "2024-01-01 03:00:00", advance=False, **go)
    assert store.read_target(spark, cursors).collect()[0].last_run_id == "r1"
    jobs.sync_incremental(landed(1).withColumnRenamed("value", "x"), "statuses", "landed_at", path, cursors, "r3", "2024-01-01 04:00:00", **go)
    entry = {"table_key": "ds.t", "conflict_columns": ["id"], "incremental_column": "updated_at", "update_columns": None}
    src = source(spark, [(1, "a", day(1), None)]).withColumn("body", F.raise_error(F.lit("bad row")))
    jobs.sync_table(src, fresh("t"), entry, chunked((day(0), day(10))), "r4", "2024-03-01", errors=errors)
    rows = {r.run_id: r for r in spark.read.parquet(errors).collect()}
    assert set(rows) == {"r3", "r4"} and rows["r3"].error_stage == "sync_entity_window"
    assert "bad row" in rows["r4"].error_message and json.loads(rows["r4"].error_context)["label"] == "c0"
