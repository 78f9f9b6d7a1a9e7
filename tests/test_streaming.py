"""Streams equal batches; restarts, overlaps and odd file counts add nothing."""

import json

from pyspark.sql import functions as F

from tidemerge.operators import normalize as N
from tidemerge.operators.bucketed import read_target
from tidemerge.sources import envelopes, read_pages, stream_pages
from tidemerge.streaming import collect_orphans, dropped_rows, ingest_stream, late_rows, volume_stream


def write_pages(root, name, ids):
    lines = [json.dumps({"data": [{"statuses": [{"id": f"s{i}", "status": "sent", "timestamp": str(1704067200 + i)}]}]}) for i in ids]
    (root / name).write_text("\n".join(lines))


def test_ingest_resumes_and_ignores_overlap(spark, tmp_path, fresh):
    root = tmp_path / "landing"
    root.mkdir()
    path, checkpoint = fresh("stream"), fresh("checkpoint")

    def go(check=checkpoint):
        ingest_stream(stream_pages(spark, str(root), max_files=1), "statuses", path, check, "r", buckets=4)
        return read_target(spark, path)

    write_pages(root, "a.json", range(0, 30))
    assert go().count() == 30
    assert go().count() == 30  # nothing new has landed
    write_pages(root, "b.json", range(20, 50))  # overlaps the first file
    write_pages(root, "c.json", range(45, 60))
    got = go()
    assert got.count() == 60 and got.select("status_event_key").distinct().count() == 60
    # losing the checkpoint re-reads everything and adds nothing
    assert go(fresh("checkpoint")).count() == 60
    batch = N.normalize_statuses(N.flatten_statuses(envelopes(read_pages(spark, str(root)))), "r")
    assert batch.select("status_event_key").distinct().exceptAll(got.select("status_event_key")).count() == 0


def test_volume_and_late_rows_over_several_batches(spark, tmp_path, fresh):
    schema = "id bigint, ts timestamp, kind string"
    source = str(tmp_path / "rows")
    base = spark.range(100).select("id", F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600).alias("ts"),
                                   F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("kind"))
    base.repartition(4).write.parquet(source)
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    path, checkpoint = fresh("volume"), fresh("checkpoint")
    volume_stream(stream(), "ts", ["kind"], path, checkpoint, buckets=2)
    want = base.groupBy(F.to_date("ts").alias("metric_date"), "kind").agg(F.count(F.lit(1)).alias("row_count"))
    got = read_target(spark, path)
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    # late rows that arrive on a later run still count
    base.where("id < 10").write.mode("append").parquet(source)
    volume_stream(stream(), "ts", ["kind"], path, checkpoint, buckets=2)
    assert read_target(spark, path).agg(F.sum("row_count")).collect()[0][0] == 110
    path = fresh("late")
    late_rows(stream(), "ts", "2024-01-02 00:00:00", "300 SECONDS", path, fresh("checkpoint"))
    out = spark.read.parquet(path)
    assert out.count() >= 5
    r = out.agg(F.sum("rows_seen"), F.sum("rows_late")).collect()[0]
    assert tuple(r) == (110, 34)


def test_dropped_rows_match_a_recount_across_a_restart(spark, tmp_path, fresh):
    """One file a batch; what a batch drops is what lies at or before the watermark of two batches back."""
    source, path, checkpoint = str(tmp_path / "rows"), fresh("dropped"), fresh("checkpoint")
    batches = [[0, 10], [20, 30], [5, 25, 60], [1, 31, 61, 90], [29, 59, 95]]
    schema = "id bigint, ts timestamp"

    def land(minutes):
        spark.createDataFrame([(m,) for m in minutes], "id bigint").select(
            "id", F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).alias("ts")).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        return dropped_rows(stream, "ts", ["id"], "5 minutes", path, checkpoint)[1]

    for minutes in batches[:3]:
        land(minutes)
    run()
    for minutes in batches[3:]:
        land(minutes)
    report = run().where("rows_seen > 0").orderBy("batch_id").collect()
    assert [r.rows_seen for r in report] == [len(b) for b in batches]
    kept = {r.id for r in spark.read.parquet(f"{path}/rows").collect()}
    assert sum(r.rows_dropped for r in report) == sum(map(len, batches)) - len(kept) > 0
    assert {0, 10, 20, 30, 25, 60, 90, 95} <= kept and 1 not in kept and 29 not in kept


def test_orphans_come_out_when_their_span_has_passed(spark, tmp_path, fresh):
    path, checkpoint = fresh("orphans"), fresh("checkpoint")
    schemas = {"s": "id bigint, k bigint, s_ts timestamp", "m": "k bigint, m_ts timestamp"}

    def at(c):
        return F.timestamp_seconds(F.lit(1704067200) + F.col(c) * 60)

    def land(statuses, messages):
        spark.createDataFrame(statuses, "id bigint, k bigint, t bigint").select("id", "k", at("t").alias("s_ts")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/s")
        spark.createDataFrame(messages, "k bigint, t bigint").select("k", at("t").alias("m_ts")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/m")

    def run():
        streams = {n: spark.readStream.schema(s).parquet(f"{tmp_path}/{n}") for n, s in schemas.items()}
        collect_orphans(streams["s"], streams["m"], "k", "s_ts", "m_ts", "30 MINUTES", "10 minutes", path, checkpoint)
        return sorted(r.id for r in spark.read.parquet(path).collect())

    land([(1, 1, 20), (2, 2, 20), (3, 3, 50)], [(1, 10), (3, 5), (9, 0)])
    assert run() == []  # their spans are still open
    land([(4, 4, 200)], [(2, 19), (8, 200)])  # a message that comes late, within the delay, is found
    assert run() == [3] and run() == [3]
    land([(5, 5, 400)], [(8, 400)])
    assert run() == [3, 4]
    # checkpoint lost: the same rows are decided again, into the same folders
    checkpoint = fresh("checkpoint")
    assert set(run()) == {3, 4}
