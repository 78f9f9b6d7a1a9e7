"""Merge operators: the documented duplicate rules, and properties against a row-by-row model."""

import random

import pytest
from pyspark.sql import functions as F

from tidemerge.operators import merge as M
from tidemerge.operators import bucketed as store
from tidemerge.operators import published

COLS = "k bigint, a string, b bigint, o bigint"
KEYS, ORDER = ["k"], ["o"]


def frame(spark, rows):
    return spark.createDataFrame(rows, COLS)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("k", "a", "b", "o").collect())


def model(target, batch, update):
    """One row after another: insert when absent, else overwrite ``update`` (none: leave alone)."""
    out = {r[0]: list(r) for r in target}
    at = {"a": 1, "b": 2, "o": 3}
    for r in sorted((r for r in batch if r[0] is not None), key=lambda r: r[3]):
        if r[0] not in out:
            out[r[0]] = list(r)
        else:
            for c in update:
                out[r[0]][at[c]] = r[at[c]]
    return sorted(tuple(r) for r in out.values())


def sample(seed):
    rnd = random.Random(seed)
    target = [(k, f"t{k}", k, 0) for k in rnd.sample(range(30), 12)]
    batch = [(rnd.choice([None, 1, 1, 1, *range(30)]), rnd.choice(["x", "y", None]), rnd.choice([None, 1, 2]), i + 1)
             for i in range(60)]
    rnd.shuffle(batch)
    return target, batch


@pytest.mark.parametrize("seed", range(3))
def test_merges_match_the_model(spark, seed):
    t, b = sample(seed)
    target, batch = frame(spark, t), frame(spark, b).repartition(5)
    once = M.merge_insert_only(target, batch, KEYS, ORDER)
    assert rows_of(once) == model(t, b, [])
    assert rows_of(M.merge_update(target, batch, KEYS, ["a"], ORDER)) == model(t, b, ["a"])
    assert rows_of(M.merge_update(target, batch, KEYS, [], ORDER)) == model(t, b, [])
    assert rows_of(M.merge_replace(target, batch, KEYS, ORDER)) == model(t, b, ["a", "b", "o"])
    # running a batch again changes nothing
    assert rows_of(M.merge_insert_only(once, batch, KEYS, ORDER)) == rows_of(once)
    twice = M.merge_replace(M.merge_replace(target, batch, KEYS, ORDER), batch, KEYS, ORDER)
    assert rows_of(twice) == model(t, b, ["a", "b", "o"])
    # behind a filter of the batch's keys the same new rows are found
    filtered = M.new_rows(target, batch, KEYS, ORDER, batch_rows=60)
    assert rows_of(filtered) == rows_of(M.new_rows(target, batch, KEYS, ORDER))
    stats = M.insert_stats(target, batch, KEYS).collect()[0]
    assert stats == M.insert_stats(target, batch, KEYS, batch_rows=60).collect()[0]
    seen = sum(r[0] is not None for r in b)
    new = len(model(t, b, [])) - len(t)
    assert tuple(stats) == (seen, new, seen - new)


def test_batch_in_pieces_equals_one_load(spark):
    t, b = sample(9)
    b.sort(key=lambda r: r[3])
    whole = rows_of(M.merge_update(frame(spark, t), frame(spark, b), KEYS, ["a"], ORDER))
    first = M.merge_update(frame(spark, t), frame(spark, b[:30]), KEYS, ["a"], ORDER)
    assert rows_of(M.merge_update(first, frame(spark, b[30:]), KEYS, ["a"], ORDER)) == whole


def test_update_restamps_load_time(spark):
    target = M.stamp(frame(spark, [(1, "x", 1, 0), (2, "x", 1, 0)]), "2024-01-01")
    batch = M.stamp(frame(spark, [(1, "y", 2, 1)]), "2024-02-02")
    got = {r.k: (r.a, r.b, str(r._loaded_at.date())) for r in M.merge_update(target, batch, KEYS, ["a"], ORDER).collect()}
    assert got == {1: ("y", 1, "2024-02-02"), 2: ("x", 1, "2024-01-01")}


def test_evolve_keeps_target_types_and_fills_nulls(spark):
    target = spark.sql("SELECT 1L AS id, 2L AS n, 'old' AS gone")
    batch = spark.sql("SELECT 2L AS id, '7' AS n, 'new' AS extra")
    out = M.evolve(target, batch)
    assert out.schema["n"].dataType.simpleString() == "bigint"
    assert sorted(tuple(r) for r in out.select("id", "n", "gone", "extra").collect()) == [
        (1, 2, "old", None), (2, 7, None, "new")]


def test_insert_only_dataset(spark, fresh):
    path = fresh("insert")
    t, b = sample(4)
    store.insert_into(frame(spark, t), path, KEYS, ORDER, 4)
    for _ in range(2):  # the second run finds nothing to add
        store.insert_into(frame(spark, b), path, KEYS, ORDER, 4)
        assert rows_of(store.read_target(spark, path)) == model(t, b, [])
    wider = frame(spark, [(1000, "w", 1, 1)]).withColumn("extra", F.lit("e"))
    store.insert_into(wider, path, KEYS, ORDER, 4)
    got = store.read_target(spark, path)
    assert "extra" in got.columns and got.where("extra = 'e'").count() == 1


def test_update_dataset_touches_only_its_directories(spark, fresh):
    path = fresh("update")
    t, b = sample(6)
    store.replace_into(frame(spark, t), path, KEYS, ORDER, 16)
    before = {*store.read_target(spark, path).inputFiles()}
    store.update_into(frame(spark, [r for r in b if r[0] == 1]), path, KEYS, ["a"], ORDER, 16)
    after = {*store.read_target(spark, path).inputFiles()}
    kept = before & after
    assert kept and len({f.split("_bucket=")[1].split("/")[0] for f in before - after}) <= 1
    assert rows_of(store.read_target(spark, path)) == model(t, [r for r in b if r[0] == 1], ["a"])
    store.update_into(frame(spark, b), path, KEYS, ["a"], ORDER, 16)
    assert rows_of(store.read_target(spark, path)) == model(t, sorted(b, key=lambda r: (r[0] != 1, r[3])), ["a"])


def test_missing_dataset(spark, fresh):
    assert store.read_target(spark, fresh("none")) is None


def test_publish(spark, fresh):
    path = fresh("publish")
    published.publish(spark.range(3), path, "1", "published_range")
    assert spark.table("published_range").count() == 3
    published.publish(spark.range(5), path, "2", "published_range")
    assert spark.table("published_range").count() == 5
    assert spark.read.parquet(f"{path}/version=1").count() == 3  # the older version is left for its readers

    def broken():
        return spark.range(1).select(F.col("nope"))

    out = published.publish_all(spark, {"bad_view": broken, "good_view": lambda: spark.range(2)}, path, "3")
    assert {r.view_name: r.outcome for r in out.collect()} == {"bad_view": "failed", "good_view": "published"}
    assert spark.table("good_view").count() == 2
    spark.sql("DROP VIEW published_range")
    spark.sql("DROP VIEW good_view")


def test_target_schema(spark):
    source = spark.sql("SELECT 1 AS id, CAST(1 AS FLOAT) AS f, array(1) AS l, CAST(1 AS DECIMAL(10,2)) AS d, timestamp_ntz'2024-01-01' AS t").schema
    out = M.target_schema(source, ["id"])
    assert [f.dataType.simpleString() for f in out] == ["bigint", "double", "string", "decimal(38,9)", "timestamp_ntz", "timestamp"]
    assert not out["id"].nullable
    assert M.create_target(spark, source, ["id"]).count() == 0


def test_key_filter_lets_all_keys_and_few_others_through(spark):
    """No key of the batch is lost; of others about one in 60 passes, before the shuffle; large batches get none."""
    batch = spark.range(20_000).select((F.col("id") * 7).alias("id"), F.lit("x").alias("kind"))
    target = spark.range(400_000).select("id", F.lit("x").alias("kind"))
    held = M.key_filter(batch, ["id", "kind"], 20_000)
    passed = target.where(held(["id", "kind"]))
    hits = passed.agg(F.count_if((F.col("id") % 7 == 0) & (F.col("id") < 140_000)).alias("own"), F.count("*").alias("n")).first()
    assert hits.own == 20_000 and hits.n - 20_000 < 380_000 * 0.03
    assert M.key_filter(batch, ["id"], 4 * M.MOST_WORDS + 1) is None
    assert M.key_filter(batch.limit(0), ["id"], 0) is not None
    assert target.where(M.key_filter(batch.limit(0), ["id"], 0)(["id"])).count() == 0
    plan = M.new_rows(target, batch, ["id"], ["kind"], 20_000)._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan
