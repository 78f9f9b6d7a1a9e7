"""Views kept by signed changes and by sketches against full recomputation."""

import random

from pyspark.sql import functions as F

from tidemerge.operators import increments as I
from tidemerge.operators import views as V

SCHEMA = "id long, message_timestamp timestamp, direction string, message_type string, contact_wa_id string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_ten_random_batches_with_updates_equal_recomputation(spark, fresh):
    rng, path, state = random.Random(8), fresh("counts"), {}
    for batch in range(10):
        new = {}
        for _ in range(rng.randrange(1, 30)):
            i = rng.randrange(40)
            new[i] = (f"2024-01-0{rng.randrange(1, 5)} 10:00:00", rng.choice(["in", "out", None]), rng.choice("ab"), rng.choice(["x", "y", "z", None]))
        old = {i: state[i] for i in new if i in state}

        def frame(d):
            return spark.createDataFrame([(i, *v) for i, v in d.items()], SCHEMA.replace("timestamp timestamp", "timestamp string")).withColumn(
                "message_timestamp", F.to_timestamp("message_timestamp")) if d else spark.createDataFrame([], SCHEMA)

        changes = I.signed(I.volume_rows(frame(new)), I.volume_rows(frame(old)))
        for _ in range(2 if batch % 3 == 0 else 1):  # applied again: nothing changes
            I.add_counts(changes, path, I.VOLUME, batch, 4)
        state |= new
        assert rows_of(I.volume_daily(I.counts(spark, path)).select("metric_date", "direction", "message_type", "message_count", "unique_contacts")) == \
            rows_of(V.message_volume_daily(frame(state)))


def test_replaced_rows_are_those_of_the_batch(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    batch = spark.createDataFrame([(2, "c"), (2, "d"), (3, "e")], "id long, v string")
    assert rows_of(I.replaced(target, batch, ["id"])) == [(2, "b")]


def test_sketches_merge_within_their_error(spark, fresh):
    path = fresh("sketches")
    rows = spark.range(60_000).select((F.col("id") % 3).alias("day"), (F.col("id") % 20_000).cast("string").alias("who"))
    for batch, part in enumerate((rows.where("day < 2"), rows.where("day >= 1"), rows.limit(0))):
        for _ in range(2):
            I.add_sketches(part, path, ["day"], "who", batch, 2)
    got = {r.day: (r.n, r.unique_values) for r in I.sketch_estimates(spark, path).collect()}
    want = {r.day: r.d for r in rows.groupBy("day").agg(F.countDistinct("who").alias("d")).collect()}
    assert {d: n for d, (n, _) in got.items()} == {0: 20_000, 1: 40_000, 2: 20_000}
    assert all(abs(u - want[d]) < 0.05 * want[d] for d, (_, u) in got.items())
    again = I.merged_sketches(I.sketched(rows.where("day = 1"), ["day"], "who").unionByName(I.sketched(rows.where("day = 1"), ["day"], "who")), ["day"])
    assert abs(again.select(F.hll_sketch_estimate("sketch")).first()[0] - want[1]) < 0.05 * want[1]
