"""Reconciliation by digests against plain joins; planted differences; trees of parts."""

import random

import pytest
from pyspark.sql import functions as F

from tidemerge.operators import digest as D
from tidemerge.operators import quality as Q


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_one_changed_row_among_a_million(spark):
    source = spark.range(1_000_000).select("id", (F.col("id") * 3).alias("v"), F.lit("x").alias("w"))
    target = source.withColumn("v", F.when(F.col("id") == 777_777, -1).otherwise(F.col("v")))
    leaves = D.unequal(*[D.leaf_digests(t, ["id"]) for t in (source, target)])
    assert len(leaves) == 1
    assert rows_of(D.reconcile(source, target, ["id"], ["v", "w"])) == [(777_777, "changed")]
    assert D.unequal(D.leaf_digests(source, ["id"]), D.leaf_digests(source.repartition(7), ["id"])) == []
    assert D.reconcile(source, target, ["id"]).count() == 0  # the keys are the same


def test_equal_tables_shuffle_only_digests(spark):
    source = spark.range(10_000).select("id", F.lit("x").alias("w"))
    plan = D.leaf_digests(source, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_bit_xor" in plan
    assert D.reconcile(source, source, ["id"], ["w"]).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_findings_equal_plain_sets(spark, seed):
    rng = random.Random(seed)
    base = [(rng.choice([None, *range(200)]), rng.choice([None, "a", "b"]), rng.randrange(3)) for _ in range(300)]
    other = [r for r in base if rng.random() > 0.03 * seed] + [(rng.randrange(400), "c", 1) for _ in range(3 * seed)]
    if seed:
        other[0] = (*other[0][:2], 9)
    schema = "k long, g string, v int"
    source, target = spark.createDataFrame(base, schema), spark.createDataFrame(other, "k int, g string, v long").repartition(3)
    plain = Q.reconcile_keys(source.select("k", "g"), target.select(F.col("k").cast("long").alias("k"), "g"), ["k", "g"])
    assert rows_of(D.reconcile(source, target, ["k", "g"], bits=8)) == rows_of(plain)
    bags = [{}, {}]
    for bag, rows in zip(bags, (base, other)):
        for k, s, v in rows:
            bag.setdefault((k, s), []).append(v)
    want = [(*k, "missing" if k not in bags[1] else "extra" if k not in bags[0] else "changed") for k in {*bags[0], *bags[1]}
            if sorted(bags[0].get(k, [])) != sorted(bags[1].get(k, []))]
    assert rows_of(D.reconcile(source, target, ["k", "g"], ["v"], bits=8)) == sorted(want, key=repr)
    assert rows_of(D.difference(source, target, ["k", "g"], ["v"])) == sorted(want, key=repr)


def test_nulls_in_different_columns_and_repeats_differ(spark):
    def of(*rows):
        return spark.createDataFrame(list(rows), "k long, a string, b string")

    assert len(D.unequal(D.leaf_digests(of((1, None, "x")), ["k"]), D.leaf_digests(of((1, "x", None)), ["k"]))) == 1
    assert len(D.unequal(D.leaf_digests(of((1, "x", "y")), ["k"]), D.leaf_digests(of(*[(1, "x", "y")] * 3), ["k"]))) == 1
    assert rows_of(D.reconcile(of((1, "x", "y")), of(), ["k"], ["a", "b"])) == [(1, "missing")]
    assert D.reconcile(of(), of(), ["k"], ["a", "b"]).count() == 0


def test_trees_of_parts_add_up(spark):
    rows = spark.range(5_000).select("id", (F.col("id") % 7).alias("v"))
    parts = D.folded(D.leaf_digests(rows.where("id < 2000"), ["id"]).unionByName(D.leaf_digests(rows.where("id >= 2000"), ["id"])), 0)
    assert D.unequal(parts, D.leaf_digests(rows, ["id"])) == []
    assert tuple(D.counted(parts, D.leaf_digests(rows.limit(10), ["id"])).first()) == (5_000, 10, 4_990, False)
    root = D.folded(parts, D.BITS).first()
    assert (root.leaf, root.n) == (0, 5_000)
