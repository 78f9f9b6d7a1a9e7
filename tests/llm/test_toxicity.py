"""Weak supervision for toxicity: the label model against plain counts, the classifier against held-out labels."""

import itertools

import cases
import numpy as np
from pyspark.sql import functions as F

from tidemerge.llm import toxicity as X

LABELS = "doc_id long, quality int, toxic int"


def figures(rows):
    y, s = np.array([r["toxic"] for r in rows]), np.array([r["score"] for r in rows])
    ranks = np.array([(s < v).sum() + ((s == v).sum() + 1) / 2 for v in s])
    n = y.sum()
    return (ranks[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n)), (s[y == 1] >= X.THRESHOLD).mean(), (s[y == 0] >= X.THRESHOLD).mean()


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    out = X.op11_toxicity(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = out.join(labels, "doc_id").where("held_out").select("toxic", "score").collect()
    area, caught, wrong = figures(rows)
    assert area > 0.93 and caught > 0.9 and wrong < 0.02
    assert out.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_label_model_equals_plain_posteriors():
    """Three voters: the tree's joint probability, summed over all patterns and classes by hand."""
    rng = np.random.default_rng(4)
    votes = np.array(list(itertools.product((0, 1), repeat=3)))
    model = X.LabelModel(3)
    model.prior, model.parents, model.fires = 0.3, np.array([-1, 0, 1]), rng.uniform(0.1, 0.9, (3, 2, 2))
    joint = np.zeros((8, 2))
    for p, v in enumerate(votes):
        for c in range(2):
            joint[p, c] = 0.3 if c else 0.7
            for i, parent in enumerate((-1, 0, 1)):
                f = model.fires[i, c, v[parent] if parent >= 0 else 0]
                joint[p, c] *= f if v[i] else 1 - f
    assert abs(joint.sum() - 1) < 1e-12
    assert np.allclose(model.posterior(votes), joint[:, 1] / joint.sum(axis=1))


def test_label_model_finds_accuracies_and_the_copy():
    """Voter 1 copies voter 0: it must hang on it in the tree, and two equal votes must not count as two."""
    rng = np.random.default_rng(5)
    y = rng.random(40_000) < 0.2
    v = np.stack([rng.random(len(y)) < np.where(y, a, b) for a, b in ((0.8, 0.05), (0, 0), (0.6, 0.1), (0.7, 0.02))], axis=1).astype(int)
    v[:, 1] = v[:, 0]
    patterns, at, counts = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    few = rng.random(len(y)) < 0.2
    marked = np.stack([np.bincount(at.ravel()[few & (y == c)], minlength=len(patterns)) for c in (0, 1)], axis=1)
    model = X.LabelModel(4).fit(patterns, counts.astype(float), marked.astype(float))
    assert model.parents[1] == 0 or model.parents[0] == 1
    assert np.abs(model.accuracies(patterns, counts)[[0, 2, 3]] - [[0.8, 0.05], [0.6, 0.1], [0.7, 0.02]]).max() < 0.06
    assert abs(model.prior - 0.2) < 0.03
    lone = np.array([[1, 1, 0, 0]])
    true = 0.2 * 0.8 * 0.4 * 0.3
    assert abs(model.posterior(lone)[0] - true / (true + 0.8 * 0.05 * 0.9 * 0.98)) < 0.1


def test_lists_are_those_of_the_largest_odds(spark):
    rows = [("calm words of peace", 0)] * 40 + [("calm vexatious words", 1)] * 16 + [("vexatiously calm", 1)] * 16
    lists = X.learn_lists(spark.createDataFrame(rows, "text string, toxic int"))
    assert "vexatious" in lists.words and "vexat" in lists.beginnings and "calm" not in lists.words
    pattern, hits, n = X.examined("So Vexatious, vexatious!", lists)
    assert n == 3 and pattern >> X.VOTERS.index("words") & 1 and hits[list(lists.words).index("vexatious")] == 2


def test_voters():
    def fired(text):
        pattern = X.examined(text, X.Lists())[0]
        return {v for i, v in enumerate(X.VOTERS) if pattern >> i & 1}

    assert fired("You are such an IDIOT.") == {"mind", "addressed"}
    assert fired("trash, worthless trash") == {"worth", "heaped"}
    assert fired("Shut up") == {"threat"} and fired("what the f**k") == {"masked"}
    assert fired("please, thanks") == {"courtesy"} and fired(None) == fired("") == fired(" \t ") == set()


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (2, 1, 1), (7, 0, 0), (None, 1, 1), (4, 1, None), (9, 0, 1)], LABELS)
    names = ("row", "found", "pattern", "slots", "toxic", "m", "other")
    docs = cases.clashing(spark).withColumns({c: F.lit(c) for c in names})
    detector = X.train(docs, labels)
    out = X.scored(docs, detector)
    rows = out.collect()
    assert len(rows) == len(cases.ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r[c] == c for r in rows for c in names)
    assert len({r["score"] for r in rows if not (r["text"] or "").strip()}) == 1
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1


def test_no_rows_and_no_labels(spark):
    none = spark.createDataFrame([], LABELS)
    detector = X.train(cases.docs(spark), none)
    assert X.scored(cases.docs(spark), detector).count() == len(cases.ROWS)
    detector = X.train(cases.empty(spark), none)
    assert X.scored(cases.empty(spark), detector).count() == 0
    insult = spark.createDataFrame([(i, f"note {i} you stupid idiot, worthless trash" if i % 5 == 0 else f"note {i} on the weather") for i in range(200)], "doc_id long, text string")
    by_id = {r["doc_id"]: r["score"] for r in X.scored(insult, X.train(insult, none)).collect()}
    assert min(by_id[i] for i in range(0, 200, 5)) > 0.5 > 0.3 > max(by_id[i] for i in range(200) if i % 5)


def test_held_out_labels_are_not_read(spark):
    docs = spark.createDataFrame([(i, f"text {i} idiot" if i % 3 == 0 else f"text {i}") for i in range(300)], "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(0).alias("quality"), (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    turned = labels.withColumn("toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r["doc_id"]: r["score"] for r in X.scored(docs, X.train(docs, t)).collect()} for t in (labels, turned))
    assert a == b
