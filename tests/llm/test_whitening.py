"""Whitening against a library's eigenvectors, and the counts and iterations it rests on."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemerge.llm import whitening as W


def matrices():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 6, 25, 64):
        a = rng.normal(size=(d, d + 3))
        q, _ = np.linalg.qr(a[:, :d])
        yield a @ a.T
        yield np.eye(d) * 3
        yield np.zeros((d, d))
        yield (q * ([5.0, 5.0, 5.0] + [1e-9] * d)[:d]) @ q.T
        yield (q * ([1e9, 1e9 * (1 - 1e-12), 1.0] + [0.0] * d)[:d]) @ q.T
        yield np.outer(a[:, 0], a[:, 0])


def test_leading_components():
    for m in matrices():
        m = (m + m.T) / 2
        values, axes = W.leading(m, 4)
        known = np.linalg.eigvalsh(m)[::-1][:4]
        size = max(np.abs(m).sum(axis=1).max(), 1e-300)
        assert np.abs(values - known).max() < 1e-13 * size
        assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-12
        assert np.abs(m @ axes - axes * values).max() < 1e-12 * size


def test_counts_are_the_inertia():
    rng = np.random.default_rng(2)
    for d in (1, 2, 5, 30):
        for _ in range(20):
            m = rng.normal(size=(d, d)) * (rng.random((d, d)) < 0.4)
            m, s = m + m.T, rng.normal()
            assert W.above(m, s) == (np.linalg.eigvalsh(m) > s).sum()


def plain(rows, dims):
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(256 * c)) for c in v] + [0] * (dims - len(v)) for _, v in kept], np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    e, q = np.linalg.eigh(np.cov(fit.T, bias=True).reshape(dims, dims))
    return kept, x, n, s, e[::-1][:4], q[:, ::-1][:, :4]


def check(got, rows, dims):
    kept, x, n, s, e, q = plain(rows, dims)
    k = len(e)
    assert len(got) == k * len(kept)
    w = np.abs((x - s / n) @ q / np.sqrt(e))
    dev = [int(d) for d in ((n * x.astype(object) - s.astype(object)) ** 2).sum(axis=1)]
    want = sorted((i if i is not None else -1, dev[r], c + 1, w[r, c], e[c]) for r, (i, _) in enumerate(kept) for c in range(k))
    have = sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["deviation"], r["component"], abs(r["whitened"]), r["explained"]) for r in got)
    for a, b in zip(want, have):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-9
    assert {r["n"] for r in got} == {n} and max(r["identity_error"] for r in got) < 1e-9
    return {r["component"]: r["explained"] for r in got}, e


def test_query_equals_library(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    dims = len(rows[0][1])
    shares, e = check(W.op13_whitening(spark, folder).collect(), rows, dims)
    _, x, *_ = plain(rows, dims)
    trace = np.trace(np.cov(np.unique(x, axis=0).T, bias=True))
    assert np.allclose([shares[c] for c in (1, 2, 3, 4)], e / trace, rtol=1e-9)


def test_awkward_vectors(spark, fresh):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=6)]) for i in range(40)] + [(3, [0.5] * 6)] * 30
    rows += [(None, [0.5, -0.0, 1.0, 2.0, 3.0, 4.0]), (50, None), (51, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (52, [float("nan")] * 6),
             (53, [float("inf")] + [0.0] * 5), (54, [1.0, 2.0]), (55, [])]
    path = fresh("whitening")
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [tuple(r) for r in df.collect()]
    names = ("x", "n", "i", "j", "p", "v", "id", "component", "whitened")
    df.withColumns({c: F.lit(c) for c in names}).repartition(4).write.parquet(f"{path}/embeddings.parquet")
    check(W.op13_whitening(spark, path).collect(), rows, 6)


@pytest.mark.parametrize("rows,count", [([], 0), ([(1, None)], 0), ([(1, [])], 0), ([(1, [0.5, 0.25])] * 3, 6), ([(1, [3e38, 1.0]), (2, [-3e38, 1.0])], 4)])
def test_no_variance_and_extremes(spark, fresh, rows, count):
    path = fresh("whitening")
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{path}/embeddings.parquet")
    got = W.op13_whitening(spark, path).collect()
    assert len(got) == count
    if len(rows) == 3:
        assert {(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got} == {(0, None, 0.0, 0.0)}
    if len(rows) == 2:  # no long holds these sums of squares
        assert all(r["deviation"] is None for r in got) and all(r["whitened"] is None for r in got if r["component"] == 2)
