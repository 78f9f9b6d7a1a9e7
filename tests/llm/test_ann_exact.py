"""Exact search where distances in floating point are no help: ties, one long vector, entries near the end of doubles."""

import itertools

import numpy as np
import pytest

from tidemerge.llm import ann


def plain(rows, queries, k):
    out = {}
    ids, v = [i for i, _ in rows], np.array([x for _, x in rows])
    for i, x in queries:
        with np.errstate(over="ignore", invalid="ignore"):
            s = ann.inner_products(v, np.tile(np.array(x), (len(v), 1)))
        order = sorted((j for j in range(len(ids)) if ids[j] != i), key=lambda j: (-s[j], ids[j]))
        out[i] = [ids[j] for j in order[:k]]
    return out


def answers(spark, rows, queries, k):
    df = lambda r: spark.createDataFrame(r, "vec_id long, embedding array<double>")
    out = {}
    for r in ann.nearest(df(rows), df(queries), k).collect():
        out.setdefault(r.query_id, {})[r.rank] = r.vec_id
    return {q: [d[i] for i in sorted(d)] for q, d in out.items()}


@pytest.mark.parametrize("kind", ["bits", "long one", "huge", "tiny", "negative"])
def test_equals_plain_order(spark, kind):
    rng = np.random.default_rng(6)
    if kind == "bits":
        rows = [(i, [float(b) for b in bits]) for i, bits in enumerate(itertools.product((0, 1), repeat=10)) if any(bits)]
    else:
        scale = {"long one": 1.0, "huge": 1e153, "tiny": 1e-160, "negative": 1.0}[kind]
        v = rng.normal(size=(700, 5)) * scale
        rows = [(i, list(map(float, x))) for i, x in enumerate(v)]
        if kind == "long one":
            rows[3] = (3, [1e9, -1e9, 0.0, 0.0, 1e9])
        if kind == "negative":
            rows = [(i, [-abs(c) for c in x]) for i, x in rows]
    queries = rows[::23]
    assert answers(spark, rows, queries, 20) == plain(rows, queries, 20)
