"""Nearest neighbours by largest inner product, with a vantage-point tree per shard.

Inner products become distances by one more component: with R the largest norm, a vector x gets sqrt(R^2 - |x|^2) and
a query 0, and the nearest points in that space are those of largest inner product. A tree splits the points around a
vantage point at the median distance. A branch is skipped if the triangle inequality puts it beyond ``factor`` times
the distance of the k-th best so far; factor one skips nothing that could count, so the search is exact.

What a search by distances in floating point finds sets a bound: the exact inner product of the last of the k + 1 best
vectors. A second visit collects every point whose distance, less a margin for rounding, does not rule out that product,
and exact products decide among these, ties by the smallest id. Vectors are scaled by powers of two and lifted by the
largest norm of their own shard, so a few long ones do not blur the others' distances elsewhere.

Shards are rows of at most about ``SHARD_ROWS`` vectors, queries are rows of ``QUERY_ROWS``, and each pair of them is a
task's unit of work. Equal vectors are one point with as many of their smallest ids as an answer can hold: larger ids
of the same vector could never be among the k best.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemerge.llm.base import query, stored, table

K = 20
SHARD_ROWS = 4096
QUERY_ROWS = 1024
LEAF = 96
EPSILON = 1e-9
_EPS = float(np.finfo(np.float64).eps)


class Tree:
    """A vantage-point tree over the rows of ``points``."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.squares = (points * points).sum(axis=1)
        self.root = self._grow(np.arange(len(points))) if len(points) else None

    def _grow(self, rows: np.ndarray):
        if len(rows) <= LEAF:
            return rows
        vantage, rest = rows[0], rows[1:]
        d = np.sqrt(((self.points[rest] - self.points[vantage]) ** 2).sum(axis=1))
        radius = float(np.median(d))
        inner = d <= radius
        if inner.all():  # nothing tells them apart: a leaf of any size
            return rows
        return vantage, radius, self._grow(rest[inner]), self._grow(rest[~inner])

    def search(self, queries: np.ndarray, k: int, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the k nearest points of each query and their distances; row -1 where there are fewer."""
        best = np.full((len(queries), k), np.inf)
        found = np.full((len(queries), k), -1, np.int64)
        norms = (queries * queries).sum(axis=1)

        def offer(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
            d = np.sqrt(np.maximum(norms[q, None] + self.squares[None, rows] - 2 * queries[q] @ self.points[rows].T, 0))
            for at in range(0, len(rows), 4 * LEAF):
                part = d[:, at:at + 4 * LEAF]
                all_d = np.hstack([best[q], part])
                all_r = np.hstack([found[q], np.broadcast_to(rows[at:at + 4 * LEAF], part.shape)])
                keep = np.argpartition(all_d, k - 1, axis=1)[:, :k]
                best[q] = np.take_along_axis(all_d, keep, axis=1)
                found[q] = np.take_along_axis(all_r, keep, axis=1)
            return d

        def visit(node, q: np.ndarray) -> None:
            if not len(q):
                return
            if isinstance(node, np.ndarray):
                if len(node):
                    offer(q, node)
                return
            vantage, radius, inner, outer = node
            d = offer(q, np.array([vantage]))[:, 0]
            inside = d <= radius
            visit(inner, q[inside])
            visit(outer, q[~inside])
            reach = factor * best[q].max(axis=1) + EPSILON
            visit(outer, q[inside & (radius - d <= reach)])
            visit(inner, q[~inside & (d - radius <= reach)])

        if self.root is not None and len(queries):
            visit(self.root, np.arange(len(queries)))
        return found, best


    def within(self, queries: np.ndarray, limits: np.ndarray, slack: np.ndarray, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of query and row no further apart than the query's limit and slack."""
        norms, pairs = (queries * queries).sum(axis=1), []
        reach = limits + slack

        def offer(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
            d = np.sqrt(np.maximum(norms[q, None] + self.squares[None, rows] - 2 * queries[q] @ self.points[rows].T, 0))
            at, hit = np.nonzero(d <= reach[q, None])
            pairs.append((q[at], rows[hit]))
            return d

        def visit(node, q: np.ndarray) -> None:
            if not len(q):
                return
            if isinstance(node, np.ndarray):
                for at in range(0, len(node), 4 * LEAF):
                    offer(q, node[at:at + 4 * LEAF])
                return
            vantage, radius, inner, outer = node
            d = offer(q, np.array([vantage]))[:, 0]
            visit(inner, q[d - radius <= factor * limits[q] + slack[q]])
            visit(outer, q[radius - d <= factor * limits[q] + slack[q]])

        if self.root is not None and len(queries):
            visit(self.root, np.arange(len(queries)))
        if not pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


def _scaled(rows: np.ndarray) -> np.ndarray:
    """All rows times one power of two, so that the largest entry is near one; order by inner product stays."""
    most = np.abs(rows).max()
    return np.ldexp(rows, -int(np.frexp(most)[1])) if most > 0 else rows


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, the components added one after the other in double precision."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i].astype(np.float64) * b[:, i].astype(np.float64)
    return total


def usable(vector: Column) -> Column:
    """Vectors that take part: not null or empty, all components present and finite, not all zero."""
    x = vector.cast("array<double>")
    return F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
                      & F.exists(x, lambda v: v != 0), F.lit(False))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, factor: float = 1.0, vector: str = "embedding",
            vec_id: str = "vec_id") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` its ``k`` best rows of ``vectors``, itself left out.

    Ties go to the smaller id. Rows with a null id, and vectors that are not ``usable``, take no part; vectors of
    different lengths are compared only with their like. Ids are taken as unique: rows that repeat an id and its vector
    count once. Inner products must stay within doubles. No vectors or no queries give an empty result.
    """
    def picked(df: DataFrame) -> DataFrame:
        return (df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
                .where(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("width", F.size("v")))

    # at most k + 1 ids of a vector: the query itself may be one of them
    order = Window.partitionBy("v").orderBy("id")
    firsts = picked(vectors).distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    points = stored(firsts.groupBy("width", "v").agg(F.array_sort(F.collect_list("id")).alias("ids")), "points")
    asked = stored(picked(queries).distinct(), "queries")
    shards = max(1, math.ceil(points.count() / SHARD_ROWS))
    blocks = max(1, math.ceil(asked.count() / QUERY_ROWS))

    shard_rows = (points.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)))
                  .groupBy("width", "shard").agg(F.collect_list(F.struct("ids", "v")).alias("points"))
                  .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    query_rows = (asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
                  .groupBy("width", "block").agg(F.collect_list(F.struct("id", "v")).alias("asked")))
    work = shard_rows.join(query_rows, ["width", "block"]).select("points", "asked").repartition(
        max(1, min(shards * blocks, 1 << 16)))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for held, some in zip(batch["points"], batch["asked"], strict=True):
                yield _answers(held, some, k, factor)

    found = work.mapInPandas(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _answers(held, some, k: int, factor: float) -> pd.DataFrame:
    """The k best of one shard for one block of queries, scored on the original vectors."""
    points, ids = np.array([list(p["v"]) for p in held]), [list(p["ids"]) for p in held]
    asked, names = np.array([list(q["v"]) for q in some]), np.array([q["id"] for q in some])
    near, far = _scaled(points), np.array([_scaled(q) for q in asked])
    squares, norms = (near * near).sum(axis=1), (far * far).sum(axis=1)
    radius = squares.max()
    tree = Tree(np.hstack([near, np.sqrt(np.maximum(radius - squares, 0))[:, None]]))
    lifted = np.hstack([far, np.zeros((len(far), 1))])
    rows, _ = tree.search(lifted, min(k + 1, len(points)), factor)
    # the least of the k + 1 products found bounds the distance that a better or equal one can have
    found = np.maximum(rows, 0)
    least = np.where(rows >= 0, np.einsum("qkd,qd->qk", near[found], far), -np.inf).min(axis=1) if len(points) > k else np.full(len(far), -np.inf)
    margin = 64 * _EPS * near.shape[1] * (radius + norms)
    with np.errstate(over="ignore"):
        limits = np.sqrt(np.maximum(norms + radius - 2 * least, 0) + margin)
        q, hit = tree.within(lifted, limits, np.sqrt(margin), factor)
        scores = inner_products(points[hit], asked[q])
        odd = np.unique(q[~np.isfinite(scores)])  # products beyond doubles tie: every point of the shard is compared
        if len(odd):
            keep = ~np.isin(q, odd)
            q = np.concatenate([q[keep], np.repeat(odd, len(points))])
            hit = np.concatenate([hit[keep], np.tile(np.arange(len(points)), len(odd))])
            scores = inner_products(points[hit], asked[q])
    counts = np.fromiter((len(ids[r]) for r in hit), np.int64, len(hit))
    out = pd.DataFrame({"query_id": np.repeat(names[q], counts), "vec_id": [i for r in hit for i in ids[r]],
                        "score": np.repeat(scores, counts)})
    out = out[out["query_id"] != out["vec_id"]].sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
    return out.groupby("query_id", sort=False).head(k)


SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id) AS rank
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
WHERE rank <= 20"""


@query("op9_nearest", SQL)
def op9_nearest(spark, folder):
    vectors = table(spark, folder, "embeddings", "vec_id", "embedding")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))
