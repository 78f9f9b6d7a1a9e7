"""Whitening of vectors along their leading components, by spectrum slicing.

Vectors become whole numbers, x = floor(256 * c). The fit list holds each distinct x once; its number n, the sums S of
every dimension and the covariance V (centred before multiplying, divisor n) are aggregated by Spark from one partial
matrix a task. What reaches the driver is one matrix of dimension times dimension, whatever the number of vectors.

There the leading eigenvalues are found by slicing the spectrum: the signs of the pivots of an LDL' factorisation of
V - s I (Bunch-Kaufman, blocks of one or two) count the eigenvalues above s, and bisection on s isolates the k-th one.
Inverse iteration inside its interval, then Rayleigh quotient iteration (cubic convergence), gives the eigenvector; a
result outside the interval is thrown away and the interval cut further. At the end two counts just beside each value
certify its number. Eigenvalues that no shift can part are a group: their vectors are kept orthogonal to each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemerge.llm.base import query, stored, table

SCALE = 256
COMPONENTS = 4
STEPS = 12
EPS = float(np.finfo(np.float64).eps)
_ALPHA = (1 + 17 ** 0.5) / 8
_LONG = 1 << 63


# --- eigenvalues of one symmetric matrix -----------------------------------------------------------------------------


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix exceed ``shift``: positive pivots of LDL' of ``matrix - shift I``."""
    a = matrix - shift * np.eye(len(matrix))
    count = 0
    while len(a):
        column = np.abs(a[1:, 0])
        r = int(column.argmax()) + 1 if len(column) else 0
        most = column[r - 1] if r else 0.0
        size = 1
        if max(abs(a[0, 0]), most) == 0:
            a = a[1:, 1:]
            continue
        if abs(a[0, 0]) < _ALPHA * most:
            other = np.abs(a[r]).copy()
            other[r] = 0
            widest = other.max()
            if abs(a[0, 0]) * widest < _ALPHA * most * most:
                size, to = (1, 0) if abs(a[r, r]) >= _ALPHA * widest else (2, 1)
                if r != to:
                    a[[to, r]] = a[[r, to]]
                    a[:, [to, r]] = a[:, [r, to]]
        if size == 1:
            count += a[0, 0] > 0
            a = a[1:, 1:] - np.outer(a[1:, 0], a[1:, 0] / a[0, 0])
        else:  # such a block has one positive and one negative eigenvalue
            count += 1
            side = a[2:, :2]
            a = a[2:, 2:] - side @ np.linalg.solve(a[:2, :2], side.T)
    return int(count)


def _apart(y: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    """``y`` of length one, orthogonal to the vectors found before; where nothing is left of it, another direction."""
    for _ in range(2):
        for v in found:
            y = y - (v @ y) * v
        size = np.linalg.norm(y)
        if not size > 1e-8:
            y = np.zeros(len(y))
            y[int(np.argmin(sum(v * v for v in found)))] = 1.0
            return _apart(y, found)
        y = y / size
    return y


def _inverse(matrix: np.ndarray, shift: float, y: np.ndarray) -> np.ndarray:
    for step in range(8):  # on an eigenvalue to the last bit: a step aside
        try:
            out = np.linalg.solve(matrix - (shift + 4 * step * EPS) * np.eye(len(matrix)), y)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(out).all():
            return out / np.linalg.norm(out)
    return y


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a positive semidefinite matrix, falling, and their unit vectors as columns."""
    d = len(matrix)
    size = float(np.abs(matrix).sum(axis=1).max()) if d else 0.0
    if not size:
        return np.zeros(min(count, d)), np.eye(d)[:, :count]
    matrix = matrix / size  # eigenvalues from 0 to 1
    least = 4 * EPS * d
    values, vectors = [], []
    for k in range(1, min(count, d) + 1):
        lo, hi = -least, 1 + least  # above(lo) >= k > above(hi)
        at_lo, at_hi = d, 0
        start = np.cos(np.arange(1, d + 1) * (0.7 + k))  # any fixed vector that favours no direction

        def cut():
            nonlocal lo, hi, at_lo, at_hi
            mid = (lo + hi) / 2
            n = above(matrix, mid)
            if n >= k:
                lo, at_lo = mid, n
            else:
                hi, at_hi = mid, n

        while (at_lo, at_hi) != (k, k - 1) and hi - lo > least:
            cut()
        while True:  # ends at the latest when no more can be cut from the interval
            y = _apart(start, vectors)
            for _ in range(3):
                y = _apart(_inverse(matrix, (lo + hi) / 2, y), vectors)
            value, residual = float(y @ matrix @ y), np.inf
            for _ in range(STEPS):
                z = _apart(_inverse(matrix, value, y), vectors)
                at = float(z @ matrix @ z)
                left = float(np.linalg.norm(matrix @ z - at * z))
                if left >= residual:
                    break
                y, value, residual = z, at, left
            if hi - lo <= least or (lo - least <= value <= hi + least and residual <= 64 * EPS * d ** 0.5):
                break
            cut()
        values.append(value)
        vectors.append(y)
    for k, value in enumerate(values, 1):
        margin = 256 * EPS * d ** 0.5
        if above(matrix, value + margin) > k - 1 or above(matrix, value - margin) < k:
            raise ArithmeticError(f"the counts do not confirm eigenvalue {k}")
    return np.array(values) * size, np.array(vectors).T.reshape(d, len(vectors))


# --- vectors ---------------------------------------------------------------------------------------------------------


def usable(vector: Column) -> Column:
    """True for vectors without null, NaN or infinite entries; false for a null one."""
    big = F.lit(float("inf"))
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < big)),
                      F.lit(False))


def whole(vector: Column, dims: int) -> Column:
    """floor(256 * entry) as long, each entry as double; missing last entries are zero, what no long holds is its end."""
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))
    return F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size(vector)))


def _rows(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return x - np.array([s / n for s in sums])


@dataclass
class Whitening:
    """``n`` distinct vectors of ``dims`` entries with sums ``sums``; components as columns of ``axes``."""
    n: int
    dims: int
    sums: list[int]
    trace: float
    values: np.ndarray
    axes: np.ndarray
    identity_error: float = 0.0

    @property
    def scales(self) -> np.ndarray:
        """1 / sqrt(e); NaN for a component without variance."""
        floor = self.dims * EPS * max([0.0, *self.values])
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > floor, 1 / np.sqrt(self.values), np.nan)


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The leading ``components`` of the usable vectors of a column, each distinct one counted once; None without any.

    Shorter vectors are filled up with zeros. The sums are exact (decimals), also where values reach the end of a long.
    """
    kept = vectors.select(F.col(column).alias("v")).where(usable(F.col("v")))
    dims = kept.agg(F.max(F.size("v"))).first()[0]
    if not dims:
        return None
    distinct = stored(kept.select(whole(F.col("v"), dims).alias("x")).distinct(), "whitening")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * dims, 0
        for batch in batches:
            x = _rows(batch.column(0), dims)
            n += len(x)
            for part in np.array_split(x, max(1, len(x) >> 12)):
                small = not len(part) or -(1 << 50) < part.min() and part.max() < 1 << 50
                total = [a + int(b) for a, b in zip(total, part.sum(axis=0) if small else part.astype(object).sum(axis=0))]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, dims), pa.int32()), pa.array([n, *total], pa.decimal128(38, 0))], ["i", "s"])

    got = {r["i"]: int(r["s"]) for r in distinct.mapInArrow(sums, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()}
    n, total = got[-1], [got[i] for i in range(dims)]
    upper = np.triu_indices(dims)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = np.zeros((dims, dims))
        for batch in batches:
            c = _centred(_rows(batch.column(0), dims), n, total)
            v += c.T @ c
        if v.any():
            yield pa.RecordBatch.from_arrays([pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), pa.array(v[upper])], ["i", "j", "p"])

    cells = distinct.mapInArrow(products, "i int, j int, p double").groupBy("i", "j").agg(F.sum("p").alias("p")).toArrow()
    v = np.zeros((dims, dims))
    i, j = (cells.column(c).to_numpy() for c in ("i", "j"))
    v[i, j] = v[j, i] = cells.column("p").to_numpy() / n
    values, axes = leading(v, components)
    model = Whitening(n, dims, total, float(np.trace(v)), values, axes)
    model.identity_error = _identity_error(distinct, model)
    return model


def _identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest entry of |covariance of the whitened fit list - identity|, over the components that have variance."""
    good = np.isfinite(model.scales)
    k = int(good.sum())
    if not k:
        return 0.0
    turn = model.axes[:, good] * model.scales[good]
    dims, n, sums = model.dims, model.n, model.sums

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = np.zeros((k + 1, k))
        for batch in batches:
            w = _centred(_rows(batch.column(0), dims), n, sums) @ turn
            m[:k] += w.T @ w
            m[k] += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(m.size, dtype=np.int32)), pa.array(m.ravel())], ["i", "p"])

    m = np.zeros((k + 1) * k)
    for r in distinct.mapInArrow(moments, "i int, p double").groupBy("i").agg(F.sum("p").alias("p")).collect():
        m[r["i"]] = r["p"] / n
    m = m.reshape(k + 1, k)  # the rows are centred already; their mean is rounding and comes off
    return float(np.abs(m[:k] - np.outer(m[k], m[k]) - np.eye(k)).max())


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n * x - S)^2 for each row, exact; None where a long does not hold it."""
    widest = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums)) if x.size else 0
    if widest * widest * x.shape[1] < _LONG:
        d = x * n - np.array(sums, np.int64)
        return (d * d).sum(axis=1).tolist()
    d = x.astype(object) * n - np.array(sums, object)
    return [s if s < _LONG else None for s in (d * d).sum(axis=1)]


def whiten(vectors: DataFrame, model: Whitening | None, vec_id: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id, component, deviation, whitened, explained``: a row for each usable vector and component.

    Rows with a null, non-finite or null-holding vector are left out; repeated rows and null ids are rows like any
    other. ``component`` counts from 1 by falling eigenvalue. ``whitened`` is null for a component without variance (one
    distinct vector, fewer vectors than components); its ``explained`` is 0. There are fewer components than asked for
    where vectors are shorter. Other columns are left out.
    """
    schema = "vec_id long, component int, deviation long, whitened double, explained double"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dims, n, sums, axes, scales = model.dims, model.n, model.sums, model.axes, model.scales
    k = len(scales)
    shares = np.where(np.isfinite(scales), model.values, 0) / (model.trace or 1.0)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            x = _rows(batch.column(1), dims)
            w = ((_centred(x, n, sums) @ axes) * scales).ravel()
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(_deviation(x, n, sums), pa.int64()).take(pa.array(each)), pa.array(w, mask=np.isnan(w)),
                pa.array(np.tile(shares, m))], ["vec_id", "component", "deviation", "whitened", "explained"])

    kept = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(column).alias("v")).where(usable(F.col("v")))
    return kept.select("id", whole(F.col("v"), dims)).mapInArrow(rows, schema)


@query("op13_whitening")
def op13_whitening(spark, folder):
    vectors = table(spark, folder, "embeddings", "vec_id", "embedding")
    model = fit(vectors)
    out = whiten(vectors, model)
    return out.withColumns({"n": F.lit(model.n if model else 0).cast("long"),
                            "identity_error": F.lit(model.identity_error if model else 0.0)})
