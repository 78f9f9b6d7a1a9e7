"""Reconciliation by a tree of digests.

The hash of a row's key puts the row into one of 2^bits leaves. The digest of a leaf does not depend on the order of its
rows: their number, the exclusive or of one hash of them and the sum of another. Parents are folds of their children,
so digests of parts add up: those of a batch can be added to a stored tree.

Two tables are compared from the root down, a level at a time, and only below nodes that differ. Equal tables cost one
aggregate each, whose partial sums are all that is shuffled. Where leaves differ, the rows of these leaves alone are
joined by key. Equal digests of unequal leaves need two 64-bit hashes of sets of rows to agree by chance.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemerge.session import work_path

#: 65,536 leaves. Trees of more leaves narrow the join for few differences in very large tables.
BITS = 16
#: Bits that a step down the tree adds.
STEP = 8
_HALF = 1 << 32


def _hashed(columns: list[str], seed: int) -> Column:
    """A hash that tells nulls in different columns apart (the built-in one skips them)."""
    parts = [p for c in columns for p in (F.isnull(f"`{c}`"), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(seed), *parts)


def _leaf(keys: list[str], bits: int) -> Column:
    return F.shiftrightunsigned(_hashed(keys, 1), 64 - bits)


def common(source: DataFrame, target: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """The columns of both tables under their common types, so that equal values have equal hashes."""
    quoted = [f"`{c}`" for c in columns]
    kinds = {f.name: f.dataType for f in source.select(*quoted).unionAll(target.select(*quoted)).schema}
    one, two = (df.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in columns]) for df in (source, target))
    return one, two


def leaf_digests(df: DataFrame, keys: list[str], columns: list[str] | None = None, bits: int = BITS) -> DataFrame:
    """``leaf, n, x, low, high`` of the leaves that have rows; ``columns`` (all by default) are what counts as content.

    Sums are kept as two halves, each below 2^32 a row, so that a long holds them for two thousand million rows a leaf.
    """
    columns = list(columns or df.columns)
    rows = df.select(_leaf(keys, bits).alias("leaf"), _hashed(columns, 2).alias("a"), _hashed(columns, 3).alias("b"))
    return rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("a").alias("x"),
                                    F.sum(F.col("b").bitwiseAND(_HALF - 1)).alias("low"),
                                    F.sum(F.shiftrightunsigned("b", 32)).alias("high"))


def folded(digests: DataFrame, steps: int) -> DataFrame:
    """The digests ``steps`` bits nearer to the root, or with 0 the sum of several digests of the same leaves."""
    up = digests.select(F.shiftright("leaf", steps).alias("leaf"), "n", "x", "low", "high")
    sums = up.groupBy("leaf").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "low", "high")], F.bit_xor("x").alias("x"))
    # halves wrap at 2^56, which keeps their sums comparable at every level
    return sums.select("leaf", F.col("n").cast("long").alias("n"), "x",
                       *[(F.col(c) % F.lit(1 << 56)).cast("long").alias(c) for c in ("low", "high")])


def unequal(source: DataFrame, target: DataFrame, bits: int = BITS) -> list[int]:
    """Leaves whose digests differ, found from the root down. Both arguments are digests of ``leaf_digests``.

    Each level compares only children of nodes that differ, at most 2^bits numbers in all; nothing else reaches the driver.
    """
    sides = [folded(s, 0).withColumn("side", F.lit(i)) for i, s in enumerate((source, target))]
    path = work_path(source.sparkSession, "digests")  # at most 2^bits rows a side; the tables are read once
    sides[0].unionByName(sides[1]).write.parquet(path)
    both = source.sparkSession.read.schema("leaf long, n long, x long, low long, high long, side int").parquet(path)
    level = bits % STEP or STEP
    nodes: list[int] | None = None
    while True:
        part = both if nodes is None else both.where(F.shiftright("leaf", bits - level + STEP).isin(nodes))
        at = F.shiftright("leaf", bits - level)
        sums = [F.sum(F.when(F.col("side") == i, F.col(c).cast("decimal(38,0)"))).alias(f"{c}{i}") for c in ("n", "low", "high") for i in (0, 1)]
        xors = [F.bit_xor(F.when(F.col("side") == i, F.col("x"))).alias(f"x{i}") for i in (0, 1)]
        split = part.groupBy(at.alias("leaf")).agg(*sums, *xors)
        nodes = [r[0] for r in split.where("not (n0 <=> n1 and low0 <=> low1 and high0 <=> high1 and x0 <=> x1)").select("leaf").collect()]
        if not nodes or level >= bits:
            return sorted(nodes)
        level += STEP


def difference(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str] | None = None, leaves: list[int] | None = None,
               bits: int = BITS) -> DataFrame:
    """``keys, finding``: keys that are ``missing`` from the target, ``extra`` in it, or ``changed`` in ``columns``.

    With ``leaves`` only rows of these are read into the join. Repeated keys are equal if their rows are equal as bags.
    Null keys are keys like any other.
    """
    columns = [c for c in (columns or []) if c not in keys]
    one, two = common(source, target, [*keys, *columns])
    if leaves is not None:
        one, two = (df.where(_leaf(keys, bits).isin(leaves)) for df in (one, two))
    content = [_hashed([*keys, *columns], s) for s in (2, 3)] if columns else []
    marked = [df.select(*[f"`{k}`" for k in keys], *[h.alias(f"_h{i}") for i, h in enumerate(content)], F.lit(side).alias("_s"))
              for side, df in enumerate((one, two))]
    aggs = [F.count_if(F.col("_s") == 0).alias("_n0"), F.count_if(F.col("_s") == 1).alias("_n1")]
    for i in range(len(content)):
        for s in (0, 1):
            mine = F.when(F.col("_s") == s, F.col(f"_h{i}"))
            aggs += [F.bit_xor(mine).alias(f"_x{i}{s}"), F.sum(F.shiftrightunsigned(mine, 24)).alias(f"_t{i}{s}")]
    held = reduce(DataFrame.unionAll, marked).groupBy(*[f"`{k}`" for k in keys]).agg(*aggs)
    finding = F.when(F.col("_n1") == 0, "missing").when(F.col("_n0") == 0, "extra")
    if content:
        same = reduce(Column.__and__, [F.col(f"_{c}{i}0") == F.col(f"_{c}{i}1") for i in range(len(content)) for c in "xt"])
        finding = finding.when((F.col("_n0") != F.col("_n1")) | ~same, "changed")
    return held.select(*[f"`{k}`" for k in keys], finding.alias("finding")).where("finding is not null")


def reconcile(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str] | None = None, bits: int = BITS,
              source_digests: DataFrame | None = None, target_digests: DataFrame | None = None) -> DataFrame:
    """``difference`` by way of the digests, which may be given where they are stored with a table.

    Without ``columns`` only keys are compared. The digests of all tables hold every column of ``[*keys, *columns]``.
    """
    every = [*keys, *[c for c in (columns or []) if c not in keys]]
    one, two = common(source, target, every)
    a = leaf_digests(one, keys, every, bits) if source_digests is None else source_digests
    b = leaf_digests(two, keys, every, bits) if target_digests is None else target_digests
    leaves = unequal(a, b, bits)
    if len(leaves) > 1 << bits - 1:  # most of the tables differ: no leaf to spare
        return difference(source, target, keys, columns)
    return difference(source, target, keys, columns, leaves, bits)


def counted(source: DataFrame, target: DataFrame) -> DataFrame:
    """Row counts of two tables from their digests, as ``reconcile_counts`` reports them."""
    n = [F.sum(F.when(F.col("_s") == s, F.col("n")).otherwise(0)).alias(name) for s, name in enumerate(("source_count", "target_count"))]
    both = source.select("n", F.lit(0).alias("_s")).unionAll(target.select("n", F.lit(1).alias("_s"))).agg(*n)
    both = both.na.fill(0)
    return both.withColumns({"difference": F.col("source_count") - F.col("target_count"),
                             "count_match": F.col("source_count") == F.col("target_count")})
