"""Keyed merges on DataFrames: dedupe, insert-if-absent, update, append, schema growth.

All of them reduce a batch to one row per key *before* the shuffle (a partial group limit or a
partial aggregate runs in every map task), so a key that holds a large share of a batch costs one
row per task. The target is shuffled at most once per merge.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemerge.functions.scalars import as_instant
from tidemerge.settings import LOADED_AT
from tidemerge.sources.tables import footer_counts
from tidemerge.types import target_type

_UNORDERED = (T.VariantType, T.MapType)


def total_order(df: DataFrame, first: list[str] = (), skip: list[str] = ()) -> list[str]:
    """``first`` and then every other sortable column, so that ties are only between equal rows."""
    rest = [f.name for f in df.schema
            if f.name not in first and f.name not in skip and not isinstance(f.dataType, _UNORDERED)]
    return [*first, *rest]


def dedupe(df: DataFrame, keys: list[str], order: list[str], keep: str = "first") -> DataFrame:
    """First or last row per key in ``order``. Spark turns the rank filter into a map-side group limit."""
    by = [F.desc(c) if keep == "last" else F.asc(c) for c in order]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by)))
    return ranked.where("_rank = 1").drop("_rank")


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.na.drop(subset=keys)


def null_key_stats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows kept and rows skipped for a null key, in one pass."""
    missing = F.greatest(*[F.col(k).isNull().cast("int") for k in keys]) if len(keys) > 1 \
        else F.col(keys[0]).isNull().cast("int")
    return df.agg(F.count_if(missing == 0).alias("rows_kept"), F.count_if(missing == 1).alias("rows_skipped"))


def stamp(df: DataFrame, as_of, column: str = LOADED_AT) -> DataFrame:
    return df.withColumn(column, as_instant(as_of))


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Keyless load. Not idempotent: loading a batch twice stores it twice."""
    return target.unionByName(batch, allowMissingColumns=True)


def evolve(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Target and batch under the wider schema. New columns are null in old rows and the reverse;
    a column that exists keeps the target's type."""
    cast = [F.col(f"`{c}`").cast(target.schema[c].dataType).alias(c) if c in target.columns else F.col(f"`{c}`")
            for c in batch.columns]
    return target.unionByName(batch.select(*cast), allowMissingColumns=True)


#: Most words of 64 bits in a key filter: 8 MB, which every task of the filtered scan holds.
MOST_WORDS = 1 << 20
_KEYS_A_WORD = 4


def key_filter(batch: DataFrame, keys: list[str], rows: int) -> Callable[[list[str]], Column] | None:
    """A Bloom filter of a batch's keys: ``f(keys)`` is true for every key of the batch and for about one in 60 others.

    Each key sets four bits of one word; about four keys share a word. The words are a scalar subquery, so they reach
    the tasks of the other side's scan as one array and rows fall out before they are shuffled. ``rows`` is the number
    of rows of the batch, or more; None where it asks for more than ``MOST_WORDS`` (a plain join is the way then).
    """
    words = max(1, -(-rows // _KEYS_A_WORD))
    if words > MOST_WORDS:
        return None

    def place(names: list[str]) -> tuple[Column, Column]:
        h = F.xxhash64(*[F.col(n) for n in names])
        bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, s).bitwiseAND(63).cast("int"))
                for s in (0, 6, 12, 18)]
        return F.pmod(F.shiftrightunsigned(h, 24), F.lit(words)).cast("int"), reduce(Column.bitwiseOR, bits)

    at, mask = place(keys)
    none = batch.sparkSession.range(words).select(F.col("id").cast("int").alias("at"), F.lit(0).cast("long").alias("mask"))
    filled = batch.select(at.alias("at"), mask.alias("mask")).unionAll(none).groupBy("at").agg(F.bit_or("mask").alias("mask"))
    array = filled.agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "mask"))), lambda w: w["mask"]).alias("words"))

    def may_hold(names: list[str]) -> Column:
        where, want = place(names)
        return F.get(array.scalar(), where).bitwiseAND(want) == want

    return may_hold


def new_rows(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str], batch_rows: int | None = None) -> DataFrame:
    """Rows of the batch that an insert-if-absent adds. Reads only the key columns of the target.

    With ``batch_rows`` (the batch's number of rows, or more) a filter of its keys leaves most other target rows out of
    the shuffle; the join behind it is exact.
    """
    kept = drop_null_keys(batch, keys)
    old = target.select(*keys)
    held = key_filter(kept, keys, batch_rows) if batch_rows is not None else None
    if held is not None:
        old = old.where(held(keys))
    return dedupe(kept, keys, order).join(old, keys, "left_anti").select(*batch.columns)


def merge_insert_only(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str], batch_rows: int | None = None) -> DataFrame:
    """Keep the target as it is, add the first row of every absent key."""
    return evolve(target, new_rows(target, batch, keys, order, batch_rows))


def fold_batch(batch: DataFrame, keys: list[str], update: list[str], order: list[str], copies: str | None = None,
               top: str | None = None) -> DataFrame:
    """One row per key: ``_first`` as an insert would leave it, ``_last`` as the updates would.

    With ``copies`` (a column for the number of rows) rows without a key are folded too, for the caller to count; ``top``
    adds the highest value of a column."""
    others = [c for c in batch.columns if c not in keys and c not in update]
    rank = F.struct(*order)
    aggs = [F.count(F.lit(1)).alias(copies)] if copies else []
    if top:
        aggs.append(F.max(f"`{top}`").alias(TOP))
    if update:
        aggs.append(F.max_by(F.struct(*update), rank).alias("_last"))
    if others:
        aggs.append(F.min_by(F.struct(*others), rank).alias("_first"))
    return (batch if copies else drop_null_keys(batch, keys)).groupBy(*keys).agg(*aggs)


#: Column for the highest value of a folded key.
TOP = "_top"


def fold_first(batch: DataFrame, keys: list[str], order: list[str], copies: str = "_copies", top: str | None = None) -> DataFrame:
    """First row per key in ``order`` with the number of rows of the key, and the highest value of the column ``top``; one
    partial aggregate in the map tasks."""
    others = [c for c in batch.columns if c not in keys]
    aggs = [F.count(F.lit(1)).alias(copies), F.max(f"`{top}`" if top else F.lit(None).cast("string")).alias(TOP)]
    if others:
        aggs.append(F.min_by(F.struct(*[f"`{c}`" for c in others]), F.struct(*[f"`{c}`" for c in order or others])).alias("_row"))
    folded = batch.groupBy(*[f"`{k}`" for k in keys]).agg(*aggs)
    return folded.select(*[F.col(f"`{c}`") if c in keys else F.col(f"_row.`{c}`") for c in batch.columns], copies, TOP)


def merge_update(target: DataFrame, batch: DataFrame, keys: list[str], update: list[str],
                 order: list[str], how: str = "full_outer", copies: str | None = None, top: str | None = None) -> DataFrame:
    """Insert absent keys; on a match overwrite only ``update`` (nulls too) and the load time.

    Repeated keys in the batch act in ``order``: the first supplies the inserted columns, the last
    the updated ones. ``how="right"`` gives the rows of the batch's keys only, ``copies`` a column with their number of
    rows in the batch (rows without a key included), ``top`` the highest value of a column among these.
    """
    if not update and how == "full_outer":
        return merge_insert_only(target, batch, keys, order)
    if LOADED_AT in batch.columns and LOADED_AT not in update:
        update = [*update, LOADED_AT]
    folded = fold_batch(batch, keys, update, order, copies, top).withColumn("_hit", F.lit(True))
    names = [*target.columns, *[c for c in batch.columns if c not in target.columns]]
    t = target.withColumn("_old", F.lit(True)).alias("t")
    joined = t.join(folded.alias("b"), keys, how)

    def pick(name: str) -> Column:
        if name in keys:
            return F.col(name)
        old = F.col(f"t.`{name}`") if name in target.columns else F.lit(None)
        if name in update:
            merged = F.when(F.col("b._hit"), F.col(f"b._last.`{name}`")).otherwise(old)
        elif name in batch.columns:
            merged = F.when(F.col("t._old"), old).otherwise(F.col(f"b._first.`{name}`"))
        else:
            merged = old
        return merged.cast(target.schema[name].dataType) if name in target.columns else merged

    return joined.select(*[pick(n).alias(n) for n in names], *[f"b.{copies}"] * bool(copies), *[f"b.{TOP}"] * bool(top))


def merge_replace(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Update of every non-key column: the last row of the batch per key replaces the target's."""
    return merge_update(target, batch, keys, [c for c in batch.columns if c not in keys], order)


def insert_stats(target: DataFrame, batch: DataFrame, keys: list[str], batch_rows: int | None = None) -> DataFrame:
    """rows_seen, rows_written and rows_deduped of an insert-if-absent, without writing it.

    ``batch_rows`` as in ``new_rows``. Both sides are one row per key before they are shuffled once.
    """
    kept = drop_null_keys(batch, keys)
    per_key = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    old = target.select(*keys)
    held = key_filter(kept, keys, batch_rows) if batch_rows is not None else None
    if held is not None:
        old = old.where(held(keys))
    flagged = per_key.join(old.distinct().withColumn("_old", F.lit(True)), keys, "left")
    totals = flagged.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_seen"),
                         F.count_if(F.col("_old").isNull()).alias("rows_written"))
    return totals.withColumn("rows_deduped", F.greatest(F.col("rows_seen") - F.col("rows_written"), F.lit(0)))


def target_schema(source: T.StructType, keys: list[str] = ()) -> T.StructType:
    """Schema of the target of a source: mapped types, non-null keys, load time last."""
    out = T.StructType()
    for f in source:
        out.add(T.StructField(f.name, target_type(f.dataType), f.nullable and f.name not in keys))
    return out.add(LOADED_AT, T.TimestampType(), False)


def create_target(spark: SparkSession, source: T.StructType, keys: list[str] = ()) -> DataFrame:
    return spark.createDataFrame([], target_schema(source, keys))


def schema_table(tables: dict[str, DataFrame], paths: dict[str, str] | None = None) -> DataFrame:
    """Column list of the targets of several tables, with the null count that decides whether a column could be declared
    non-null. With ``paths`` (the Parquet folder of each table) nulls are counted from the footers, else in one pass."""
    held = footer_counts(next(iter(tables.values())).sparkSession, paths, schemas={n: d.schema for n, d in tables.items()}) if paths is not None else {}

    def one(name: str, df: DataFrame) -> DataFrame:
        fields = target_schema(df.schema).fields
        if paths is not None:
            counts = held[name]
            nulls = df.sparkSession.range(1)
            value = {f.name: f"{counts['*'] - counts[f.name]}L" for f in fields if f.name != LOADED_AT}
        else:
            nulls = df.selectExpr(*[f"COUNT_IF(`{f.name}` IS NULL) AS `{f.name}`" for f in fields if f.name != LOADED_AT])
            value = {f.name: f"`{f.name}`" for f in fields if f.name != LOADED_AT}
        rows = ", ".join(
            f"named_struct('position', {i}L, 'column_name', '{f.name}', 'target_type', '{f.dataType.simpleString()}', "
            f"'null_count', {value.get(f.name, '0L')})" for i, f in enumerate(fields))
        return nulls.selectExpr(f"'{name}' AS table_name", f"inline(array({rows}))")

    parts = reduce(DataFrame.unionAll, [one(n, d) for n, d in tables.items()])
    return parts.withColumn("can_be_required", F.col("null_count") == 0)
