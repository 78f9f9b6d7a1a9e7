"""Keyed merges into bucketed Parquet tables.

The rows of a dataset lie in one table bucketed by the key, so a merge shuffles its batch and never the target. A write
appends its rows under a generation number of its own and then publishes a pointer that lists the generations readers
use: they see it whole or not at all, and rows that a dead write left are never listed. An insert adds keys that were
absent. An update adds the new rows of the keys it touches, and readers take the newest generation of each key; both
need no shuffle either. When generations outgrow the rows below them, they are rewritten as one in a new folder; a table
that outgrows its buckets is rewritten with more of them, so the rows that one task holds stay bounded.

Figures are observed in the pass that writes: batches are folded to one row per key with a count, so the observation
stands in the last stage, whose tasks count once also when executors are lost. One writer at a time changes a dataset.
"""

from __future__ import annotations

import hashlib
import json
import secrets
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemerge.operators import merge as M
from tidemerge.operators import pointer
from tidemerge.sources import files

GENERATION = "_generation"
DEFAULT_BUCKETS = 64
#: Rows that a bucket is made for; a table with more than twice as many is rewritten with more buckets.
ROWS_A_BUCKET = 1 << 18
LEAST_BUCKETS = 8
#: Generations, whatever their size, that are rewritten as one.
MOST_GENERATIONS = 64

#: Changes of a column's type that every stored value survives and that readers of older files make themselves.
_WIDER = {
    ("byte", "short"), ("byte", "integer"), ("byte", "long"), ("short", "integer"), ("short", "long"), ("integer", "long"),
    ("float", "double"), ("byte", "double"), ("short", "double"), ("integer", "double"),
}


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    buckets: int
    keys: list[str]
    schema: T.StructType
    rows: dict[int, int]  # of each listed generation
    overriding: bool  # some key stands in more than one of them
    first_buckets: int = 0  # those it was made with, before it outgrew them


@dataclass(frozen=True)
class Written:
    """Rows with a key that a write met, rows it added, and those it found there or repeated in its batch; rows without a
    key, and the highest value of a column among the others."""
    rows_seen: int = 0
    rows_written: int = 0
    rows_skipped: int = 0
    top: object = None

    @property
    def rows_deduped(self) -> int:
        return max(self.rows_seen - self.rows_written, 0)


def buckets_for(rows: int) -> int:
    """Buckets for a dataset of about so many rows: a power of two."""
    return max(LEAST_BUCKETS, 1 << max(0, -(-rows // ROWS_A_BUCKET) - 1).bit_length())


def version(spark: SparkSession, path: str) -> Version | None:
    """The newest version of a dataset, or None before the first write."""
    number, at = pointer.newest(spark, path)
    if at is None:
        return None
    return Version(number, at["folder"], at["buckets"], at["keys"], T.StructType.fromJson(at["schema"]),
                   {int(g): n for g, n in at["rows"].items()}, at["overriding"], at.get("first_buckets", at["buckets"]))


def _publish(spark: SparkSession, path: str, at: Version) -> Version:
    pointer.publish(spark, path, at.number + 1, {
        "folder": at.folder, "buckets": at.buckets, "keys": at.keys, "schema": json.loads(at.schema.json()),
        "rows": at.rows, "overriding": at.overriding, "first_buckets": at.first_buckets})
    return replace(at, number=at.number + 1)


def _quoted(names: list[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def table_name(path: str, at: Version) -> str:
    return f"tidemerge_{hashlib.md5(f'{path}/{at.folder}'.encode()).hexdigest()[:24]}"


def _table(spark: SparkSession, path: str, at: Version) -> str:
    """The table in the session's catalog, under the schema of the version."""
    name, full = table_name(path, at), T.StructType([*at.schema.fields, T.StructField(GENERATION, T.LongType())])
    if spark.catalog.tableExists(name):
        held = spark.table(name).schema
        if [(f.name, f.dataType) for f in held] == [(f.name, f.dataType) for f in full]:
            spark.catalog.refreshTable(name)  # another session may have appended
            return name
        spark.sql(f"DROP TABLE {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full)
    where = f"{path}/{at.folder}".replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({', '.join(_quoted(at.keys))}) "
              f"INTO {at.buckets} BUCKETS LOCATION '{where}'")
    return name


def _rows(spark: SparkSession, path: str, at: Version) -> DataFrame:
    listed = spark.table(_table(spark, path, at)).where(F.col(GENERATION).isin(list(at.rows)))
    if not at.overriding:
        return listed.drop(GENERATION)
    newest = Window.partitionBy(*_quoted(at.keys)).orderBy(F.desc(GENERATION))
    return listed.withColumn("_newest", F.row_number().over(newest)).where("_newest = 1").drop("_newest", GENERATION)


def read_target(spark: SparkSession, path: str) -> DataFrame | None:
    """The dataset as its newest version has it, or None before the first write."""
    at = version(spark, path)
    return None if at is None else _rows(spark, path, at)


def grown(stored: T.StructType, new: T.StructType, keys: list[str] = ()) -> tuple[T.StructType, list]:
    """Schema for the rows of both, and the columns of the new rows under it.

    New columns come last. A column keeps its type if that is the wider one and takes the batch's if that is; any
    other change could lose values and is refused before anything is written. Keys keep theirs: buckets depend on it.
    """
    old = {f.name: f.dataType for f in stored}
    kinds = {f.name: f.dataType for f in stored}
    columns = []
    for f in new:
        have = old.get(f.name)
        if have is None or have == f.dataType or (have.typeName(), f.dataType.typeName()) in _WIDER and f.name not in keys:
            kinds[f.name] = f.dataType
        elif (f.dataType.typeName(), have.typeName()) not in _WIDER:
            raise TypeError(f"column {f.name} holds {have.simpleString()}, the batch has {f.dataType.simpleString()}")
        columns.append(F.col(f"`{f.name}`").cast(kinds[f.name]).alias(f.name))
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()]), columns


def _opened(batch: DataFrame, path: str, keys: list[str], buckets: int | None) -> tuple[Version, DataFrame]:
    """The version to write on, under the schema that holds the batch too, and the batch under that schema."""
    at = version(batch.sparkSession, path)
    if at is None:
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in batch.schema])
        first = buckets or DEFAULT_BUCKETS
        return Version(0, "rows-1", first, list(keys), schema, {}, False, first), batch
    if buckets not in (None, at.buckets, at.first_buckets) or list(keys) != at.keys:
        raise ValueError(f"{path} has {at.buckets} buckets by {at.keys}, not {buckets} by {keys}")
    schema, columns = grown(at.schema, batch.schema, keys)
    return replace(at, schema=schema), batch.select(*columns)


def _append(df: DataFrame, path: str, at: Version, figures: dict, keep: str | None = None) -> tuple[int, dict]:
    """Appends the rows of ``df`` (those that ``keep`` selects) as a new generation, observing ``figures`` on all."""
    spark, seen = df.sparkSession, Observation()
    name = _table(spark, path, at)
    generation = (at.number + 1 << 32) | secrets.randbits(32)  # above all listed ones and unlike those of dead writes
    held = df.observe(seen, *[c.alias(n) for n, c in figures.items()])
    kept = held.where(keep) if keep else held
    columns = [F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in at.schema]
    kept.select(*columns, F.lit(generation).cast("long").alias(GENERATION)).write.insertInto(name)
    return generation, seen.get


def _settled(spark: SparkSession, path: str, at: Version) -> None:
    _publish(spark, path, at)
    first, *later = at.rows.values()
    if _outgrown(at) or len(at.rows) > MOST_GENERATIONS or sum(later) > max(first, 1) and len(later) > 3:
        compact(spark, path)


def _outgrown(at: Version) -> bool:
    return sum(at.rows.values()) > 2 * at.buckets * ROWS_A_BUCKET


def _keyed(keys: list[str]) -> str:
    return " and ".join(f"`{k}` is not null" for k in keys)


def _figures(keys: list[str], top: str | None) -> dict:
    """Rows with and without a key, and the highest ``top`` of those with one."""
    keyed = F.expr(_keyed(keys))
    return {"seen": F.sum(F.when(keyed, F.col("_copies"))), "skipped": F.sum(F.when(~keyed, F.col("_copies"))),
            "top": F.max(F.when(keyed, F.col(M.TOP))) if top else F.max(F.lit(None).cast("string"))}


def insert_into(batch: DataFrame, path: str, keys: list[str], order: list[str], buckets: int | None = None, top: str | None = None) -> Written:
    """Insert-if-absent: one job that folds the batch, looks its keys up in their buckets and appends the absent ones.

    Only the key columns of the target are read. Running it again adds only what is still absent.
    """
    spark = batch.sparkSession
    at, kept = _opened(batch, path, keys, buckets)
    folded = M.fold_first(kept, keys, order, top=top)
    if at.rows:
        old = spark.table(_table(spark, path, at)).where(F.col(GENERATION).isin(list(at.rows))).select(*_quoted(keys))
        if at.overriding:
            old = old.distinct()
        found = folded.join(old.withColumn("_old", F.lit(True)), list(keys), "left")
    else:
        found = folded.repartition(at.buckets, *_quoted(keys)).withColumn("_old", F.lit(None).cast("boolean"))
    new = f"_old is null and {_keyed(keys)}"
    generation, n = _append(found, path, at, {**_figures(keys, top), "added": F.count_if(F.expr(new))}, new)
    done = Written(n["seen"] or 0, n["added"] or 0, n["skipped"] or 0, n["top"])
    if done.rows_written or not at.number:
        _settled(spark, path, replace(at, rows={**at.rows, generation: done.rows_written}))
    return done


def update_into(batch: DataFrame, path: str, keys: list[str], update: list[str], order: list[str],
                buckets: int | None = None, top: str | None = None) -> Written:
    """Merge with update: the whole new rows of the batch's keys become a generation that overrides older ones.

    A batch without rows changes nothing. ``rows_written`` counts the rows of the batch, added or updated.
    """
    spark = batch.sparkSession
    at, kept = _opened(batch, path, keys, buckets)
    old = _rows(spark, path, at) if at.rows else spark.createDataFrame([], at.schema)
    merged = M.merge_update(old, kept, keys, update, order, how="right", copies="_copies", top=top)
    if not at.rows:
        merged = merged.repartition(at.buckets, *_quoted(keys))
    generation, n = _append(merged, path, at, {**_figures(keys, top), "keys": F.count_if(F.expr(_keyed(keys)))}, _keyed(keys))
    if n["keys"] or not at.number:
        _settled(spark, path, replace(at, rows={**at.rows, generation: n["keys"] or 0}, overriding=bool(at.rows)))
    return Written(n["seen"] or 0, n["seen"] or 0, n["skipped"] or 0, n["top"])


def replace_into(batch: DataFrame, path: str, keys: list[str], order: list[str], buckets: int | None = None) -> Written:
    return update_into(batch, path, keys, [c for c in batch.columns if c not in keys], order, buckets)


def compact(spark: SparkSession, path: str) -> bool:
    """Rewrites the listed generations as one in a new folder and publishes that; without a shuffle, unless the rows have
    outgrown their buckets and are dealt out to more.

    The folder before stays for readers until the next compaction.
    """
    at = version(spark, path)
    if at is None or len(at.rows) < 2 and not _outgrown(at):
        return False
    rows, new = _rows(spark, path, at), replace(at, folder=f"rows-{at.number + 1}", rows={}, overriding=False)
    if _outgrown(at):
        new = replace(new, buckets=buckets_for(sum(at.rows.values())))
        rows = rows.repartition(new.buckets, *_quoted(at.keys))
    generation, n = _append(rows, path, new, {"n": F.count(F.lit(1))})
    _publish(spark, path, replace(new, rows={generation: n["n"] or 0}))
    for name in files.children(spark, path):
        if name.startswith("rows-") and name not in (at.folder, new.folder):
            spark.sql(f"DROP TABLE IF EXISTS {table_name(path, replace(at, folder=name))}")
            files.delete(spark, f"{path}/{name}")
    return True
