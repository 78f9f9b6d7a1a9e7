"""Table scans, counts, watermarks, size inventory and cost estimate."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemerge.settings import EGRESS_PRICE_PER_GB, FREE_TB, QUERY_PRICE_PER_TB


def read_table(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """A Parquet table. A known schema saves the job that reads it from the file footers."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def _bound(df: DataFrame, column: str, value) -> Column:
    """A literal of the column's own type, so that no cast on the column blocks pushdown."""
    return F.lit(value).cast(df.schema[column].dataType)


def scan(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


def scan_range(df: DataFrame, column: str, start, end) -> DataFrame:
    """Rows with ``start <= column < end``."""
    return df.where((F.col(column) >= _bound(df, column, start)) & (F.col(column) < _bound(df, column, end)))


def scan_since(df: DataFrame, column: str, watermark, overlap: str | None = None) -> DataFrame:
    """Rows strictly after the watermark; ``overlap`` (interval text) re-reads the span before it."""
    bound = _bound(df, column, watermark)
    if overlap:
        bound = bound - F.expr(f"INTERVAL {overlap}")
    return df.where(F.col(column) > bound)


def scan_full(df: DataFrame) -> DataFrame:
    """Whole table: the plan for a table without an incremental column."""
    return df


def scan_top(df: DataFrame, order: list[Column | str], n: int) -> DataFrame:
    """First ``n`` rows of an order (TakeOrderedAndProject: each task keeps only n rows)."""
    return df.orderBy(*order).limit(n)


def row_count(df: DataFrame, predicate: Column | None = None) -> DataFrame:
    if predicate is not None:
        df = df.where(predicate)
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def max_watermark(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("max_watermark"))


#: Formats that keep Spark's first reader while ``footers`` is open.
_OTHERS = "avro,csv,json,kafka,orc,text"


@contextmanager
def footers(spark: SparkSession) -> Iterator[None]:
    """Parquet tables opened inside answer counts, and least and greatest numbers, from their footers: no column page is
    read. Aggregates must also be collected inside. The session's settings are put back."""
    wanted = {"spark.sql.sources.useV1SourceList": _OTHERS, "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def footer_counts(spark: SparkSession, paths: dict[str, str], limits: dict[str, list[str]] | None = None,
                  schemas: dict[str, T.StructType] | None = None) -> dict[str, dict[str, int]]:
    """For each table its rows (``*``) and those of each column without nulls; ``min c`` and ``max c`` of the whole-number
    columns that ``limits`` names for it. One job for all tables; a table without rows has no limits. Known ``schemas``
    save a look into a file of each table."""
    def opened(name: str) -> DataFrame:
        return (spark.read.schema(schemas[name]) if schemas else spark.read).parquet(paths[name])

    def figures(df: DataFrame, name: str) -> dict[str, Column]:
        wanted = {"*": F.count(F.lit(1)), **{c: F.count(f"`{c}`") for c in df.columns}}
        for c in (limits or {}).get(name, []):
            wanted |= {f"min {c}": F.min(f"`{c}`"), f"max {c}": F.max(f"`{c}`")}
        return wanted

    def row(df: DataFrame, i: int, wanted: list[Column]) -> DataFrame:
        return df.agg(*[c.alias(f"f{k}") for k, c in enumerate(wanted)]).select(
            F.lit(i).alias("i"), F.array(*[F.col(f"f{k}").cast("long") for k in range(len(wanted))]).alias("n"))

    names, plain = list(paths), {name: opened(name) for name in paths}
    keys = {name: figures(df, name) for name, df in plain.items()}
    with footers(spark):
        parts = [row(opened(name), i, list(keys[name].values())) for i, name in enumerate(names)]
        # Spark's pushed counts are wrong for files without row groups; the plain count of rows, from footers too, is not
        parts += [row(plain[name], i + len(names), [F.count(F.lit(1))]) for i, name in enumerate(names)]
        found = dict(reduce(DataFrame.unionAll, parts).collect())
    out = {}
    for i, name in enumerate(names):
        values = found[i]
        if values[0] != found[i + len(names)][0]:
            values = row(plain[name], 0, list(keys[name].values())).first()["n"]
        out[name] = dict(zip(keys[name], values))
    return out


def _fixed_width(kind: T.DataType) -> int | None:
    """Bytes of a value: 8 for numbers and times, 1 for booleans, 16 for decimals; None where they vary."""
    if isinstance(kind, (T.ArrayType, T.StringType, T.BinaryType, T.StructType, T.MapType, T.VariantType)):
        return None
    return 1 if isinstance(kind, T.BooleanType) else 16 if isinstance(kind, T.DecimalType) else 8


def logical_bytes(field: T.StructField) -> str:
    """SQL for the bytes of one value: its fixed width, or 2 + UTF-8 length for text and 8 for each entry of an array."""
    c, kind = f"`{field.name}`", field.dataType
    if isinstance(kind, T.ArrayType):
        width = f"CAST(size({c}) AS BIGINT) * 8"
    elif isinstance(kind, (T.StringType, T.BinaryType)):
        width = f"CAST(octet_length({c}) AS BIGINT) + 2"
    elif _fixed_width(kind) is None:
        width = f"CAST(octet_length(to_json({c})) AS BIGINT) + 2"
    else:
        width = f"{_fixed_width(kind)}L"
    return f"IF({c} IS NULL, 0L, {width})"


def inventory(tables: dict[str, DataFrame], paths: dict[str, str] | None = None) -> DataFrame:
    """One row per table: rows, columns and logical size.

    With ``paths`` (the Parquet folder of each table) rows and columns of fixed width are counted from the footers, and
    only columns whose width varies are read.
    """
    held = footer_counts(next(iter(tables.values())).sparkSession, paths, schemas={n: d.schema for n, d in tables.items()}) if paths is not None else {}

    def one(name: str, df: DataFrame) -> DataFrame:
        fields, base, known = df.schema.fields, "0L", "COUNT(*)"
        varying = [f for f in fields if paths is None or _fixed_width(f.dataType) is None]
        if paths is not None:
            counts = held[name]
            known = f"{counts['*']}L"
            base = f"{sum(counts[f.name] * _fixed_width(f.dataType) for f in fields if f not in varying)}L"
        row = [f"'{name}' AS table_name", f"{known} AS row_count", f"CAST({len(fields)} AS BIGINT) AS column_count"]
        if not varying:
            return df.sparkSession.range(1).selectExpr(*row, f"{base} AS size_bytes")
        return df.selectExpr(*row[:1], f"{base} + COALESCE(SUM({' + '.join(map(logical_bytes, varying))}), 0L) AS size_bytes", *row[1:]).select(
            "table_name", "row_count", "column_count", "size_bytes")

    return reduce(DataFrame.unionAll, [one(n, d) for n, d in tables.items()])


def stored_bytes(df: DataFrame) -> DataFrame:
    """Files of a table and their size on storage, from the listing alone: no file is opened.

    A filter on partition columns leaves files out, any other filter does not.
    """
    paths = df.inputFiles()
    if not paths:
        return df.sparkSession.createDataFrame([(0, 0)], "files bigint, stored_bytes bigint")
    files = df.sparkSession.read.format("binaryFile").load(paths).select("length")
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("stored_bytes"))


def estimated_bytes(df: DataFrame) -> int:
    """Bytes that a query is expected to read, by the optimizer's statistics: columns and partitions it drops count
    as nothing. Runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def cost(sizes: DataFrame, by: str = "table_name", size: str = "size_bytes") -> DataFrame:
    """Query and egress price per table, plus a ``TOTAL`` row. The free allowance applies per table."""
    query = F.greatest(F.lit(0.0), F.col(size) / 1e12 - FREE_TB) * QUERY_PRICE_PER_TB
    egress = F.col(size) / 1e9 * EGRESS_PRICE_PER_GB
    priced = sizes.select(F.col(by), F.col(size).alias("bytes_to_scan"),
                          query.alias("query_cost_usd"), egress.alias("egress_cost_usd"))
    summed = priced.rollup(by).agg(*[F.sum(c).alias(c) for c in priced.columns[1:]])
    return summed.select(
        F.coalesce(F.col(by), F.lit("TOTAL")).alias(by), "bytes_to_scan",
        F.round("query_cost_usd", 4).alias("query_cost_usd"),
        F.round("egress_cost_usd", 4).alias("egress_cost_usd"),
        F.round(F.col("query_cost_usd") + F.col("egress_cost_usd"), 4).alias("total_cost_usd"))
