"""Data-quality checks: reconciliation, orphans, duplicates, missing fields, summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def blank(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | (F.trim(c) == "")


def reconcile_counts(source: DataFrame, target: DataFrame, by: list[str]) -> DataFrame:
    """Row counts of source and target per group. Counts are summed before the shuffle."""
    tagged = source.select(*by, F.lit(1).alias("_in_source"), F.lit(0).alias("_in_target")).unionAll(
        target.select(*by, F.lit(0).alias("_in_source"), F.lit(1).alias("_in_target")))
    counts = tagged.groupBy(*by).agg(F.sum("_in_source").alias("source_count"), F.sum("_in_target").alias("target_count"))
    return counts.withColumns({
        "difference": F.col("source_count") - F.col("target_count"),
        "count_match": F.col("source_count") == F.col("target_count")})


def reconcile_keys(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Keys found on one side only: ``missing`` from the target or ``extra`` in it.

    A tagged union and one aggregate: repeated keys collapse in the map tasks, and there is no join.
    """
    tagged = source.select(*keys, F.lit(1).alias("_in_source"), F.lit(0).alias("_in_target")).unionAll(
        target.select(*keys, F.lit(0).alias("_in_source"), F.lit(1).alias("_in_target")))
    sides = tagged.groupBy(*keys).agg(F.max("_in_source").alias("_in_source"), F.max("_in_target").alias("_in_target")).where("_in_source <> _in_target")
    return sides.select(*keys, F.when(F.col("_in_source") == 1, "missing").otherwise("extra").alias("finding"))


def orphans(statuses: DataFrame, messages: DataFrame, key: str = "turn_message_id") -> DataFrame:
    """Statuses whose message is unknown. Nothing is grouped after the join, so AQE may split a message that holds a
    large share of them."""
    return statuses.join(messages.select(key), key, "left_anti")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def missing_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  *[F.count_if(blank(c)).alias(f"missing_{c}") for c in columns])


def table_summary(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Row count and time range per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))
               .select(F.lit(name).alias("table_name"), "row_count", "min_ts", "max_ts")
             for name, (df, ts) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def batch_watermark(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Highest incremental value among the rows that have a key."""
    return df.na.drop(subset=keys).agg(F.max(column).alias("watermark_end"))


def run_rollup(runs: DataFrame) -> DataFrame:
    """Runs, tables, rows and tables whose counts disagree."""
    per_table = runs.groupBy("table_key").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("rows_transferred").alias("rows"),
        F.bool_and("count_match").alias("ok"))
    return per_table.agg(
        F.count(F.lit(1)).alias("tables"), F.sum("runs").alias("runs"), F.sum("rows").alias("total_rows"),
        F.count_if(~F.col("ok")).alias("mismatched_tables"))


def mismatched_tables(runs: DataFrame) -> DataFrame:
    return runs.groupBy("table_key").agg(F.bool_and("count_match").alias("ok")).where("not ok").select("table_key")


def recent_runs(runs: DataFrame, job: Column, n: int = 10) -> DataFrame:
    return runs.where(job).orderBy(F.desc("started_at"), F.desc("run_id")).limit(n)
