"""Table manifest: the built-in list, or JSON text with defaults filled in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemerge import settings as S
from tidemerge.functions.scalars import qualified

_ENTRY = ("bq_project string, bq_dataset string, bq_table string, pg_schema string, pg_table string, "
          "conflict_columns array<string>, update_columns array<string>, incremental_column string, "
          "size_tier string, history_start string, batch_rows bigint")


def table_registry(spark: SparkSession, project: str, dataset: str) -> DataFrame:
    """The synced tables with their keys, tiers and history start (all insert-only)."""
    rows = []
    for tier, tables in S.SYNCED_TABLES.items():
        for name, key in tables:
            extra = S.SYNCED_OVERRIDES.get(name, {})
            rows.append((project, dataset, name, S.TARGET_SCHEMA, name, [key], None, S.SYNCED_INCREMENTAL_COLUMN,
                         tier, extra.get("history_start", S.HISTORY_START), extra.get("batch_rows")))
    return spark.createDataFrame(rows, _ENTRY).withColumn("table_key", qualified("bq_dataset", "bq_table"))


def normalize_manifest(manifests: DataFrame, text: Column | str = "manifest", *, project: str,
                       schema: str = S.TARGET_SCHEMA) -> DataFrame:
    """One row per entry of each JSON list, defaults filled. An explicit null counts as missing."""
    entry = F.explode(F.from_json(text, f"array<struct<{_ddl(_ENTRY)}>>")).alias("e")
    e = manifests.select(entry).select("e.*")
    return e.select(
        F.coalesce("bq_project", F.lit(project)).alias("bq_project"), "bq_dataset", "bq_table",
        F.coalesce("pg_schema", F.lit(schema)).alias("pg_schema"),
        F.coalesce("pg_table", "bq_table").alias("pg_table"),
        F.coalesce("conflict_columns", F.array().cast("array<string>")).alias("conflict_columns"),
        "update_columns", "incremental_column",
        F.coalesce("size_tier", F.lit(S.DEFAULT_TIER)).alias("size_tier"),
        F.coalesce("history_start", F.lit(S.HISTORY_START)).alias("history_start"), "batch_rows",
        qualified("bq_dataset", "bq_table").alias("table_key"))


def _ddl(columns: str) -> str:
    return ", ".join(f"{name}: {kind}" for name, kind in (c.split(" ", 1) for c in columns.split(", ")))
