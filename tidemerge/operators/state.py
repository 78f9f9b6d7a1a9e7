"""Control state and run logs: folding runs into state, completion, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemerge import settings as S
from tidemerge.functions.scalars import as_instant, minutes_since, mode_and_flags, normal_watermark, qualified, \
    watermark_rank, watermark_to_json
from tidemerge.operators.merge import merge_insert_only, merge_replace

# --- fixed values: columns of the sync state
SYNC_STATE = (
    "table_key string, bq_project string, bq_dataset string, bq_table string, pg_schema string, pg_table string, "
    "incremental_column string, last_watermark_value string, last_synced_at timestamp_ntz, "
    "rows_synced_last_run bigint, total_rows_synced bigint, last_run_status string, error_message string, "
    "historical_completed_at timestamp_ntz"
)


def empty_state(spark) -> DataFrame:
    return spark.createDataFrame([], SYNC_STATE)


def last_runs(runs: DataFrame) -> DataFrame:
    """Per table the newest run, the rows of all runs and the highest watermark of those that succeeded (one aggregate).

    A failed run may have stopped anywhere: rows before its watermark can still be missing. The watermark is
    ``watermark_value`` (JSON text of a time or a number) where the log has it, else the time ``watermark_end``.
    """
    stored = F.col("watermark_value") if "watermark_value" in runs.columns else watermark_to_json("watermark_end")
    runs = runs.withColumn("_wm", stored)
    newest = F.max_by(F.struct("finished_at", "rows_transferred", "status", "error_message", "_wm"),
                      F.struct("started_at", "run_id"))
    good = F.when(F.col("status") == "success", F.col("_wm"))
    return runs.groupBy("table_key").agg(
        newest.alias("run"), F.sum("rows_transferred").alias("rows_all"),
        F.max_by(good, F.when(good.isNotNull(), watermark_rank("_wm"))).alias("wm_all"))


def fold_runs(state: DataFrame, runs: DataFrame, project: str, policy: str = "monotone",
              incremental_column: str = S.SYNCED_INCREMENTAL_COLUMN) -> DataFrame:
    """State after the runs. ``monotone`` never moves a watermark back; ``last_run`` stores what the
    newest run reports, so a run that moved nothing clears it."""
    s, r = state.alias("s"), last_runs(runs).alias("r")
    old = F.col("s.last_watermark_value")
    if policy == "monotone":
        ahead = old.isNull() | (watermark_rank("r.wm_all") > watermark_rank("s.last_watermark_value"))
        wm = F.when(F.col("r.wm_all").isNotNull() & ahead, F.col("r.wm_all")).otherwise(normal_watermark("s.last_watermark_value"))
    elif policy == "last_run":
        wm = F.when(F.col("r.run").isNotNull(), F.col("r.run._wm")).otherwise(old)
    else:
        raise ValueError(policy)
    ran = F.col("r.run").isNotNull()

    def newest(field: str, old: str) -> Column:
        return F.when(ran, F.col(f"r.run.{field}")).otherwise(F.col(f"s.{old}")).alias(old)

    dataset, table = F.split_part("table_key", F.lit("."), F.lit(1)), F.split_part("table_key", F.lit("."), F.lit(-1))
    return s.join(r, "table_key", "full_outer").select(
        "table_key", F.coalesce("s.bq_project", F.lit(project)).alias("bq_project"),
        F.coalesce("s.bq_dataset", dataset).alias("bq_dataset"), F.coalesce("s.bq_table", table).alias("bq_table"),
        F.coalesce("s.pg_schema", F.lit(S.TARGET_SCHEMA)).alias("pg_schema"),
        F.coalesce("s.pg_table", table).alias("pg_table"),
        F.coalesce("s.incremental_column", F.lit(incremental_column)).alias("incremental_column"),
        wm.alias("last_watermark_value"), newest("finished_at", "last_synced_at"),
        newest("rows_transferred", "rows_synced_last_run"),
        (F.coalesce("s.total_rows_synced", F.lit(0)) + F.coalesce("r.rows_all", F.lit(0))).alias("total_rows_synced"),
        newest("status", "last_run_status"),
        F.when(ran, F.when(F.col("r.run.status") != "success", F.col("r.run.error_message")))
         .otherwise(F.col("s.error_message")).alias("error_message"),
        "s.historical_completed_at")


def coverage(counts: DataFrame) -> DataFrame:
    return counts.withColumn("coverage", F.when(
        F.col("source_count") > 0, F.col("target_count").cast("double") / F.col("source_count")).otherwise(F.lit(0.0)))


def mark_complete(state: DataFrame, counts: DataFrame, runs: DataFrame, as_of) -> DataFrame:
    """Set the completion time of tables whose runs were all historical and whose target holds at
    least 99 % of the source rows. Tables without any run stay as they are."""
    modes = runs.groupBy("table_key").agg(F.bool_and(F.col("run_type") == "historical").alias("all_historical"))
    facts = coverage(counts).join(modes, "table_key", "left").select("table_key", "coverage", "all_historical")
    done = F.coalesce(F.col("all_historical"), F.lit(False)) & (F.col("coverage") >= S.COMPLETE_COVERAGE)
    kind = state.schema["historical_completed_at"].dataType
    return state.join(facts, "table_key", "left").withColumn(
        "historical_completed_at",
        F.when(done, as_instant(as_of).cast(kind)).otherwise(F.col("historical_completed_at"))).drop("coverage", "all_historical")


def reset(state: DataFrame, table_key: Column | str) -> DataFrame:
    """Forget watermark and completion of the chosen tables, so that they load from the start again."""
    hit = F.col("table_key") == table_key if isinstance(table_key, str) else table_key
    return state.withColumns({
        c: F.when(~hit, F.col(c)) for c in ("last_watermark_value", "historical_completed_at")})


def list_state(state: DataFrame) -> DataFrame:
    return state.orderBy("table_key")


def close_runs(starts: DataFrame, finishes: DataFrame) -> DataFrame:
    """Run log: opened runs with their latest finish; a run without one is still ``running``."""
    fields = ["finished_at", "status", "rows_transferred", "bytes_scanned", "watermark_end", "error_message"]
    last = finishes.groupBy("run_id").agg(F.max_by(F.struct(*fields), "finished_at").alias("f"))
    rows = starts.join(last, "run_id", "left")
    return rows.select(
        *starts.columns, F.col("f.finished_at").alias("finished_at"),
        F.coalesce("f.status", F.lit("running")).alias("status"),
        F.coalesce("f.rows_transferred", F.lit(0)).alias("rows_transferred"),
        F.coalesce("f.bytes_scanned", F.lit(0)).alias("bytes_scanned"),
        F.col("f.watermark_end").alias("watermark_end"), F.col("f.error_message").alias("error_message"))


def transfer_freshness(state: DataFrame, as_of) -> DataFrame:
    return state.select(
        "table_key", qualified("bq_project", "bq_dataset", "bq_table").alias("bq_full_id"),
        qualified("pg_schema", "pg_table").alias("pg_full_id"), "incremental_column", "last_synced_at",
        F.round(minutes_since("last_synced_at", as_of), 2).alias("minutes_since_sync"), "last_run_status",
        "rows_synced_last_run", "total_rows_synced",
        F.col("historical_completed_at").isNotNull().alias("historical_done"), "error_message",
    ).orderBy(F.desc_nulls_last("last_synced_at"), "table_key")


def status_report(state: DataFrame) -> DataFrame:
    """Failed tables first, then running ones, then the rest; smaller totals first within each."""
    urgency = F.when(F.col("last_run_status") == "failed", 0).when(F.col("last_run_status") == "running", 1).otherwise(2)
    report = mode_and_flags(state.withColumns({"status": F.col("last_run_status"), "urgency": urgency.cast("bigint")}),
                            keep=["bq_table", "status", "urgency", "total_rows_synced"])
    return report.drop("historical_done").orderBy("urgency", "total_rows_synced", "bq_table")


def upsert_cursor(state: DataFrame, runs: DataFrame, advance: bool = True) -> DataFrame:
    """Cursor rows replaced by the newest successful run of each pipeline; a backfill leaves them."""
    if not advance:
        return state
    good = runs.where("status = 'success'")
    latest = good.groupBy("pipeline_name").agg(F.max_by(F.struct(*[c for c in good.columns if c != "pipeline_name"]),
                                                        F.struct("finished_at", "run_id")).alias("r"))
    rows = latest.select(
        "pipeline_name", "r.entity_type", F.col("r.window_end").alias("last_cursor_at"),
        F.col("r.window_start").alias("last_window_start"), F.col("r.window_end").alias("last_window_end"),
        F.col("r.run_id").alias("last_run_id"), F.col("r.finished_at").alias("last_success_at"),
        F.col("r.rows_seen").alias("rows_seen_last_run"), F.col("r.rows_written").alias("rows_written_last_run"),
        *[F.col("r.state_json").alias("state_json")] * ("state_json" in state.columns and "state_json" in runs.columns))
    return merge_replace(state, rows, ["pipeline_name"], ["last_success_at"])


def run_log(starts: DataFrame, finishes: DataFrame) -> DataFrame:
    """Ingestion runs: the first start of a run counts, its latest finish fills in the outcome."""
    opened = merge_insert_only(starts.limit(0), starts, ["run_id"], ["started_at"])
    fields = ["finished_at", "status", "rows_seen", "rows_written", "details", "error_message"]
    last = finishes.groupBy("run_id").agg(F.max_by(F.struct(*fields), "finished_at").alias("f"))
    seen, written = F.coalesce("f.rows_seen", F.lit(0)), F.coalesce("f.rows_written", F.lit(0))
    return opened.join(last, "run_id", "left").select(
        *starts.columns, F.col("f.finished_at").alias("finished_at"),
        F.coalesce("f.status", F.lit("running")).alias("status"), seen.alias("rows_seen"),
        written.alias("rows_written"), F.greatest(seen - written, F.lit(0)).alias("rows_deduped"),
        F.coalesce("f.details", F.lit("{}")).alias("details"), F.col("f.error_message").alias("error_message"))


def error_log(runs: DataFrame, stage: str, context: list[str]) -> DataFrame:
    """One row per failed run with its context as JSON."""
    return runs.where("status = 'failed'").select(
        "run_id", "entity_type", F.lit(stage).alias("error_stage"), "error_message",
        F.to_json(F.struct(*context), {"ignoreNullFields": "false"}).alias("error_context"))
