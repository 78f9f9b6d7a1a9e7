"""Whole jobs: sync one table, ingest pages, verify a load, refresh the published views.

Rows stay in Spark throughout. The driver sees the plan of a table (one row per chunk), one row of
figures per run, and the outcome of each view.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tidemerge.functions.scalars import as_instant, coerce_row, format_iso_utc, watermark_json
from tidemerge.operators import merge as M
from tidemerge.operators import state as ST
from tidemerge.operators import bucketed as store
from tidemerge.operators import published
from tidemerge.operators import views as V
from tidemerge.operators.load import KEYS, TIME, arrival_order
from tidemerge.plans.windows import cursor_window
from tidemerge.settings import ENTITIES
from tidemerge.sources import files
from tidemerge.sources.tables import estimated_bytes, row_count, scan_full, scan_range, scan_since
from tidemerge.streaming.ingest import normalized_stream

# --- fixed values: columns of the transfer run log
TRANSFER_RUNS = (
    "run_id string, table_key string, run_type string, started_at timestamp_ntz, finished_at timestamp_ntz, "
    "status string, rows_seen bigint, rows_skipped bigint, rows_transferred bigint, watermark_start string, "
    "watermark_end timestamp_ntz, error_message string, watermark_value string"
)

# --- fixed values: columns of the cursor table
CURSORS = ("pipeline_name string, entity_type string, last_cursor_at timestamp_ntz, last_window_start timestamp_ntz, "
           "last_window_end timestamp_ntz, last_run_id string, last_success_at timestamp_ntz, rows_seen_last_run bigint, "
           "rows_written_last_run bigint, state_json string")

# --- fixed values: names of the published views
VIEW_NAMES = ("mv_pipeline_freshness", "mv_data_sanity_snapshot", "mv_data_sanity_trend_30d",
              "mv_status_funnel_daily", "mv_message_volume_daily", "mv_contact_snapshots_daily")


def planned_rows(source: DataFrame, chunk: Row | dict, column: str | None) -> DataFrame:
    """The scan of one chunk."""
    if column is None or chunk["label"] == "full":
        return scan_full(source)
    if chunk["label"] == "incremental":
        return scan_since(source, column, chunk["watermark_start"])
    return scan_range(source, column, chunk["watermark_start"], chunk["watermark_end"])


def _done_file(path: str, run_id: str, chunk: Row | dict) -> str:
    return f"{path}/_chunks/{run_id}/{chunk['label']}.json"


def finished_chunks(spark: SparkSession, path: str, run_id: str) -> set[str]:
    """Labels of the chunks that a run has loaded."""
    return {n.removesuffix(".json") for n in files.children(spark, f"{path}/_chunks/{run_id}") if n.endswith(".json")}


def _load_chunk(rows: DataFrame, path: str, keys: list[str], column: str | None, update: list[str], run_id: str, label: str,
                as_of: str, buckets: int | None) -> store.Written:
    """One chunk into the dataset, in one pass that also gives its figures."""
    batch = M.stamp(coerce_row(rows), as_of)
    order = M.total_order(batch, [column] if column else [], keys)
    top = column if column in batch.columns else None
    if keys and update:
        return store.update_into(batch, path, keys, update, order, buckets, top)
    if keys:
        return store.insert_into(batch, path, keys, order, buckets, top)
    seen = Observation()
    figures = [F.count(F.lit(1)).alias("n"), F.max(f"`{top}`" if top else F.lit(None).cast("string")).alias("top")]
    batch.observe(seen, *figures).write.mode("overwrite").parquet(f"{path}/run_id={run_id}/chunk={label}")
    return store.Written(seen.get["n"], seen.get["n"], 0, seen.get["top"])


def _log_error(spark: SparkSession, errors: str | None, run_id: str, what: str, stage: str, message: str, **context) -> None:
    """A row for the error log, written by the run that failed: what it worked on, at which stage, in which span."""
    if errors is None:
        return
    row = spark.createDataFrame([(run_id, what, "failed", message, *context.values())],
                                "run_id string, entity_type string, status string, error_message string, "
                                + ", ".join(f"{c} string" for c in context))
    ST.error_log(row, stage, list(context)).coalesce(1).write.mode("append").parquet(errors)


def sync_table(source: DataFrame, path: str, entry: Row | dict, chunks: list[Row], run_id: str, as_of: str,
               buckets: int | None = None, errors: str | None = None) -> DataFrame:
    """Load the planned chunks of one table into its dataset, one after another; returns the row for the run log.

    Each chunk is one commit, and the run notes it as finished: a run that died or failed goes on, under the same run id,
    with the first chunk it had not finished. With a key the load is a merge and may be repeated at will. Without one
    it appends, a folder a run and chunk. A failure is recorded, not raised; its row has the figures of the chunks before,
    and ``errors`` (a folder) gets a row with the chunk it happened in.
    """
    spark = source.sparkSession
    keys, column, update = list(entry["conflict_columns"] or []), entry["incremental_column"], list(entry["update_columns"] or [])
    kind = chunks[0]["run_type"] if chunks else "historical"
    start = min((c["watermark_start"] for c in chunks), default=None)
    seen, skipped, top, status, error, chunk = 0, 0, None, "success", None, None
    try:
        done = finished_chunks(spark, path, run_id)
        for chunk in chunks:
            if chunk["label"] in done:
                continue
            n = _load_chunk(planned_rows(source, chunk, column), path, keys, column, update, run_id, chunk["label"], as_of, buckets)
            seen, skipped = seen + n.rows_seen + n.rows_skipped, skipped + n.rows_skipped
            top = n.top if top is None or n.top is not None and n.top > top else top
            if chunk["label"] not in ("incremental", "full"):  # these stand for whatever has come since
                files.write_new(spark, _done_file(path, run_id, chunk), json.dumps({"rows": n.rows_seen, "written": n.rows_written}))
    except Exception as problem:  # noqa: BLE001 - the run log must show every failure
        status, error = "failed", str(problem)
        span = {c: chunk[c] if chunk else None for c in ("label", "watermark_start", "watermark_end")}
        _log_error(spark, errors, run_id, entry["table_key"], "load_chunk", error, **span)
    kind_of_top = source.schema[column].dataType.simpleString() if column in source.columns else "string"
    timed, text = _watermark(spark, top, kind_of_top, column)
    row = spark.createDataFrame([(run_id, entry["table_key"], kind, status, seen, skipped, start, timed, error, text)],
                                "run_id string, table_key string, run_type string, status string, rows_seen bigint, "
                                "rows_skipped bigint, watermark_start string, watermark_end timestamp_ntz, error_message string, "
                                "watermark_value string")
    now = as_instant(as_of).cast("timestamp_ntz")
    full = row.withColumns({"started_at": now, "finished_at": now, "rows_transferred": F.col("rows_seen") - F.col("rows_skipped")})
    return full.select(*[f.name for f in spark.createDataFrame([], TRANSFER_RUNS).schema])


def _watermark(spark: SparkSession, top, kind: str, column: str | None) -> tuple:
    """The highest watermark as a time, if it is one, and as stored text."""
    if top is None or column is None:
        return None, None
    one = spark.range(1).select(F.lit(top).cast(kind).alias("top"))
    timed = F.col("top").cast("timestamp_ntz") if kind.startswith(("timestamp", "date", "string")) else F.lit(None).cast("timestamp_ntz")
    return tuple(one.select(timed, watermark_json(F.col("top"), kind)).first())


def ingest_pages(pages: DataFrame, entity: str, path: str, run_id: str, window: tuple[str, str], as_of: str,
                 page: str = "value", buckets: int | None = None, advance: bool = True, errors: str | None = None) -> DataFrame:
    """Landed pages of one window into their dataset; returns the row for the ingestion log.

    Seen rows are those that survive normalisation; written ones were absent before. ``state_json`` has the time of the
    latest record (the window's start without any), ``details`` that and whether the run moves the cursor. A failure is
    recorded, not raised; ``errors`` (a folder) gets a row with its text and window.
    """
    spark = pages.sparkSession
    done, status, error = store.Written(), "success", None
    try:
        rows = normalized_stream(pages, entity, run_id, page)
        done = store.insert_into(rows, path, KEYS[entity], arrival_order(rows, entity), buckets, top=TIME[entity])
    except Exception as problem:  # noqa: BLE001 - the run log must show every failure
        status, error = "failed", str(problem)
        _log_error(spark, errors, run_id, entity, "sync_entity_window", error, window_start=window[0], window_end=window[1])
    row = [(run_id, entity, ENTITIES[entity]["source"], status, done.rows_seen, done.rows_written, done.rows_deduped, error)]
    log = spark.createDataFrame(row, "run_id string, entity_type string, source string, status string, rows_seen bigint, "
                                     "rows_written bigint, rows_deduped bigint, error_message string")
    start, end, now = (as_instant(x).cast("timestamp_ntz") for x in (*window, as_of))
    latest = format_iso_utc(F.lit(done.top).cast("timestamp") if done.top is not None else as_instant(window[0]))
    facts = F.struct(F.lit(advance).alias("advance_cursor"), latest.alias("last_record_ts")) if status == "success" \
        else F.struct(F.lit(advance).alias("advance_cursor"))
    return log.withColumns({"window_start": start, "window_end": end, "started_at": now, "finished_at": now,
                            "pipeline_name": F.concat("entity_type", F.lit("_incremental")), "details": F.to_json(facts),
                            "state_json": F.to_json(F.struct(latest.alias("last_record_ts")))})


def _loaded(spark: SparkSession, path: str) -> DataFrame | None:
    """A keyed dataset, or the runs of a keyless one; None before the first load."""
    if any(n.startswith("run_id=") for n in files.children(spark, path)):
        return spark.read.option("mergeSchema", "true").parquet(path)
    return store.read_target(spark, path)


class RunFailed(RuntimeError):
    """A run ended as failed; the log has its row."""


# --- fixed values: columns of an opened and of a closed run
OPENED = "run_id string, table_key string, run_type string, started_at timestamp"
CLOSED = ("run_id string, finished_at timestamp, status string, rows_transferred bigint, bytes_scanned bigint, "
          "watermark_end timestamp_ntz, error_message string, rows_per_second double")


def logged(spark: SparkSession, log: str, run_id: str, table_key: str, run_type: str, work: Callable[[], DataFrame],
           source: DataFrame | None = None) -> Row:
    """Does ``work`` (which returns a row for the run log) between two rows of the log; a failure is raised.

    The run is open in the log before anything is loaded, so one that dies with its driver still shows, as running.
    Times are those of the clock. ``source`` gives the bytes that the run is expected to scan.
    """
    start = datetime.now(timezone.utc)
    spark.createDataFrame([(run_id, table_key, run_type, start)], OPENED).coalesce(1).write.mode("append").parquet(f"{log}/opened")
    try:
        row = work().collect()[0]
        status, rows, top, error = row["status"], row["rows_transferred"], row["watermark_end"], row["error_message"]
    except Exception as problem:
        row, status, rows, top, error = None, "failed", 0, None, str(problem)
    end = datetime.now(timezone.utc)
    speed = rows / max((end - start).total_seconds(), 1e-3)
    scanned = estimated_bytes(source) if source is not None else 0
    closed = spark.createDataFrame([(run_id, end, status, rows, scanned, top, error, speed)], CLOSED)
    closed.coalesce(1).write.mode("append").parquet(f"{log}/closed")
    if status != "success":
        raise RunFailed(error)
    return row


def run_log(spark: SparkSession, log: str) -> DataFrame:
    """The log written by ``logged``: a row for each run, still running if it was never closed."""
    opened = spark.read.schema(OPENED).parquet(f"{log}/opened")
    closed = spark.read.schema(CLOSED).parquet(f"{log}/closed") if files.children(spark, f"{log}/closed") \
        else spark.createDataFrame([], CLOSED)
    speed = closed.groupBy("run_id").agg(F.max_by("rows_per_second", "finished_at").alias("rows_per_second"))
    return ST.close_runs(opened, closed).join(speed, "run_id", "left")


def sync_incremental(pages: DataFrame, entity: str, landed: str, path: str, cursors: str, run_id: str, as_of: str,
                     page: str = "value", advance: bool = True, errors: str | None = None) -> DataFrame:
    """One incremental run of an entity: its window by the stored cursor, the pages that landed in it, the load, and
    the cursor moved on if that succeeded and the run is one that ``advance``s it (a backfill is not). Returns the row for
    the ingestion log.

    ``landed`` is the pages' time column, ``cursors`` the dataset of cursor rows.
    """
    spark = pages.sparkSession
    name = f"{entity}_incremental"
    stored = store.read_target(spark, cursors)
    at = spark.createDataFrame([], CURSORS) if stored is None else stored
    mine = spark.createDataFrame([(name, entity)], "pipeline_name string, entity_type string").join(
        at.select("pipeline_name", "last_cursor_at"), "pipeline_name", "left")
    window = cursor_window(mine, as_of).select(F.col("window_from").cast("string"), F.col("window_until").cast("string")).first()
    inside = scan_range(pages, landed, *window).drop(landed)
    done = ingest_pages(inside, entity, path, run_id, tuple(window), as_of, page, advance=advance, errors=errors)
    if advance and done.collect()[0]["status"] == "success":
        moved = ST.upsert_cursor(spark.createDataFrame([], CURSORS), done)
        store.replace_into(moved, cursors, ["pipeline_name"], ["last_success_at"], 1)
    return done


def verify(state: DataFrame, sources: dict[str, DataFrame], paths: dict[str, str], runs: DataFrame, as_of: str) -> DataFrame:
    """State with the completion time set where source and target counts allow it.

    The counts (two numbers per table) are taken now: a lazy count would see the target as it is
    when the state is used, or an older listing of its files if the state refers to one.
    """
    spark = state.sparkSession
    counts = []
    for key, source in sources.items():
        target = _loaded(spark, paths[key])
        counts.append((key, row_count(source).collect()[0][0], 0 if target is None else row_count(target).collect()[0][0]))
    return ST.mark_complete(state, spark.createDataFrame(
        counts, "table_key string, source_count bigint, target_count bigint"), runs, as_of)


def refresh_views(spark: SparkSession, messages: DataFrame, statuses: DataFrame, contacts: DataFrame, webhooks: DataFrame,
                  runs: DataFrame, cursors: DataFrame, path: str, version: str, as_of: str,
                  database: str = "default") -> DataFrame:
    """Recompute and publish the six views under their usual names; one outcome row per view.

    ``contacts`` are normalised rows; their flags are read from the details.
    """
    flagged = V.contact_flags(contacts)
    builds = (lambda: V.pipeline_freshness(cursors, as_of),
              lambda: V.sanity_snapshot(messages, statuses, contacts, webhooks, runs, as_of),
              lambda: V.sanity_trend(messages, statuses, contacts, webhooks, runs, as_of),
              lambda: V.status_funnel_daily(messages, statuses),
              lambda: V.message_volume_daily(messages),
              lambda: V.contact_snapshots_daily(flagged))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    return published.publish_all(spark, {f"{database}.{n}": b for n, b in zip(VIEW_NAMES, builds)}, path, version)
