"""Scheduled micro-batches with Structured Streaming.

Every sink here may see a batch twice after a failure. Keyed sinks anti-join the target, the
late-row report overwrites the folder of its batch number, so replays change nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemerge.operators import normalize as N
from tidemerge.operators.load import KEYS, arrival_order
from tidemerge.operators.bucketed import insert_into, replace_into
from tidemerge.sources.pages import CONTACT_PAGE, ENVELOPE_PAGE, envelopes, last_member_wins

_FLATTEN = {
    "messages": (ENVELOPE_PAGE, N.flatten_messages, N.normalize_messages),
    "statuses": (ENVELOPE_PAGE, N.flatten_statuses, N.normalize_statuses),
    "contacts": (CONTACT_PAGE, N.flatten_contacts, N.normalize_contacts),
}


def run_available(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None],
                  mode: str = "append") -> StreamingQuery:
    """Process what has landed and stop; the checkpoint resumes from there next time."""
    query = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(sink).start())
    query.awaitTermination()
    return query


def normalized_stream(pages: DataFrame, entity: str, run_id: str, page: str = "value") -> DataFrame:
    shape, flatten, normalize = _FLATTEN[entity]
    return normalize(flatten(envelopes(pages, page, shape)), run_id)


def ingest_stream(pages: DataFrame, entity: str, path: str, checkpoint: str, run_id: str, page: str = "value",
                  buckets: int | None = None, tasks: int | None = None) -> StreamingQuery:
    """Landed pages to a keyed dataset: flatten, normalise, insert if absent.

    ``tasks`` spreads the pages first; worth it when a batch is a few large files.
    """
    if tasks:
        pages = pages.repartition(tasks)

    def sink(batch: DataFrame, _: int) -> None:
        insert_into(batch, path, KEYS[entity], arrival_order(batch, entity), buckets)

    with last_member_wins(pages.sparkSession):
        return run_available(normalized_stream(pages, entity, run_id, page), checkpoint, sink)


def dedupe_stream(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Drops repeats that arrive within ``delay``; state older than that is forgotten.

    This only lowers volume. The keyed sinks stay exact for repeats of any age.
    """
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def volume_stream(stream: DataFrame, ts: str, by: list[str], path: str, checkpoint: str,
                  buckets: int = 8, distinct: str | None = None) -> StreamingQuery:
    """Daily counts kept current in a keyed dataset, updated groups only.

    ``distinct`` adds an approximate count of distinct values of a column (exact ones cannot be kept
    up to date on a stream).

    No watermark: late rows still count, and the state is one number per day and group.
    """
    figures = [F.count(F.lit(1)).alias("row_count")]
    if distinct:
        figures.append(F.approx_count_distinct(distinct).alias("unique_values"))
    daily = stream.groupBy(F.window(ts, "1 day").alias("w"), *by).agg(*figures)
    keys = ["metric_date", *by]
    rows = daily.select(F.to_date("w.start").alias("metric_date"), *[c for c in daily.columns if c != "w"])
    return run_available(rows, checkpoint, lambda b, _: replace_into(b, path, keys, ["row_count"], buckets), "update")


def late_rows(stream: DataFrame, ts: str, cursor: str, delay: str, path: str, checkpoint: str) -> StreamingQuery:
    """Per batch, how many rows are older than the cursor minus the overlap, and how old the oldest is."""
    limit = F.expr(f"TIMESTAMP '{cursor}' - INTERVAL {delay}")

    def sink(batch: DataFrame, number: int) -> None:
        late = F.col(ts) < limit
        batch.agg(F.count(F.lit(1)).alias("rows_seen"), F.count_if(late).alias("rows_late"),
                  F.min(F.when(late, F.col(ts))).alias("oldest_late")) \
             .write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    return run_available(stream, checkpoint, sink)


def orphan_stream(statuses: DataFrame, messages: DataFrame, key: str, status_ts: str, message_ts: str, within: str, delay: str) -> DataFrame:
    """Statuses whose message did not come: none with the key in the span ``within`` before the status.

    Both streams have a watermark of ``delay``. A status leaves the state when its span lies behind both: as a found one
    at once, as an orphan then. Rows that come later than the delay are not seen. Columns are those of the statuses.
    """
    s, m = statuses.withWatermark(status_ts, delay).alias("s"), messages.select(key, message_ts).withWatermark(message_ts, delay).alias("m")
    near = (F.col(f"s.{key}") == F.col(f"m.{key}")) & (F.col(f"m.{message_ts}") <= F.col(f"s.{status_ts}")) \
        & (F.col(f"m.{message_ts}") >= F.col(f"s.{status_ts}") - F.expr(f"INTERVAL {within}"))
    joined = s.join(m, near, "left_outer").where(F.col(f"m.{key}").isNull())
    return joined.select(*[F.col(f"s.{c}").alias(c) for c in statuses.columns])


def collect_orphans(statuses: DataFrame, messages: DataFrame, key: str, status_ts: str, message_ts: str, within: str, delay: str,
                    path: str, checkpoint: str) -> StreamingQuery:
    """The orphans of all landed rows that the watermarks let decide, a folder a micro-batch: a replay overwrites its own."""
    found = orphan_stream(statuses, messages, key, status_ts, message_ts, within, delay)
    return run_available(found, checkpoint, lambda b, n: b.write.mode("overwrite").parquet(f"{path}/batch_id={n}"))


def dropped_rows(stream: DataFrame, ts: str, keys: list[str], delay: str, path: str, checkpoint: str) -> tuple[StreamingQuery, DataFrame]:
    """Passes a stream on without repeats, and reports per micro-batch what its own watermark dropped: rows older than the
    watermark of the batch before (Spark lets a batch pass what its own would already refuse).

    Kept rows go to ``path``/rows, the report to ``path``/late: rows read and dropped, and the watermark that held, from
    the progress of the query. Batches of a run that restarts follow those before.
    """
    spark = stream.sparkSession
    unique = stream.withWatermark(ts, delay).dropDuplicates([*keys, ts])
    query = run_available(unique, checkpoint, lambda b, n: b.write.mode("overwrite").parquet(f"{path}/rows/batch_id={n}"))
    rows = [(p["batchId"], p["numInputRows"], sum(o["numRowsDroppedByWatermark"] for o in p["stateOperators"]),
             p["eventTime"].get("watermark")) for p in query.recentProgress if p["stateOperators"]]
    schema = "batch_id long, rows_seen long, rows_dropped long, watermark string"
    for n in {r[0] for r in rows}:
        spark.createDataFrame([r for r in rows if r[0] == n][-1:], schema).drop("batch_id").coalesce(1).write.mode("overwrite").parquet(f"{path}/late/batch_id={n}")
    report = spark.read.schema(schema).parquet(f"{path}/late") if rows or query.lastProgress else spark.createDataFrame([], schema)
    return query, report
