"""Daily and sanity views, and the report queries over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemerge.functions.scalars import as_instant, minutes_since
from tidemerge.operators.quality import blank


def _n() -> Column:
    return F.count(F.lit(1))


def _distinct(column: str, approximate: bool) -> Column:
    return F.approx_count_distinct(column) if approximate else F.countDistinct(column)


def message_volume_daily(messages: DataFrame, approximate: bool = False) -> DataFrame:
    """Messages and distinct contacts per day, direction and type.

    The distinct count is planned by Spark as a first aggregate on (group, contact), so a group that
    holds a third of all rows is still spread over all tasks. ``approximate`` counts contacts with a
    sketch in a single shuffle.
    """
    return messages.groupBy(F.to_date("message_timestamp").alias("metric_date"), "direction", "message_type").agg(
        _n().alias("message_count"), _distinct("contact_wa_id", approximate).alias("unique_contacts"))


def status_funnel_daily(messages: DataFrame, statuses: DataFrame) -> DataFrame:
    """Outbound messages and messages per delivery status by day, with rates."""
    sent = messages.where("direction = 'outbound'").groupBy(
        F.to_date("message_timestamp").alias("metric_date")).agg(_n().alias("outbound_messages"))
    # one row per day, status and message first: cheaper than four distinct counts side by side
    reached = statuses.select(F.to_date("status_timestamp").alias("metric_date"), "status", "turn_message_id") \
        .where("turn_message_id is not null").distinct()
    steps = reached.groupBy("metric_date").agg(
        *[F.count_if(F.col("status") == s).alias(f"{s}_messages") for s in ("sent", "delivered", "read", "failed")])
    joined = sent.join(steps, "metric_date", "full_outer").na.fill(0)

    def rate(part: str, whole: str) -> Column:
        return F.round(F.try_divide(F.col(part) * F.lit(100.0), F.col(whole)), 2)

    return joined.withColumns({
        "delivery_rate_pct": rate("delivered_messages", "sent_messages"),
        "read_rate_pct": rate("read_messages", "delivered_messages")})


def contact_snapshots_daily(contacts: DataFrame, approximate: bool = False) -> DataFrame:
    return contacts.groupBy(F.to_date("turn_updated_at").alias("metric_date")).agg(
        _n().alias("snapshot_count"), _distinct("turn_contact_id", approximate).alias("contacts_touched"),
        F.count_if("opted_in").alias("opted_in_snapshots"), F.count_if("onboarded").alias("onboarded_snapshots"))


def contact_flags(contacts: DataFrame) -> DataFrame:
    """Adds ``opted_in`` and ``onboarded`` from the JSON details of normalised contact rows."""
    details = F.try_parse_json("details")

    def flag(name: str) -> Column:
        return F.coalesce(F.try_variant_get(details, f"$.{name}", "boolean"), F.lit(False))

    return contacts.withColumns({"opted_in": flag("opted_in"), "onboarded": flag("onboarded")})


def pipeline_freshness(state: DataFrame, as_of) -> DataFrame:
    return state.select("pipeline_name", "entity_type",
                        F.round(minutes_since("last_success_at", as_of), 2).alias("freshness_minutes"),
                        "rows_seen_last_run", "rows_written_last_run", "last_success_at")


def sanity_snapshot(messages: DataFrame, statuses: DataFrame, contacts: DataFrame, webhooks: DataFrame,
                    runs: DataFrame, as_of, message_key: str = "turn_message_id",
                    snapshot_keys: tuple[str, ...] = ("turn_contact_id", "turn_updated_at")) -> DataFrame:
    """One row of freshness, duplicate, orphan, missing-field and failure figures.

    Messages and statuses are each reduced to one row per message, then matched once; that single
    pass yields all their figures. The one-row parts are stacked and folded, without a cross join.
    """
    def minutes(c: str) -> Column:
        return F.round(minutes_since(F.max(c), as_of), 2)

    m = messages.groupBy(message_key).agg(
        _n().alias("copies"), F.max("message_timestamp").alias("m_ts"),
        F.count_if(blank("direction")).alias("no_direction"), F.count_if(blank("message_type")).alias("no_type"))
    s = statuses.groupBy(message_key).agg(_n().alias("events"), F.max("status_timestamp").alias("s_ts"))
    both = m.join(s, message_key, "full_outer").agg(
        minutes("m_ts").alias("message_freshness_minutes"), minutes("s_ts").alias("status_freshness_minutes"),
        F.sum(F.when(F.col(message_key).isNotNull(), F.col("copies") - 1)).alias("duplicate_messages"),
        F.sum(F.when(F.col("copies").isNull(), F.col("events"))).alias("orphan_status_events"),
        F.sum("no_direction").alias("messages_missing_direction"), F.sum("no_type").alias("messages_missing_type"))
    c = contacts.groupBy(*snapshot_keys).agg(_n().alias("copies")).agg(
        minutes("turn_updated_at").alias("contact_freshness_minutes"),
        F.sum(F.col("copies") - 1).alias("duplicate_contact_snapshots"))
    w = webhooks.agg(minutes("received_at").alias("webhook_freshness_minutes"))
    now = as_instant(as_of)
    started = F.col("started_at").cast("timestamp")
    r = runs.agg(F.count_if((F.col("status") == "failed") & (started > now - F.expr("INTERVAL 24 HOURS")) &
                            (started <= now)).alias("failed_runs_24h"))
    parts = [both, c, w, r]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = [n for p in parts for n in p.columns]
    counts = [n for n in names if not n.endswith("_minutes")]
    return stacked.agg(*[F.coalesce(F.max(n), F.lit(0)).alias(n) if n in counts else F.max(n).alias(n) for n in names]) \
        .select(now.alias("generated_at"), "webhook_freshness_minutes", "message_freshness_minutes",
                "status_freshness_minutes", "contact_freshness_minutes", "duplicate_messages",
                "duplicate_contact_snapshots", "orphan_status_events", "messages_missing_direction",
                "messages_missing_type", "failed_runs_24h")


def sanity_trend(messages: DataFrame, statuses: DataFrame, contacts: DataFrame, webhooks: DataFrame,
                 runs: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Daily counts over the ``days`` days that end at ``as_of``, zero where nothing arrived.

    The range filter reaches every scan; the five streams are counted by day in the map tasks and
    stacked with the empty calendar, so days need no join.
    """
    spark = messages.sparkSession
    last = F.to_date(F.lit(as_of))
    inputs = {
        "webhook_deliveries": (webhooks, "received_at"), "raw_messages": (messages, "message_timestamp"),
        "raw_statuses": (statuses, "status_timestamp"), "raw_contact_snapshots": (contacts, "turn_updated_at"),
        "failed_runs": (runs.where("status = 'failed'"), "started_at")}
    parts = [spark.range(days).select(F.date_sub(last, F.col("id").cast("int")).alias("metric_date"))]
    for name, (df, ts) in inputs.items():
        kind = df.schema[ts].dataType
        inside = df.where((F.col(ts) >= F.date_sub(last, days - 1).cast(kind)) & (F.col(ts) < F.date_add(last, 1).cast(kind)))
        parts.append(inside.groupBy(F.to_date(ts).alias("metric_date")).agg(_n().alias(name)))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.groupBy("metric_date").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in inputs])


def card(view: DataFrame, order: list[Column | str] = (), limit: int | None = None,
         columns: list[str] | None = None, rank: str | None = None) -> DataFrame:
    """Report query: projection, order and an optional row limit.

    ``rank`` numbers the rows in one task: for limited reports and those of a row for each day, pipeline or table.
    """
    if rank and not order:
        raise ValueError("a rank needs an order")
    out = view.select(*columns) if columns else view
    if order:
        out = out.orderBy(*order)
    if limit:
        out = out.limit(limit)
    return out.withColumn(rank, F.row_number().over(Window.orderBy(*order)).cast("bigint")) if rank else out


def latest_first(column: str = "metric_date") -> Column:
    return F.desc(column)
