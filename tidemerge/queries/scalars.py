"""Column functions over whole tables."""

from pyspark.sql import functions as F

from tidemerge.functions import scalars as S
from tidemerge.queries import stand_ins as SI
from tidemerge.queries.base import columns_sql, day_sql, query, report_columns_sql, stamp_sql
from tidemerge.queries.stand_in_sql import EVENTS_AS_OF


@query("coerce_nested_to_json", """
    SELECT vec_id, len(embedding) AS items, label,
           '{"label":' || label || ',"none":null,"vec":' || vec_id || '}' AS tag FROM embeddings""")
def _(t):
    e = t.embeddings
    tag = F.struct("label", F.lit(None).cast("string").alias("none"), F.col("vec_id").alias("vec"))
    rows = S.coerce_row(e.select("vec_id", "label", "embedding", tag.alias("tag")))
    return rows.select("vec_id", "label", "tag", F.json_array_length("embedding").cast("bigint").alias("items"))


@query("coerce_decimal", """
    SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(38, 9)) AS VARCHAR) AS exact, o_totalprice AS approximate
    FROM orders""")
def _(t):
    d = t.orders.select("o_orderkey", F.col("o_totalprice").cast("decimal(20,4)").alias("d"))
    return d.select("o_orderkey", S.decimal_value("d").cast("string").alias("exact"),
                    S.decimal_value("d", "double").alias("approximate"))


@query("parse_event_time", f"""
    SELECT event_id, {stamp_sql("CASE event_type WHEN 'click' THEN date_trunc('second', ts) WHEN 'view' THEN date_trunc('millisecond', ts) "
                                "WHEN 'error' THEN NULL ELSE ts END")} AS parsed FROM events""")
def _(t):
    micros, kind = F.unix_micros(F.col("ts").cast("timestamp")), F.col("event_type")
    raw = (F.when(kind == "click", F.floor(micros / 1000000).cast("string"))
           .when(kind == "view", F.floor(micros / 1000).cast("string"))
           .when(kind == "error", F.when(F.col("value") > 50, " ").otherwise("not a time"))
           .when(kind == "signup", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
           .otherwise(F.date_format(F.col("ts") + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd HH:mm:ss.SSSSSS'+02:00'")))
    return t.events.select("event_id", S.parse_event_time(raw).alias("parsed"))


@query("format_iso_utc", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM events")
def _(t):
    return t.events.select("event_id", S.format_iso_utc("ts").alias("iso"))


@query("payload_hash", """
    SELECT event_id, sha256('{"a":' || user_id || ',"b":"' || event_type || '","props":' || replace(props, ' ', '') || '}') AS hash
    FROM events""")
def _(t):
    text = F.concat(F.lit('{"props": '), "props", F.lit(',"b" : "'), "event_type", F.lit('", "a":'), "user_id", F.lit("}"))
    return t.events.select("event_id", S.payload_hash(text).alias("hash"))


@query("first_present_path", """
    SELECT event_id, CASE event_type WHEN 'error' THEN CAST(event_id AS VARCHAR) WHEN 'click' THEN '0'
                                     WHEN 'purchase' THEN 'false' ELSE event_type END AS chosen FROM events""")
def _(t):
    kind = F.col("event_type")
    a = F.when(kind == "error", "").when(kind.isin("view", "signup"), kind)
    b = F.when(kind != "error", F.struct(F.when(kind == "click", 0).alias("c"), F.when(kind == "purchase", F.lit(False)).alias("d")))
    v = F.parse_json(F.to_json(F.struct(a.alias("a"), b.alias("b"), F.col("event_id").alias("n"))))
    return t.events.select("event_id", S.first_present(v, "$.a", "$.b.c", "$.b.d", "$.n").alias("chosen"))


@query("safe_bigint", """
    SELECT event_id, CASE WHEN event_type IN ('click', 'purchase') THEN event_id END AS number FROM events""")
def _(t):
    kind, key = F.col("event_type"), F.col("event_id").cast("string")
    raw = (F.when(kind == "click", F.concat(F.lit(" "), key, F.lit(" "))).when(kind == "purchase", key)
           .when(kind == "view", F.concat(key, F.lit(".7"))).when(kind == "signup", "").otherwise("abc"))
    return t.events.select("event_id", S.safe_bigint(raw).alias("number"))


@query("contact_id_by_direction", """
    SELECT turn_message_id, CASE WHEN message_type = 'P' THEN 'r' || contact_wa_id
                                 WHEN direction = 'outbound' THEN 'to' || contact_wa_id
                                 ELSE 'from' || contact_wa_id END AS wa_id FROM s_messages""")
def _(t):
    who, partly = F.col("contact_wa_id"), F.col("message_type") == "P"
    side = lambda name: F.when(partly, "").otherwise(F.concat(F.lit(name), who))
    return SI.messages(t).select("turn_message_id", S.contact_id(
        F.col("direction"), side("to"), side("from"), F.concat(F.lit("r"), who)).alias("wa_id"))


_STATUS_KEY_SQL = """sha256('{"message_id":' || turn_message_id || ',"recipient_id":"' || recipient_id || '","status":"' || status
    || '","timestamp":"' || strftime(status_timestamp, '%Y-%m-%dT%H:%M:%SZ') || '"}')"""


def status_key_of(rows):
    return rows.withColumn("status_event_key", S.status_key(
        F.col("turn_message_id"), F.col("status"), S.format_iso_utc("status_timestamp"), F.col("recipient_id").cast("string")))


@query("status_event_key", f"SELECT turn_message_id, seq, {_STATUS_KEY_SQL} AS status_event_key FROM s_statuses")
def _(t):
    return status_key_of(SI.statuses(t)).select("turn_message_id", "seq", "status_event_key")


@query("labels_default_empty", """
    SELECT event_id, CASE WHEN event_type = 'click' THEN '["' || user_id || '"]' ELSE '[]' END AS labels FROM events""")
def _(t):
    kind = F.col("event_type")
    labels = F.when(kind == "click", F.array(F.col("user_id").cast("string"))).when(kind == "view", F.array().cast("array<string>"))
    v = F.parse_json(F.to_json(F.struct("props", labels.alias("labels"))))
    return t.events.select("event_id", S.labels_or_empty(S.variant_at(v, "$.labels", "variant")).alias("labels"))


@query("qualified_ids", """
    SELECT c_custkey, r_name || '.' || n_name || '.' || c_name AS full_id FROM customer
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def _(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")) \
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select("c_custkey", S.qualified("r_name", "n_name", "c_name").alias("full_id"))


@query("minutes_since", f"""
    SELECT event_id, round((epoch_us(TIMESTAMP '{EVENTS_AS_OF}') - epoch_us(ts)) / 6e7, 2) AS minutes FROM events""")
def _(t):
    return t.events.select("event_id", F.round(S.minutes_since("ts", EVENTS_AS_OF), 2).alias("minutes"))


@query("mode_and_flags", f"""
    SELECT table_key, {columns_sql(report_columns_sql())}, historical_completed_at IS NOT NULL AS historical_done FROM s_state""")
def _(t):
    return S.mode_and_flags(SI.state(t))


@query("watermark_json_roundtrip", f"""
    SELECT o_orderkey, '"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || '"' AS stored,
           {stamp_sql('o_orderdate')} AS restored, CAST(o_orderkey AS VARCHAR) AS stored_number, o_orderkey AS restored_number
    FROM orders""")
def _(t):
    stored = t.orders.select("o_orderkey", S.watermark_to_json("o_orderdate").alias("stored"),
                             S.number_watermark_to_json("o_orderkey").alias("stored_number"))
    return stored.withColumns({"restored": S.watermark_from_json("stored", "timestamp_ntz"),
                               "restored_number": S.watermark_from_json("stored_number", "bigint")})


@query("rows_per_second", """
    SELECT run_id, round(run_id / greatest(elapsed_seconds, 1.0), 1) AS rows_per_second FROM s_runs""")
def _(t):
    return SI.runs(t).select("run_id", S.rows_per_second("run_id", "elapsed_seconds").alias("rows_per_second"))
