"""Flattened and normalised API pages."""

from pyspark.sql import functions as F

from tidemerge.functions.scalars import variant_at
from tidemerge.operators import normalize as N
from tidemerge.queries import stand_ins as SI
from tidemerge.queries.base import query, stamp_sql
from tidemerge.sources.pages import CONTACT_PAGE, envelopes, over_all_cores, page_faults, page_rejects

_MSG_TIME = "TIMESTAMP '2024-01-01 00:00:00' + to_seconds(conv_id * 3600 + turn * 60)"


def _messages(t):
    return N.flatten_messages(envelopes(over_all_cores(SI.message_pages(t))))


def _statuses(t):
    return N.flatten_statuses(envelopes(over_all_cores(SI.status_pages(t))))


def _contacts(t):
    return N.flatten_contacts(envelopes(over_all_cores(SI.contact_pages(t)), shape=CONTACT_PAGE))


@query("flatten_messages", """
    SELECT conv_id || '-' || turn AS id, 'Name ' || conv_id AS contact_profile_name, text AS body FROM conversations""")
def _(t):
    return _messages(t).select(variant_at("message", "$.id").alias("id"), "contact_profile_name",
                               variant_at("message", "$.text.body").alias("body"))


@query("flatten_statuses", """
    SELECT 'm' || event_id AS id, 'u' || user_id AS recipient_id FROM events""")
def _(t):
    return _statuses(t).select(variant_at("status", "$.id").alias("id"), variant_at("status", "$.recipient_id").alias("recipient_id"))


@query("flatten_contacts", """
    SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS name FROM customer""")
def _(t):
    return _contacts(t).select(variant_at("contact", "$.id").alias("id"),
                               variant_at("contact", "$.details.whatsapp_profile_name").alias("name"))


@query("normalize_messages", f"""
    SELECT 'export_messages' AS source, 'run-1' AS source_run_id, conv_id || '-' || turn AS turn_message_id,
           CASE WHEN role = 'user' THEN conv_id ELSE turn END AS number_id, 'w' || conv_id AS contact_wa_id,
           'Name ' || conv_id AS contact_profile_name, 'chat-' || conv_id AS chat_uuid, 'w' || conv_id AS contact_uuid,
           CASE WHEN role = 'user' THEN 'inbound' ELSE 'outbound' END AS direction, 'text' AS message_type, role AS author_id,
           CASE WHEN role = 'assistant' THEN 'Bot' END AS author_name, 'OWNER' AS author_type,
           {stamp_sql(f"{_MSG_TIME} + CASE WHEN role = 'assistant' THEN INTERVAL 5 MILLISECOND ELSE INTERVAL 0 SECOND END")} AS message_timestamp,
           {stamp_sql(_MSG_TIME)} AS turn_inserted_at, CASE WHEN role = 'assistant' THEN 'read' END AS last_status,
           CASE WHEN role = 'assistant' THEN {stamp_sql(f"{_MSG_TIME} + INTERVAL 9 SECOND")} END AS last_status_timestamp,
           CASE WHEN role = 'assistant' THEN '["faq"]' ELSE '[]' END AS labels, text AS body
    FROM conversations WHERE length(text) >= 100""")
def _(t):
    rows = N.normalize_messages(_messages(t), "run-1")
    return rows.withColumn("body", F.get_json_object("payload", "$.message.text.body")) \
               .drop("payload", "payload_hash", "source_delivery_id")


_STATUS_TIME = """CASE event_type WHEN 'click' THEN date_trunc('second', ts) WHEN 'view' THEN date_trunc('millisecond', ts) ELSE ts END"""


# the record as canonical JSON: members sorted, no blanks, no null members
_STATUS_NAME = "CASE event_type WHEN 'signup' THEN 'sent' WHEN 'view' THEN 'delivered' WHEN 'click' THEN 'read' ELSE 'failed' END"
_STATUS_STAMP = """CASE event_type WHEN 'view' THEN CAST(epoch_us(ts) // 1000 AS VARCHAR) WHEN 'click' THEN CAST(epoch_us(ts) // 1000000 AS VARCHAR)
                        ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END"""
_STATUS_JSON = f"""'{{' || CASE WHEN event_type = 'purchase' THEN '' ELSE '"conversation":{{"id":"u' || user_id || '","origin":{{"type":"' || event_type || '"}}}},' END
    || '"id":"m' || event_id || '","pricing":{{"billable":' || CASE WHEN value > 50 THEN 'true' ELSE 'false' END
    || ',"category":"service","pricing_model":"CBP","type":"regular"}},"recipient_id":"u' || user_id || '","status":"' || {_STATUS_NAME}
    || '","timestamp":"' || {_STATUS_STAMP} || '"}}'"""


@query("normalize_statuses", f"""
    SELECT sha256('{{"message_id":"m' || event_id || '","recipient_id":"u' || user_id || '","status":"' || {_STATUS_NAME}
                  || '","timestamp":"' || {_STATUS_STAMP} || '"}}') AS status_event_key,
           {_STATUS_JSON} AS payload, sha256({_STATUS_JSON}) AS payload_hash,
           'export_statuses' AS source, 'run-1' AS source_run_id, 'm' || event_id AS turn_message_id,
           'm' || event_id AS status_event_id, 'u' || user_id AS recipient_wa_id,
           CASE WHEN event_type <> 'purchase' THEN 'u' || user_id END AS conversation_id,
           CASE WHEN event_type <> 'purchase' THEN event_type END AS conversation_origin_type,
           CASE event_type WHEN 'signup' THEN 'sent' WHEN 'view' THEN 'delivered' WHEN 'click' THEN 'read' ELSE 'failed' END AS status,
           {stamp_sql(_STATUS_TIME)} AS status_timestamp, 'service' AS pricing_category, 'regular' AS pricing_type,
           'CBP' AS pricing_model, value > 50 AS billable
    FROM events WHERE event_type <> 'error' AND value <= 200""")
def _(t):
    return N.normalize_statuses(_statuses(t), "run-1").drop("source_delivery_id")


_CONTACT_JSON = """'{' || CASE WHEN c_mktsegment <> 'BUILDING' THEN '"details":{"opted_in":' || (c_acctbal > 1000) || ',"whatsapp_id":"w' || c_custkey
        || '","whatsapp_profile_name":"' || c_name || '"},' ELSE '' END
    || '"id":"' || c_custkey || '","inserted_at":"' || strftime(TIMESTAMP '2024-01-01' - to_seconds(c_custkey), '%Y-%m-%d %H:%M:%S')
    || '","number_id":"' || c_custkey || '","updated_at":' || (1704067200 + c_custkey) || '}'"""


@query("normalize_contacts", f"""
    SELECT {_CONTACT_JSON} AS payload, sha256({_CONTACT_JSON}) AS payload_hash, 'export_contacts' AS source, 'run-1' AS source_run_id, CAST(c_custkey AS VARCHAR) AS turn_contact_id,
           c_custkey AS number_id, CASE WHEN c_mktsegment <> 'BUILDING' THEN 'w' || c_custkey END AS whatsapp_id,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS whatsapp_profile_name,
           {stamp_sql("TIMESTAMP '2024-01-01' - to_seconds(c_custkey)")} AS turn_inserted_at,
           {stamp_sql("TIMESTAMP '2024-01-01' + to_seconds(c_custkey)")} AS turn_updated_at,
           CASE WHEN c_mktsegment = 'BUILDING' THEN '{{}}' ELSE '{{"opted_in":' || (c_acctbal > 1000) || ',"whatsapp_id":"w' || c_custkey
                || '","whatsapp_profile_name":"' || c_name || '"}}' END AS details
    FROM customer WHERE c_acctbal >= 0""")
def _(t):
    return N.normalize_contacts(_contacts(t), "run-1")


@query("reject_report", """
    SELECT 'messages' AS entity_type, COUNT(*) AS rows_read, COUNT(*) FILTER (WHERE length(text) >= 100) AS rows_valid,
           CAST(0 AS BIGINT) AS missing_id, COUNT(*) FILTER (WHERE length(text) < 100) AS bad_timestamp,
           CAST(0 AS BIGINT) AS missing_status FROM conversations
    UNION ALL SELECT 'statuses', COUNT(*), COUNT(*) FILTER (WHERE event_type <> 'error' AND value <= 200), 0,
                     COUNT(*) FILTER (WHERE value > 200), COUNT(*) FILTER (WHERE event_type = 'error') FROM events
    UNION ALL SELECT 'contacts', COUNT(*), COUNT(*) FILTER (WHERE c_acctbal >= 0), 0, COUNT(*) FILTER (WHERE c_acctbal < 0), 0
              FROM customer""")
def _(t):
    parts = [N.rejects(rows(t), entity).select(F.lit(entity).alias("entity_type"), "*")
             for entity, rows in (("messages", _messages), ("statuses", _statuses), ("contacts", _contacts))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _spoilt(t):
    """Status and contact pages: cut short (errors, overdrawn customers), with a repeated member (signups), with a text as record (views)."""
    kind, value = F.col("event_type"), F.col("value")
    pages = SI.status_pages(t, "event_type").select(
        F.when(kind == "error", F.expr("left(value, length(value) div 2)"))
        .when(kind == "signup", F.regexp_replace(value, '"id":', '"id":"twice","id":'))
        .when(kind == "view", '{"data":[{"statuses":["no object"]}],"paging":{}}').otherwise(value).alias("value"))
    people = SI.contact_pages(t, "c_acctbal").select(
        F.when(F.col("c_acctbal") < 0, F.expr("left(value, length(value) - 2)")).otherwise(value).alias("value"))
    return pages, people


@query("page_fault_report", """
    SELECT 'statuses' AS entity_type, COUNT(*) AS pages_read,
           COUNT(*) FILTER (WHERE event_type IN ('error', 'signup')) AS bad_pages,
           COUNT(*) FILTER (WHERE event_type NOT IN ('error', 'signup')) AS records_read,
           COUNT(*) FILTER (WHERE event_type = 'view') AS not_object FROM events
    UNION ALL SELECT 'contacts', COUNT(*), COUNT(*) FILTER (WHERE c_acctbal < 0), COUNT(*) FILTER (WHERE c_acctbal >= 0), 0
              FROM customer""")
def _(t):
    """Broken are pages cut short and those with a repeated member."""
    pages, people = _spoilt(t)
    return (page_faults(pages, "statuses").select(F.lit("statuses").alias("entity_type"), "*")
            .unionByName(page_faults(people, None, shape=CONTACT_PAGE).select(F.lit("contacts").alias("entity_type"), "*")))


@query("page_reject_report", """
    SELECT 'statuses' AS entity_type, COUNT(*) AS pages_read, COUNT(*) FILTER (WHERE event_type = 'error') AS pages_without_rows,
           COUNT(*) FILTER (WHERE event_type <> 'error') AS records_read, COUNT(*) FILTER (WHERE event_type = 'view') AS records_rejected
    FROM events
    UNION ALL SELECT 'contacts', COUNT(*), COUNT(*) FILTER (WHERE c_acctbal < 0), COUNT(*) FILTER (WHERE c_acctbal >= 0), 0
              FROM customer""")
def _(t):
    """Records that are no objects are left out alone; of repeated members the last counts."""
    pages, people = _spoilt(t)
    return (page_rejects(pages, "statuses").select(F.lit("statuses").alias("entity_type"), "*")
            .unionByName(page_rejects(people, None, shape=CONTACT_PAGE).select(F.lit("contacts").alias("entity_type"), "*")))


@query("read_spoilt_pages", """
    SELECT 'm' || event_id AS id, CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS rejected_beside FROM events WHERE event_type <> 'error'""")
def _(t):
    """Pages with a bad record beside a good one, or with a repeated member, keep their good records."""
    kind, value = F.col("event_type"), F.col("value")
    pages = SI.status_pages(t, "event_type").select("event_type", (
        F.when(kind == "error", F.expr("left(value, length(value) div 2)"))
        .when(kind == "signup", F.regexp_replace(value, '"id":"m', '"id":"twice","id":"m'))
        .when(kind == "view", F.replace(value, F.lit('"statuses":['), F.lit('"statuses":["no object",'))).otherwise(value)).alias("value"))
    rows = N.flatten_statuses(envelopes(pages))
    return rows.select(variant_at("status", "$.id").alias("id"), (kind == "view").cast("int").alias("rejected_beside"))
