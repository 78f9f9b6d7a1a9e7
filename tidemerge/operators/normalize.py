"""Nested page records to typed rows. Narrow transformations only: no shuffle, no Python.

Each record is opened once: one expression lifts all members that matter into a struct, their texts
and JSON kinds follow, and the typed columns are computed from those. Every step stands behind a
one-element generator (``evaluated_once``): Spark then neither repeats a costly step inside the
filters on its result nor fuses all of them into one method too large for the JIT compiler.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemerge.functions import scalars as S
from tidemerge.settings import ENTITIES

# --- fixed values: members read from each kind of record
MESSAGE_MEMBERS = (
    "struct<id: variant, timestamp: variant, from: variant, to: variant, recipient_id: variant, type: variant, "
    "number_id: variant, _vnd: struct<v1: struct<number: struct<id: variant>, "
    "chat: struct<uuid: variant, contact_uuid: variant>, direction: variant, "
    "author: struct<id: variant, name: variant, type: variant>, inserted_at: variant, last_status: variant, "
    "last_status_timestamp: variant, labels: variant>>>"
)
STATUS_MEMBERS = (
    "struct<id: variant, status: variant, timestamp: variant, recipient_id: variant, "
    "conversation: struct<id: variant, origin: struct<type: variant>>, "
    "pricing: struct<category: variant, type: variant, pricing_model: variant, billable: variant>>"
)
CONTACT_MEMBERS = (
    "struct<id: variant, number_id: variant, inserted_at: variant, updated_at: variant, details: variant>"
)
DETAIL_MEMBERS = "struct<whatsapp_id: variant, whatsapp_profile_name: variant>"
PROFILE_MEMBERS = "struct<wa_id: string, profile: struct<name: string>>"
PARTY_MEMBERS = "struct<from: variant, to: variant, recipient_id: variant>"



def _texts(leaves: dict[str, Column], typed: list[str], prefix: str = "") -> dict[str, Column]:
    """Text columns of variant values, and ``<name>_kind`` for those whose JSON type matters."""
    out = {f"{prefix}{n}": S.text_of(leaf) for n, leaf in leaves.items()}
    return out | {f"{prefix}{n}_kind": S.kind_of(leaves[n]) for n in typed}


def _truthy(name: str) -> Column:
    return S.truthy(F.col(name), F.col(f"{name}_kind"))


def _present(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def _numbers(names: list[str]) -> dict[str, Column]:
    return {f"{n}_number": S.epoch_number(F.col(n), F.col(f"{n}_kind")) for n in names}


def _time(name: str) -> Column:
    return S.json_time(F.col(name), F.col(f"{name}_kind"), F.col(f"{name}_number"))


# ---------------------------------------------------------------- pages to records

def _records(envelopes: DataFrame, field: str, name: str, *carry: str) -> DataFrame:
    kept = [c for c in envelopes.columns if c != "envelope"]
    extra = [F.col(f"envelope.{c}").alias(c) for c in carry]
    rows = envelopes.select(*kept, *extra, F.explode_outer(f"envelope.{field}").alias(name))
    return rows.where(S.is_json_object(name))


def flatten_messages(envelopes: DataFrame) -> DataFrame:
    """One row per message object with the profile name found in its own envelope.

    The last contact with the id wins; a message without any id matches contacts without one.
    """
    # contacts are opened once for each envelope, before its messages part
    named = F.transform("envelope.contacts", lambda c: S.members(c, PROFILE_MEMBERS))
    rows = _records(S.evaluated_once(envelopes, _known=named), "messages", "message")
    rows = S.evaluated_once(rows, _who=S.members("message", PARTY_MEMBERS))
    rows = S.evaluated_once(rows, **_texts({n: F.col(f"_who.{n}") for n in ("from", "to", "recipient_id")}, ["from", "to"], "_"))
    rows = S.evaluated_once(rows, _party=F.coalesce(_truthy("_from"), _truthy("_to"), F.col("_recipient_id")))
    hits = F.filter("_known", lambda c: c.isNotNull() & c["wa_id"].eqNullSafe(F.col("_party")))
    name = F.try_element_at(hits, F.lit(-1))["profile"]["name"]
    kept = [c for c in envelopes.columns if c != "envelope"]
    return rows.select(*kept, "message", name.alias("contact_profile_name"))


def flatten_statuses(envelopes: DataFrame) -> DataFrame:
    return _records(envelopes, "statuses", "status")


def flatten_contacts(items: DataFrame) -> DataFrame:
    return items.withColumnRenamed("envelope", "contact").where(S.is_json_object("contact"))


# ---------------------------------------------------------------- records to typed rows

def normalize_messages(messages: DataFrame, run_id: str, source: str = ENTITIES["messages"]["source"]) -> DataFrame:
    """Typed message rows; records without an id or a readable time are left out."""
    wrapped = F.to_json(F.struct("contact_profile_name", "message"), {"ignoreNullFields": "false"})
    m, v = F.col("m"), F.col("m")["_vnd"]["v1"]
    leaves = {
        "id": m["id"], "sent_at": m["timestamp"], "to": m["to"], "from": m["from"], "recipient": m["recipient_id"],
        "kind": m["type"], "vendor_number": v["number"]["id"], "plain_number": m["number_id"],
        "chat_uuid": v["chat"]["uuid"], "contact_uuid": v["chat"]["contact_uuid"], "direction": v["direction"],
        "author_id": v["author"]["id"], "author_name": v["author"]["name"], "author_type": v["author"]["type"],
        "inserted_at": v["inserted_at"], "last_status": v["last_status"], "last_at": v["last_status_timestamp"]}
    times = ["sent_at", "inserted_at", "last_at"]
    rows = S.evaluated_once(messages.select("message", "contact_profile_name"),
                            m=S.members("message", MESSAGE_MEMBERS), payload=wrapped)
    rows = S.evaluated_once(rows, labels=S.labels_or_empty(v["labels"]), payload_hash=F.sha2("payload", 256),
                            **_texts(leaves, ["id", "vendor_number", "plain_number", *times], "f_"))
    rows = S.evaluated_once(rows, **_numbers([f"f_{t}" for t in times]), f_side=_present("f_direction"))
    number = F.when(_present("f_vendor_number").isNotNull(), S.json_bigint(F.col("f_vendor_number"), F.col("f_vendor_number_kind"))) \
        .otherwise(S.json_bigint(F.col("f_plain_number"), F.col("f_plain_number_kind")))
    rows = S.evaluated_once(
        rows, turn_message_id=_truthy("f_id"), number_id=number,
        contact_wa_id=S.contact_id(F.col("f_side"), F.col("f_to"), F.col("f_from"), F.col("f_recipient")),
        message_timestamp=_time("f_sent_at"), turn_inserted_at=_time("f_inserted_at"),
        last_status_timestamp=_time("f_last_at"))
    return rows.where("turn_message_id is not null and message_timestamp is not null").select(
        F.lit(source).alias("source"), F.lit(None).cast("string").alias("source_delivery_id"),
        F.lit(run_id).alias("source_run_id"), "turn_message_id", "number_id", "contact_wa_id", "contact_profile_name",
        _present("f_chat_uuid").alias("chat_uuid"), _present("f_contact_uuid").alias("contact_uuid"),
        F.col("f_side").alias("direction"), F.col("f_kind").alias("message_type"),
        _present("f_author_id").alias("author_id"), _present("f_author_name").alias("author_name"),
        _present("f_author_type").alias("author_type"), "message_timestamp", "turn_inserted_at",
        _present("f_last_status").alias("last_status"), "last_status_timestamp", "labels", "payload", "payload_hash")


def normalize_statuses(statuses: DataFrame, run_id: str, source: str = ENTITIES["statuses"]["source"]) -> DataFrame:
    """Typed status rows; records without an id, a status or a readable time are left out."""
    s = F.col("s")
    leaves = {
        "id": s["id"], "state": s["status"], "at": s["timestamp"], "recipient": s["recipient_id"],
        "conversation": s["conversation"]["id"], "origin": s["conversation"]["origin"]["type"],
        "category": s["pricing"]["category"], "price_type": s["pricing"]["type"], "model": s["pricing"]["pricing_model"]}
    rows = S.evaluated_once(statuses.select("status"), s=S.members("status", STATUS_MEMBERS), payload=F.to_json("status"))
    rows = S.evaluated_once(
        rows, status_event_key=S.status_key(s["id"], s["status"], s["timestamp"], s["recipient_id"]),
        billable=F.try_variant_get(s["pricing"]["billable"], "$", "boolean"),
        payload_hash=F.sha2("payload", 256), **_texts(leaves, ["id", "state", "at"], "f_"))
    rows = S.evaluated_once(rows, **_numbers(["f_at"]), turn_message_id=_truthy("f_id"), known=_truthy("f_state"))
    rows = S.evaluated_once(rows, status_timestamp=_time("f_at"))
    return rows.where("turn_message_id is not null and known is not null and status_timestamp is not null").select(
        F.lit(source).alias("source"), F.lit(None).cast("string").alias("source_delivery_id"),
        F.lit(run_id).alias("source_run_id"), "turn_message_id", F.col("turn_message_id").alias("status_event_id"),
        "status_event_key", F.col("f_recipient").alias("recipient_wa_id"),
        _present("f_conversation").alias("conversation_id"), _present("f_origin").alias("conversation_origin_type"),
        F.col("known").alias("status"), "status_timestamp", _present("f_category").alias("pricing_category"),
        _present("f_price_type").alias("pricing_type"), _present("f_model").alias("pricing_model"),
        "billable", "payload", "payload_hash")


def normalize_contacts(contacts: DataFrame, run_id: str, source: str = ENTITIES["contacts"]["source"]) -> DataFrame:
    """Typed contact snapshots; records without an id or a readable update time are left out."""
    c, d = F.col("c"), F.col("d")
    leaves = {"id": c["id"], "number": c["number_id"], "inserted_at": c["inserted_at"], "updated_at": c["updated_at"],
              "details": c["details"], "whatsapp_id": d["whatsapp_id"], "name": d["whatsapp_profile_name"]}
    times = ["f_inserted_at", "f_updated_at"]
    rows = S.evaluated_once(contacts.select("contact"), c=S.members("contact", CONTACT_MEMBERS), payload=F.to_json("contact"))
    rows = S.evaluated_once(rows, d=S.members(c["details"], DETAIL_MEMBERS), payload_hash=F.sha2("payload", 256))
    rows = S.evaluated_once(rows, **_texts(leaves, ["id", "number", "inserted_at", "updated_at", "details"], "f_"))
    rows = S.evaluated_once(rows, **_numbers(times), turn_contact_id=_truthy("f_id"))
    details = F.when(_truthy("f_details").isNotNull(), F.to_json(c["details"]))
    rows = S.evaluated_once(
        rows, turn_inserted_at=_time("f_inserted_at"), turn_updated_at=_time("f_updated_at"),
        details=F.coalesce(details, F.lit("{}")), number_id=S.json_bigint(F.col("f_number"), F.col("f_number_kind")))
    return rows.where("turn_contact_id is not null and turn_updated_at is not null").select(
        F.lit(source).alias("source"), F.lit(run_id).alias("source_run_id"), "turn_contact_id", "number_id",
        F.col("f_whatsapp_id").alias("whatsapp_id"), F.col("f_name").alias("whatsapp_profile_name"),
        "turn_inserted_at", "turn_updated_at", "details", "payload", "payload_hash")


# --- fixed values: members a record must have, per entity: record column, id, time, other
REQUIRED = {
    "messages": ("message", "id", "timestamp", None),
    "statuses": ("status", "id", "timestamp", "status"),
    "contacts": ("contact", "id", "updated_at", None),
}


def rejects(records: DataFrame, entity: str) -> DataFrame:
    """Counts of records kept and left out, by reason, in one pass. A record may have several reasons."""
    record, key, time, other = REQUIRED[entity]
    needed = [n for n in (key, time, other) if n]
    rows = S.evaluated_once(records.select(record), r=S.members(record, f"struct<{', '.join(f'{n}: variant' for n in needed)}>"))
    rows = S.evaluated_once(rows, **_texts({n: F.col(f"r.{n}") for n in needed}, needed, "f_"))
    rows = S.evaluated_once(rows, **_numbers([f"f_{time}"]))
    flags = rows.select(
        _truthy(f"f_{key}").isNull().alias("no_key"), _time(f"f_{time}").isNull().alias("no_time"),
        (_truthy(f"f_{other}").isNull() if other else F.lit(False)).alias("no_other"))
    return flags.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~(F.col("no_key") | F.col("no_time") | F.col("no_other"))).alias("rows_valid"),
        F.count_if("no_key").alias("missing_id"), F.count_if("no_time").alias("bad_timestamp"),
        F.count_if("no_other").alias("missing_status"))
