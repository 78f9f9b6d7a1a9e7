"""Source-to-Spark type map and the column lists of the normalised and control tables."""

from __future__ import annotations

from pyspark.sql import types as T

from tidemerge.settings import LOADED_AT

# --- fixed values: source type name -> Spark type text. A type missing here is kept as text.
SOURCE_TYPES = {
    "STRING": "string",
    "BYTES": "binary",
    "INTEGER": "bigint",
    "INT64": "bigint",
    "FLOAT": "double",
    "FLOAT64": "double",
    "NUMERIC": "decimal(38,9)",
    "BIGNUMERIC": "string",
    "BOOLEAN": "boolean",
    "BOOL": "boolean",
    "TIMESTAMP": "timestamp",
    "DATE": "date",
    "TIME": "string",
    "DATETIME": "timestamp_ntz",
    "GEOGRAPHY": "string",
    "RECORD": "variant",
    "STRUCT": "variant",
    "JSON": "variant",
}

# --- fixed values: columns of the three normalised tables
MESSAGES_RAW = (
    "source string, source_delivery_id string, source_run_id string, turn_message_id string, "
    "number_id bigint, contact_wa_id string, contact_profile_name string, chat_uuid string, "
    "contact_uuid string, direction string, message_type string, author_id string, "
    "author_name string, author_type string, message_timestamp timestamp, "
    "turn_inserted_at timestamp, last_status string, last_status_timestamp timestamp, "
    "labels string, payload string, payload_hash string"
)
STATUSES_RAW = (
    "source string, source_delivery_id string, source_run_id string, turn_message_id string, "
    "status_event_id string, status_event_key string, recipient_wa_id string, "
    "conversation_id string, conversation_origin_type string, status string, "
    "status_timestamp timestamp, pricing_category string, pricing_type string, "
    "pricing_model string, billable boolean, payload string, payload_hash string"
)
CONTACTS_RAW = (
    "source string, source_run_id string, turn_contact_id string, number_id bigint, "
    "whatsapp_id string, whatsapp_profile_name string, turn_inserted_at timestamp, "
    "turn_updated_at timestamp, details string, payload string, payload_hash string"
)
# keys of the three tables; the selective column leads, which makes sorting by key cheaper
MESSAGE_KEYS = ["turn_message_id", "source"]
STATUS_KEYS = ["status_event_key", "source"]
CONTACT_KEYS = ["turn_contact_id", "turn_updated_at", "payload_hash", "source"]


def source_type(name: str, mode: str = "NULLABLE") -> str:
    """Spark type text of one source field; a repeated field is JSON whatever its element is."""
    return "variant" if mode == "REPEATED" else SOURCE_TYPES.get(name.upper(), "string")


def schema_from_source(fields: list[tuple[str, str, str]], keys: list[str] = ()) -> T.StructType:
    """Target schema from (name, source type, mode) triples, with the lineage column at the end."""
    out = T.StructType()
    for name, kind, mode in fields:
        required = mode == "REQUIRED" or name in keys
        out.add(T.StructField(name, T.DataType.fromDDL(source_type(name=kind, mode=mode)), not required))
    return out.add(LOADED_AT, T.TimestampType(), False)


def target_type(kind: T.DataType) -> T.DataType:
    """Type a Spark column takes in a target table: narrow numbers widen, nesting becomes JSON text."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return T.LongType()
    if isinstance(kind, T.FloatType):
        return T.DoubleType()
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(38, 9) if kind.scale <= 9 and kind.precision - kind.scale <= 29 else T.StringType()
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return T.StringType()
    return kind
