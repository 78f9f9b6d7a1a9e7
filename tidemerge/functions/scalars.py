"""Column functions. Everything here is a built-in expression and stays inside codegen stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: numbers above this are epoch milliseconds, others are seconds
MILLIS_ABOVE = 1_000_000_000_000
# first second of year 10000, where times stop being representable as four-digit years
_LAST_SECOND = 253_402_300_800
_ISO = (r"^\d{4}-\d{2}-\d{2}"
        r"([T ]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_instant(value) -> Column:
    """A timestamp column from a column, ISO text or datetime, read as UTC when it carries no zone."""
    return (value if isinstance(value, Column) else F.lit(value)).cast("timestamp")


# ---------------------------------------------------------------- coercion

def to_json_text(c: Column | str) -> Column:
    """Nested value as JSON text that keeps null members; null stays null."""
    return F.to_json(_col(c), {"ignoreNullFields": "false"})


def decimal_value(c: Column | str, mode: str = "keep") -> Column:
    """``keep`` gives DECIMAL(38,9); ``double`` gives the lossy float form."""
    return _col(c).cast("double" if mode == "double" else "decimal(38,9)")


def coerce_row(df: DataFrame, decimals: str = "keep") -> DataFrame:
    """Apply the text-sink coercions to every column according to its type."""
    out = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            c = to_json_text(c)
        elif isinstance(field.dataType, T.VariantType):
            c = F.to_json(c)
        elif isinstance(field.dataType, T.DecimalType):
            c = decimal_value(c, decimals)
        out.append(c.alias(field.name))
    return df.select(*out)


# ---------------------------------------------------------------- times

def epoch_time(number: Column) -> Column:
    """Epoch seconds, or milliseconds above 10^12; NULL when the year would leave 1..9999."""
    n = number.cast("bigint")
    fits = n < F.when(n > MILLIS_ABOVE, _LAST_SECOND * 1000).otherwise(_LAST_SECOND)
    millis = F.when(n > MILLIS_ABOVE, n).otherwise(n * 1000)
    return F.when(fits & (n > -62_135_596_800), F.timestamp_millis(F.when(fits, millis)))


def parse_event_time(c: Column | str) -> Column:
    """Digits are an epoch, ISO text is parsed as UTC unless it has an offset, the rest is NULL."""
    text = _col(c).cast("string")
    trimmed = F.trim(text)
    number = F.when(text.rlike("^[0-9]{1,18}$"), text).try_cast("bigint")
    iso = F.when(trimmed.rlike(_ISO), trimmed).try_cast("timestamp")
    return F.when(text.rlike("^[0-9]+$"), epoch_time(number)).otherwise(iso)


def format_iso_utc(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def minutes_since(c: Column | str, as_of) -> Column:
    return (F.unix_micros(as_instant(as_of)) - F.unix_micros(_col(c).cast("timestamp"))) / F.lit(6e7)


# ---------------------------------------------------------------- variants

def variant_at(v: Column | str, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(_col(v), path, kind)


def members(v: Column | str, shape: str) -> Column:
    """Several members of a JSON object in one pass, as a struct; NULL when it is not an object.

    Far cheaper than one path lookup per member. A member of another kind than asked for is NULL.
    """
    return F.try_variant_get(_col(v), "$", shape)


def evaluated_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns through a one-element generator. Filters are not pushed through it, so costly
    expressions are not repeated by whatever is built on them."""
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def is_json_object(v: Column | str) -> Column:
    return members(v, "struct<id: variant>").isNotNull()


def text_of(leaf: Column) -> Column:
    """Text of a variant value; JSON null becomes NULL."""
    return F.try_variant_get(leaf, "$", "string")


def present_text(*leaves: Column) -> Column:
    """Text of the first value that is neither null nor ''; 0 and false count as present."""
    return F.coalesce(*[F.nullif(text_of(leaf), F.lit("")) for leaf in leaves])


def first_present(v: Column | str, *paths: str) -> Column:
    """``present_text`` of the values at these paths."""
    return present_text(*[variant_at(v, p, "variant") for p in paths])


def kind_of(leaf: Column) -> Column:
    """JSON type name of a variant value: STRING, BIGINT, DECIMAL(..), DOUBLE, BOOLEAN, VOID, ..."""
    return F.schema_of_variant(leaf)


# The functions below take the text and the kind of a value as plain columns, so that both are
# computed once however often they are used.

def truthy(text: Column, kind: Column) -> Column:
    """The text, with the falsy JSON values ('', 0, false, [], {}) taken as absent."""
    falsy = F.when(kind == "STRING", text == "").otherwise(text.rlike(r"^(false|\[\]|\{\}|-?0(\.0*)?(E.*)?)$"))
    return F.when(~falsy, text)


def epoch_number(text: Column, kind: Column) -> Column:
    """The epoch in a value, if it is one: a JSON number (fraction cut) or text of digits."""
    numeric = (kind != "STRING") | text.rlike("^[0-9]{1,18}$")
    return F.when(numeric, text).try_cast("double").try_cast("bigint")


def json_time(text: Column, kind: Column, number: Column) -> Column:
    """Event time of a value with its ``epoch_number``; text that is no epoch is read as ISO time."""
    trimmed = F.trim(text)
    iso = F.when((kind == "STRING") & trimmed.rlike(_ISO), trimmed).try_cast("timestamp")
    return F.when(number.isNotNull(), epoch_time(number)).otherwise(iso)


def json_bigint(text: Column, kind: Column) -> Column:
    """Integer of a value: numbers lose their fraction, text must be a whole number."""
    return F.when(kind == "STRING", text.try_cast("bigint")).otherwise(text.try_cast("decimal(38,9)").try_cast("bigint"))


def labels_or_empty(leaf: Column) -> Column:
    """JSON text of the labels, ``[]`` when they are absent or empty."""
    return F.coalesce(F.when(truthy(text_of(leaf), kind_of(leaf)).isNotNull(), F.to_json(leaf)), F.lit("[]"))


# ---------------------------------------------------------------- keys and numbers

def payload_hash(c: Column | str) -> Column:
    """SHA-256 of JSON text with sorted keys, so member order does not matter; NULL for bad JSON."""
    return F.sha2(F.to_json(F.try_parse_json(_col(c))), 256)


def status_key(message_id: Column, status: Column, timestamp: Column, recipient_id: Column) -> Column:
    """Identity of one delivery status. Variant members keep their JSON type in the digest."""
    fields = F.struct(message_id.alias("message_id"), recipient_id.alias("recipient_id"),
                      status.alias("status"), timestamp.alias("timestamp"))
    return F.sha2(to_json_text(fields), 256)


def contact_id(direction: Column, to: Column, sender: Column, recipient_id: Column) -> Column:
    """The other party: the addressee of an outbound message, else the sender."""
    party = F.when(direction == "outbound", F.nullif(to, F.lit(""))).otherwise(F.nullif(sender, F.lit("")))
    return F.coalesce(party, recipient_id)


def safe_bigint(c: Column | str) -> Column:
    return _col(c).try_cast("bigint")


def qualified(*parts: Column | str) -> Column:
    """Dotted identifier; NULL when any part is."""
    dotted = [_col(parts[0])]
    for part in parts[1:]:
        dotted += [F.lit("."), _col(part)]
    return F.concat(*dotted)


def rows_per_second(rows: Column | str, elapsed: Column | str) -> Column:
    return F.round(_col(rows) / F.greatest(_col(elapsed).cast("double"), F.lit(1.0)), 1)


# ---------------------------------------------------------------- stored watermarks

def watermark_to_json(c: Column | str) -> Column:
    """JSON text of a watermark: a quoted ISO string for times, a bare literal for numbers."""
    c = _col(c)
    iso = F.date_format(c.try_cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.lit('"'), iso, F.lit('"'))


def number_watermark_to_json(c: Column | str) -> Column:
    return _col(c).cast("bigint").cast("string")


def watermark_text(c: Column | str) -> Column:
    """The bare value inside stored JSON text; JSON null and blank become NULL."""
    return F.nullif(F.nullif(F.trim(F.translate(_col(c), '"', "")), F.lit("null")), F.lit(""))


def watermark_from_json(c: Column | str, kind: str = "timestamp") -> Column:
    """The stored value as ``kind``; a time with an offset is moved to UTC before the offset is dropped."""
    if kind == "timestamp_ntz":
        return watermark_text(c).try_cast("timestamp").cast("timestamp_ntz")
    return watermark_text(c).try_cast(kind)


def watermark_number(c: Column | str) -> Column:
    """The stored value if it is a number, else NULL; quoted values are times, even if only a year."""
    bare = F.when(~F.startswith(F.trim(_col(c)), F.lit('"')), watermark_text(c))
    return bare.try_cast("decimal(38,9)")


def watermark_rank(c: Column | str) -> Column:
    """What stored watermarks of one column are compared by: numbers as numbers, all others as instants."""
    return F.struct(watermark_number(c).alias("number"), watermark_from_json(c).alias("time"))


def watermark_json(c: Column, kind: str) -> Column:
    """JSON text of a watermark of a source column of the given type."""
    return number_watermark_to_json(c) if kind in ("tinyint", "smallint", "int", "bigint") else \
        c.cast("string") if kind.startswith("decimal") or kind in ("float", "double") else watermark_to_json(c)


def normal_watermark(c: Column | str) -> Column:
    """The same stored watermark in this library's form; what is neither number nor time stays as it is."""
    return F.when(watermark_number(c).isNotNull(), watermark_text(c)).otherwise(
        F.coalesce(watermark_to_json(watermark_from_json(c)), _col(c)))


def mode_and_flags(state: DataFrame, keep: list[str] = ("table_key",)) -> DataFrame:
    """Load mode, dates, readable totals and shortened error per synced table."""
    return state.select(
        *keep,
        F.col("last_synced_at").cast("date").alias("last_synced"),
        F.when(F.col("historical_completed_at").isNull(), "historical").otherwise("incremental").alias("mode"),
        F.col("historical_completed_at").cast("date").alias("hist_done"),
        F.col("historical_completed_at").isNotNull().alias("historical_done"),
        F.format_number(F.col("total_rows_synced"), 0).alias("total_rows"),
        F.left(F.col("error_message"), F.lit(60)).alias("last_error"),
    )
