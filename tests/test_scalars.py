"""Case tables of the column functions."""

import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidemerge.functions import scalars as S
from tidemerge.types import schema_from_source

UTC = dt.timezone.utc


def one(spark, column):
    return spark.range(1).select(column.alias("x")).collect()[0].x


def as_utc(spark, column):
    text = one(spark, F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return text


@pytest.mark.parametrize("raw, want", [
    (None, None), ("", None), ("   ", None), ("garbage", None), ("2024", "1970-01-01 00:33:44.000000"),
    ("1704067200", "2024-01-01 00:00:00.000000"), ("1704067200123", "2024-01-01 00:00:00.123000"),
    ("2024-01-01T00:00:00Z", "2024-01-01 00:00:00.000000"), ("2024-01-01 02:00:00+02:00", "2024-01-01 00:00:00.000000"),
    ("2024-01-01T05:06:07.25", "2024-01-01 05:06:07.250000"), ("2024-01-01", "2024-01-01 00:00:00.000000"),
    (" 2024-01-01T00:00:00Z ", "2024-01-01 00:00:00.000000"), (" 1704067200", None), ("-5", None),
    ("1000000000000", None), ("1000000000001", "2001-09-09 01:46:40.001000"), ("99999999999999999999", None),
    ("2024-13-01", None), ("2024-01-01T25:00:00Z", None), ("0", "1970-01-01 00:00:00.000000"),
])
def test_parse_event_time(spark, raw, want):
    assert as_utc(spark, S.parse_event_time(F.lit(raw).cast("string"))) == want


@pytest.mark.parametrize("literal, want", [
    ("1704067200", "2024-01-01 00:00:00.000000"), ("1704067200.9", "2024-01-01 00:00:00.000000"),
    ('"1704067200.9"', None), ('"1704067200"', "2024-01-01 00:00:00.000000"), ("null", None), ('""', None),
    ("true", None), ("{}", None), ('"2024-01-01T00:00:00+01:00"', "2023-12-31 23:00:00.000000"), ("1e300", None),
])
def test_json_time(spark, literal, want):
    df = spark.range(1).select(F.parse_json(F.lit(literal)).alias("v"))
    df = df.select(S.text_of(F.col("v")).alias("t"), S.kind_of(F.col("v")).alias("k"))
    df = df.withColumn("n", S.epoch_number(F.col("t"), F.col("k")))
    got = df.select(F.date_format(S.json_time(F.col("t"), F.col("k"), F.col("n")), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    assert got.collect()[0][0] == want


@pytest.mark.parametrize("literal, want", [
    ('""', None), ("0", None), ("0.0", None), ("false", None), ("[]", None), ("{}", None), ("null", None),
    ('"0"', "0"), ('"false"', "false"), ("7", "7"), ("true", "true"), ('"x"', "x"), ('[1]', "[1]"), ("-0.0", None),
])
def test_truthy(spark, literal, want):
    v = F.parse_json(F.lit(literal))
    assert one(spark, S.truthy(S.text_of(v), S.kind_of(v))) == want


@pytest.mark.parametrize("literal, want", [
    ("3.7", 3), ('"3.7"', None), ('" 12 "', 12), ('"abc"', None), ('""', None), ("null", None), ("-4.9", -4), ("12", 12)])
def test_json_bigint(spark, literal, want):
    v = F.parse_json(F.lit(literal))
    assert one(spark, S.json_bigint(S.text_of(v), S.kind_of(v))) == want


@pytest.mark.parametrize("raw, want", [("", None), (" 12 ", 12), ("3.7", None), ("abc", None), (None, None),
                                       ("9223372036854775808", None), ("-7", -7)])
def test_safe_bigint(spark, raw, want):
    assert one(spark, S.safe_bigint(F.lit(raw).cast("string"))) == want


def test_first_present(spark):
    v = F.parse_json(F.lit('{"a":"","b":{"c":0},"d":false,"e":5,"n":null}'))
    assert one(spark, S.first_present(v, "$.a", "$.b.c")) == "0"
    assert one(spark, S.first_present(v, "$.n", "$.d")) == "false"
    assert one(spark, S.first_present(v, "$.e.x", "$.zzz")) is None  # a path through a non-object
    assert one(spark, S.first_present(v, "$.e.x", "$.e")) == "5"


def test_payload_hash_ignores_member_order(spark):
    a = one(spark, S.payload_hash(F.lit('{"b":1, "a":{"y":2,"x":null}}')))
    b = one(spark, S.payload_hash(F.lit('{"a":{"x":null,"y":2},"b":1}')))
    c = one(spark, S.payload_hash(F.lit('{"a":{"x":null,"y":3},"b":1}')))
    assert a == b != c
    want = hashlib.sha256(json.dumps({"a": {"x": None, "y": 2}, "b": 1}, separators=(",", ":")).encode()).hexdigest()
    assert a == want
    assert one(spark, S.payload_hash(F.lit("{bad"))) is None


def test_status_key_tells_types_and_nulls_apart(spark):
    def key(ts):
        v = F.parse_json(F.lit(ts))
        return one(spark, S.status_key(F.lit("m"), F.lit("read"), v, F.lit(None).cast("string")))
    assert key("1") != key('"1"') and key("1") == key("1") and key("null") != key("0")


@pytest.mark.parametrize("direction, to, sender, rid, want", [
    ("outbound", "t", "f", "r", "t"), ("outbound", "", "f", "r", "r"), ("inbound", "t", "f", "r", "f"),
    (None, "t", "f", "r", "f"), ("inbound", "t", None, "r", "r"), ("outbound", None, "f", None, None)])
def test_contact_id(spark, direction, to, sender, rid, want):
    cols = [F.lit(x).cast("string") for x in (direction, to, sender, rid)]
    assert one(spark, S.contact_id(*cols)) == want


def test_small_functions(spark):
    ts = F.lit("2024-01-01 00:00:00.999999").cast("timestamp")
    assert one(spark, S.format_iso_utc(ts)) == "2024-01-01T00:00:00Z"
    assert one(spark, S.rows_per_second(F.lit(500), F.lit(0.2))) == 500.0
    assert one(spark, S.rows_per_second(F.lit(7), F.lit(2))) == 3.5
    assert one(spark, S.qualified(F.lit("a"), F.lit("b"), F.lit("c"))) == "a.b.c"
    assert one(spark, S.qualified(F.lit("a"), F.lit(None).cast("string"))) is None
    assert one(spark, S.minutes_since(ts, "2024-01-01 00:30:00.999999")) == 30.0
    assert one(spark, S.labels_or_empty(F.parse_json(F.lit("null")))) == "[]"
    assert one(spark, S.labels_or_empty(F.parse_json(F.lit('["a"]')))) == '["a"]'


@pytest.mark.parametrize("stored, kind, want", [
    ('"2024-01-01T12:00:00+00:00"', "timestamp", "2024-01-01 12:00:00"), ('"2024-01-01 12:00:00"', "timestamp", "2024-01-01 12:00:00"),
    ("2024-01-01T12:00:00Z", "timestamp", "2024-01-01 12:00:00"), ("null", "timestamp", None), (None, "timestamp", None),
    ('""', "timestamp", None), ("42", "bigint", "42"), ('"2024-01-01T12:00:00+02:00"', "timestamp", "2024-01-01 10:00:00")])
def test_watermark_from_json(spark, stored, kind, want):
    got = S.watermark_from_json(F.lit(stored).cast("string"), kind)
    text = F.date_format(got, "yyyy-MM-dd HH:mm:ss") if kind == "timestamp" else got.cast("string")
    assert one(spark, text) == want


def test_coerce_row(spark):
    df = spark.sql("""SELECT named_struct('a', 1, 'b', CAST(NULL AS STRING)) AS s, array(1, NULL) AS l,
                      CAST(NULL AS STRUCT<x: INT>) AS n, CAST(1.5 AS DECIMAL(5, 1)) AS d, parse_json('{"k": [1]}') AS v""")
    r = S.coerce_row(df).collect()[0]
    assert (r.s, r.l, r.n, r.v) == ('{"a":1,"b":null}', "[1,null]", None, '{"k":[1]}')
    assert str(r.d) == "1.500000000" and S.coerce_row(df, "double").collect()[0].d == 1.5


def test_source_types():
    fields = [("id", "INT64", "REQUIRED"), ("s", "STRING", "NULLABLE"), ("n", "NUMERIC", "NULLABLE"),
              ("bn", "BIGNUMERIC", "NULLABLE"), ("r", "RECORD", "NULLABLE"), ("l", "STRING", "REPEATED"),
              ("d", "DATETIME", "NULLABLE"), ("t", "TIME", "NULLABLE"), ("u", "INTERVAL", "NULLABLE"), ("b", "BOOL", "NULLABLE")]
    schema = schema_from_source(fields)
    kinds = {f.name: f.dataType.simpleString() for f in schema}
    assert kinds == {"id": "bigint", "s": "string", "n": "decimal(38,9)", "bn": "string", "r": "variant", "l": "variant",
                     "d": "timestamp_ntz", "t": "string", "u": "string", "b": "boolean", "_loaded_at": "timestamp"}
    assert not schema["id"].nullable and schema["s"].nullable and not schema["_loaded_at"].nullable
