"""Page fixtures with odd records, row by row; loads of the results."""

import json

import pytest
from pyspark.sql import functions as F

from tidemerge.operators import load as L
from tidemerge.operators import normalize as N
from tidemerge.sources import CONTACT_PAGE, envelopes, read_pages
from tidemerge.types import CONTACTS_RAW, MESSAGES_RAW, STATUSES_RAW

MESSAGES = [{
    "contacts": [{"wa_id": "27", "profile": {"name": "Old"}}, {"wa_id": "27", "profile": {"name": "New"}},
                 {"profile": {"name": "Nobody"}}, 5, {"wa_id": "28", "profile": None}],
    "messages": [
        {"id": "m1", "timestamp": "1704067200", "from": "27", "type": "text", "text": {"body": "hé \"q\""}},
        {"id": "m2", "timestamp": 1704067200123, "to": "28", "number_id": "9", "_vnd": {"v1": {
            "direction": "outbound", "number": {"id": 3.9}, "chat": {"uuid": "c"}, "author": {"id": 0, "name": "", "type": "SYSTEM"},
            "inserted_at": "2024-01-01T01:00:00+01:00", "labels": ["x"], "last_status": "read",
            "last_status_timestamp": "2024-01-01 00:00:00"}}},
        {"id": "m3", "timestamp": "2024-01-01T00:00:00", "recipient_id": "30", "_vnd": "odd"},
        {"id": "m4", "timestamp": "2024-01-01"}, "not an object", None, 7,
        {"id": "", "timestamp": "1704067200"}, {"id": 0, "timestamp": "1704067200"}, {"id": "m5", "timestamp": " "}, {"id": "m6"},
        {"id": 77, "timestamp": "1704067200", "from": "27", "_vnd": {"v1": {"direction": "outbound", "labels": []}}},
    ]},
    {"contacts": None, "messages": None, "statuses": [{"id": "ignored"}]}]

STATUSES = [{"statuses": [
    {"status": "sent", "timestamp": "1704067200"}, {"id": "s1", "timestamp": "1704067200"},
    {"id": "s1", "status": "sent", "timestamp": "1704067200", "recipient_id": "27"},
    {"id": "s1", "status": "sent", "timestamp": "1704067200", "recipient_id": "27", "extra": 1},
    {"id": "s1", "status": "sent", "timestamp": 1704067200, "recipient_id": "27"},
    {"id": "s2", "status": "read", "timestamp": "1704067200500", "pricing": {"billable": False, "category": "", "pricing_model": "CBP"},
     "conversation": {"id": "c1", "origin": {"type": "user"}}},
    {"id": "s3", "status": "read", "timestamp": "2024-01-01T00:00:00Z", "conversation": "odd"},
    {"id": "s4", "status": "read", "timestamp": "2024-01-01T02:00:00+02:00"}, {"id": "s5", "status": "read", "timestamp": ""},
    {"id": "s6", "status": "read", "timestamp": "2024-01-01T00:00:00"}, "x"]}]

CONTACTS = [
    {"id": "c1", "number_id": "12", "updated_at": "2024-01-01T00:00:00Z", "details": None},
    {"id": "c1", "number_id": 12, "updated_at": "2024-01-02T00:00:00Z", "details": {"whatsapp_id": "27", "opted_in": True}},
    {"id": "c1", "number_id": 12, "updated_at": "2024-01-02T00:00:00Z", "details": {"whatsapp_id": "27", "opted_in": False}},
    {"id": "c1", "updated_at": "2024-01-02T00:00:00Z", "number_id": 12, "details": {"opted_in": False, "whatsapp_id": "27"}},
    {"id": "c2", "updated_at": None}, {"updated_at": "2024-01-01T00:00:00Z"}, [1], 5, None]


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("pages")
    for name, data in (("messages", MESSAGES), ("statuses", STATUSES), ("contacts", CONTACTS)):
        (root / f"{name}.json").write_text("\n".join(
            [json.dumps({"data": data, "paging": {"next": "abc"}}), json.dumps({"data": None}), "{broken", ""]))
    return lambda name: read_pages(spark, str(root / f"{name}.json"))


def test_messages(spark, pages):
    flat = N.flatten_messages(envelopes(pages("messages")))
    assert flat.count() == 9
    out = N.normalize_messages(flat, "run")
    assert out.schema.simpleString() == spark.createDataFrame([], MESSAGES_RAW).schema.simpleString()
    rows = {r.turn_message_id: r for r in out.withColumn("at", F.date_format("message_timestamp", "HH:mm:ss.SSS")).collect()}
    assert set(rows) == {"m1", "m2", "m3", "m4", "77"}
    m1, m2, m3, m4, m7 = (rows[k] for k in ("m1", "m2", "m3", "m4", "77"))
    assert (m1.contact_profile_name, m1.contact_wa_id, m1.direction, m1.labels, m1.number_id) == ("New", "27", None, "[]", None)
    assert json.loads(m1.payload)["message"]["text"]["body"] == "hé \"q\""
    assert (m2.contact_profile_name, m2.contact_wa_id, m2.number_id, m2.author_id, m2.author_name, m2.labels) == (
        None, "28", 3, "0", None, '["x"]')
    assert m2.at == "00:00:00.123" and m2.last_status == "read" and m2.turn_inserted_at is not None
    assert (m3.contact_wa_id, m3.contact_profile_name, m3.chat_uuid) == ("30", None, None)
    assert (m4.contact_wa_id, m4.contact_profile_name) == (None, "Nobody")  # no id on either side
    # the name is looked up by sender first, the stored id follows the direction
    assert (m7.contact_profile_name, m7.contact_wa_id) == ("New", None)
    r = N.rejects(flat, "messages").collect()[0]
    assert (r.rows_read, r.rows_valid, r.missing_id, r.bad_timestamp) == (9, 5, 2, 2)


def test_statuses(spark, pages):
    flat = N.flatten_statuses(envelopes(pages("statuses")))
    out = N.normalize_statuses(flat, "run")
    assert out.schema.simpleString() == spark.createDataFrame([], STATUSES_RAW).schema.simpleString()
    rows = out.collect()
    assert len(rows) == 7
    by = {}
    for r in rows:
        by.setdefault(r.turn_message_id, []).append(r)
    keys = [r.status_event_key for r in by["s1"]]
    assert len(set(keys)) == 2 and len(set(r.payload_hash for r in by["s1"])) == 3  # text and number times differ
    s2, s3, s4, s6 = by["s2"][0], by["s3"][0], by["s4"][0], by["s6"][0]
    assert (s2.billable, s2.pricing_category, s2.pricing_model, s2.conversation_origin_type) == (False, None, "CBP", "user")
    assert s3.conversation_id is None and s3.status_timestamp == s4.status_timestamp == s6.status_timestamp
    r = N.rejects(flat, "statuses").collect()[0]
    assert (r.rows_read, r.rows_valid, r.missing_id, r.bad_timestamp, r.missing_status) == (10, 7, 1, 1, 1)
    loaded = L.load_statuses(spark.createDataFrame([], STATUSES_RAW), out)
    assert loaded.count() == 6 and L.load_statuses(loaded, out).count() == 6


def test_contacts(spark, pages):
    flat = N.flatten_contacts(envelopes(pages("contacts"), shape=CONTACT_PAGE))
    assert flat.count() == 6
    out = N.normalize_contacts(flat, "run")
    assert out.schema.simpleString() == spark.createDataFrame([], CONTACTS_RAW).schema.simpleString()
    rows = out.collect()
    assert len(rows) == 4 and {r.number_id for r in rows} == {12}
    assert sorted({r.details for r in rows}) == ['{"opted_in":false,"whatsapp_id":"27"}', '{"opted_in":true,"whatsapp_id":"27"}', "{}"]
    loaded = L.load_contacts(spark.createDataFrame([], CONTACTS_RAW), out)
    assert loaded.count() == 3  # member order does not make a new snapshot
    r = N.rejects(flat, "contacts").collect()[0]
    assert (r.rows_read, r.rows_valid, r.missing_id, r.bad_timestamp) == (6, 4, 1, 1)


def test_a_bad_record_leaves_the_others_of_its_page_alone(spark):
    lines = ['{"data":[{"statuses":[{"id":"a","id":"b","n":12345678901234567890.5},7,"{\\"id\\":\\"text\\"}",null,{"id":"c"}]},"odd",{"messages":[]}]}',
             '{"data":[{"statuses":{"id":"no list"}}]}', '{"data":{"statuses":[]}}', '{"data":[', "", None, '{"data":[{"statuses":[{"id":"d"}],"statuses":[{"id":"e"}]}]}']
    pages = spark.createDataFrame([(x,) for x in lines], "value string")
    rows = N.flatten_statuses(envelopes(pages)).selectExpr("to_json(status) AS s").collect()
    assert sorted(r.s for r in rows) == ['{"id":"b","n":12345678901234567890.5}', '{"id":"c"}', '{"id":"e"}']
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == "false"
    from tidemerge.sources.pages import page_rejects
    assert tuple(page_rejects(pages, "statuses").first()) == (7, 4, 6, 3)
    people = spark.createDataFrame([('{"data":[{"id":"1"},5,{"id":"2"}]}',)], "value string")
    assert N.flatten_contacts(envelopes(people, shape=CONTACT_PAGE)).count() == 2
