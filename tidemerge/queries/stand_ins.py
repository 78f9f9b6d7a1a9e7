"""The input tables in the roles of messages, statuses, contacts, runs, state and API pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemerge.operators.state import empty_state, fold_runs
from tidemerge.plans.chunks import tier_for_rows
from tidemerge.queries.base import Tables
from tidemerge.queries.stand_in_sql import CALENDAR_SHIFT_DAYS

_EPOCH = 1_704_067_200  # 2024-01-01 in seconds


def messages(t: Tables) -> DataFrame:
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM")
    return t.orders.select(
        F.col("o_orderkey").alias("turn_message_id"), F.col("o_custkey").alias("contact_wa_id"),
        F.col("o_orderstatus").alias("message_type"), F.col("o_orderdate").alias("message_timestamp"),
        F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("amount"),
        F.when(urgent, "outbound").otherwise("inbound").alias("direction"))


def faulty(t: Tables) -> DataFrame:
    """Messages with some null keys, null types and blank directions."""
    m = messages(t)
    partly = F.col("message_type") == "P"
    return m.select(
        F.when(~((F.col("priority") == "4-NOT SPECIFIED") & partly), F.col("turn_message_id")).alias("turn_message_id"),
        "contact_wa_id", "message_timestamp", "priority",
        F.when(~((F.col("priority") == "1-URGENT") & (F.col("amount") > 400000)), F.col("message_type"))
        .alias("message_type"),
        F.when((F.col("priority") == "5-LOW") & partly, " ").otherwise(F.col("direction")).alias("direction"))


def redelivered(t: Tables) -> DataFrame:
    """All messages, the urgent ones a second time."""
    m = faulty(t)
    return m.unionAll(m.where("priority = '1-URGENT'"))


def statuses(t: Tables) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    status = (F.when((F.col("l_linestatus") == "F") & returned, "failed").when(returned, "read")
              .when(F.col("l_returnflag") == "A", "delivered").otherwise("sent"))
    return t.lineitem.select(
        F.col("l_orderkey").alias("turn_message_id"), F.col("l_linenumber").cast("bigint").alias("seq"),
        F.col("l_shipdate").alias("status_timestamp"), F.col("l_suppkey").alias("recipient_id"), status.alias("status"))


def contacts(t: Tables) -> DataFrame:
    orders, customers = t.orders.select("o_custkey", "o_orderdate"), t.customer.withColumnRenamed("c_custkey", "o_custkey")
    return orders.join(customers, "o_custkey").select(
        F.col("o_custkey").alias("turn_contact_id"), F.col("o_orderdate").alias("turn_updated_at"),
        F.col("c_name").alias("whatsapp_profile_name"), F.col("c_mktsegment").alias("segment"),
        (F.col("c_mktsegment") == "MACHINERY").alias("opted_in"), (F.col("c_acctbal") > 0).alias("onboarded"))


def webhooks(t: Tables) -> DataFrame:
    return t.events.select("event_id", (F.col("ts") - F.make_dt_interval(F.lit(CALENDAR_SHIFT_DAYS))).alias("received_at"))


def runs(t: Tables) -> DataFrame:
    kind, failed = F.col("event_type"), F.col("event_type") == "error"
    whole = F.floor("value").cast("bigint")
    return t.events.select(
        F.col("event_id").alias("run_id"), F.concat(F.lit("ds.t"), F.col("user_id")).alias("table_key"),
        kind.alias("job"),
        F.when(kind.isin("signup", "view"), "messages").when(kind == "click", "statuses").otherwise("contacts")
        .alias("entity_type"),
        F.col("ts").alias("started_at"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), whole)).alias("finished_at"),
        F.col("value").alias("elapsed_seconds"), F.when(failed, 0).otherwise(whole).alias("rows_transferred"),
        F.when(failed, 0).otherwise(F.floor(F.col("value") / 2).cast("bigint")).alias("rows_written"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("bytes_scanned"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, F.concat(F.lit("boom "), F.col("props"))).alias("error_message"),
        F.when(kind == "signup", "historical").otherwise("incremental").alias("run_type"),
        F.when(~failed, F.col("ts")).alias("watermark_end"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("window_start"), F.col("ts").alias("window_end"),
        (F.col("value") < 200).alias("count_match"))


def shifted_runs(t: Tables) -> DataFrame:
    return runs(t).withColumn("started_at", F.col("started_at") - F.make_dt_interval(F.lit(CALENDAR_SHIFT_DAYS)))


def state(t: Tables) -> DataFrame:
    """Sync state folded from the runs; a table completed its history if it started over more often
    than it failed. The size estimate gives the tier."""
    r = runs(t)
    folded = fold_runs(empty_state(t.spark), r, "proj", policy="last_run").drop("historical_completed_at")
    signup = F.col("job") == "signup"
    done = r.groupBy("table_key").agg(F.when(
        F.count_if(signup) > F.count_if(F.col("job") == "error"), F.max(F.when(signup, F.col("started_at"))),
    ).alias("historical_completed_at"))
    size = F.col("rows_synced_last_run") * 60000
    return folded.join(done, "table_key").withColumns({"size_rows": size, "size_tier": tier_for_rows(size)})


def last_runs(t: Tables) -> DataFrame:
    r = runs(t)
    rest = [c for c in r.columns if c != "table_key"]
    return r.groupBy("table_key").agg(F.max_by(F.struct(*rest), F.struct("started_at", "run_id")).alias("r")) \
            .select("table_key", "r.*")


def cursors(t: Tables) -> DataFrame:
    return last_runs(t).select(F.col("table_key").alias("pipeline_name"), "entity_type",
                               F.col("watermark_end").alias("last_cursor_at"))


def pipeline_runs(t: Tables) -> DataFrame:
    return runs(t).select(F.col("table_key").alias("pipeline_name"), "run_id", "entity_type", "window_start",
                          "window_end", "finished_at", F.col("rows_transferred").alias("rows_seen"), "rows_written",
                          "status")


def merge_target(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("message_id"), F.substring("o_orderpriority", 1, 1).cast("bigint").alias("seq"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("ts"))


def merge_batch(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("message_id"), F.col("l_linenumber").cast("bigint").alias("seq"),
        F.col("l_linestatus").alias("status"), F.col("l_extendedprice").alias("amount"),
        F.col("l_shipdate").alias("ts"))


MERGE_KEYS = ["message_id", "seq"]
MERGE_ORDER = ["ts", "status", "amount"]


# ---------------------------------------------------------------- API pages, built as JSON text

def _page(item: Column) -> Column:
    return F.to_json(F.struct(F.array(item).alias("data"), F.struct(F.lit(None).cast("string").alias("next")).alias("paging")))


def message_pages(t: Tables) -> DataFrame:
    """One page per conversation turn. Turns of users come in, the others go out; short texts have a
    blank time."""
    role, party = F.col("role"), F.concat(F.lit("w"), F.col("conv_id"))
    user, assistant = role == "user", role == "assistant"
    seconds = F.lit(_EPOCH) + F.col("conv_id") * 3600 + F.col("turn") * 60
    iso = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    when = (F.when(F.length("text") < 100, "").when(user, seconds.cast("string"))
            .when(assistant, (seconds * 1000 + 5).cast("string")).otherwise(iso))
    vendor = F.struct(F.struct(
        F.when(user, F.struct(F.col("conv_id").alias("id"))).alias("number"),
        F.struct(F.concat(F.lit("chat-"), F.col("conv_id")).alias("uuid"), party.alias("contact_uuid")).alias("chat"),
        F.when(user, "inbound").otherwise("outbound").alias("direction"),
        F.struct(role.alias("id"), F.when(assistant, "Bot").otherwise("").alias("name"), F.lit("OWNER").alias("type")).alias("author"),
        iso.alias("inserted_at"), F.when(assistant, "read").alias("last_status"),
        F.when(assistant, seconds + 9).alias("last_status_timestamp"),
        F.when(assistant, F.array(F.lit("faq"))).when(user, F.array().cast("array<string>")).alias("labels"),
    ).alias("v1"))
    message = F.struct(
        F.concat_ws("-", "conv_id", "turn").alias("id"), when.alias("timestamp"),
        F.when(user, party).alias("from"), F.when(assistant, party).alias("to"),
        F.when(~user & ~assistant, party).alias("recipient_id"),
        F.when(~user, F.concat(F.lit(" "), F.col("turn"))).alias("number_id"), F.lit("text").alias("type"),
        F.struct(F.col("text").alias("body")).alias("text"), vendor.alias("_vnd"))

    def contact(name):
        return F.struct(party.alias("wa_id"), F.struct(name.alias("name")).alias("profile"))

    envelope = F.struct(F.array(contact(F.lit("old name")), contact(F.concat(F.lit("Name "), F.col("conv_id")))).alias("contacts"),
                        F.array(message).alias("messages"))
    return t.conversations.select(_page(envelope).alias("value"))


def status_pages(t: Tables, *carry: str) -> DataFrame:
    """One page per event; errors carry no status, high values a blank time."""
    kind, who = F.col("event_type"), F.concat(F.lit("u"), F.col("user_id"))
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    when = (F.when(F.col("value") > 200, "").when(kind == "view", F.floor(micros / 1000).cast("string"))
            .when(kind == "click", F.floor(micros / 1000000).cast("string"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")))
    status = (F.when(kind == "signup", "sent").when(kind == "view", "delivered").when(kind == "click", "read")
              .when(kind == "purchase", "failed"))
    item = F.struct(
        F.concat(F.lit("m"), F.col("event_id")).alias("id"), status.alias("status"), when.alias("timestamp"),
        who.alias("recipient_id"),
        F.when(kind != "purchase", F.struct(who.alias("id"), F.struct(kind.alias("type")).alias("origin"))).alias("conversation"),
        F.struct(F.lit("service").alias("category"), F.lit("regular").alias("type"), F.lit("CBP").alias("pricing_model"),
                 (F.col("value") > 50).alias("billable")).alias("pricing"))
    return t.events.select(*carry, _page(F.struct(F.array(item).alias("statuses"))).alias("value"))


def contact_pages(t: Tables, *carry: str) -> DataFrame:
    """One page per customer; overdrawn ones lack the update time, one segment has no details."""
    key = F.col("c_custkey")
    item = F.struct(
        key.cast("string").alias("id"), key.cast("string").alias("number_id"),
        F.when(F.col("c_acctbal") >= 0, F.lit(_EPOCH) + key).alias("updated_at"),
        F.date_format(F.timestamp_seconds(F.lit(_EPOCH) - key), "yyyy-MM-dd HH:mm:ss").alias("inserted_at"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.struct(
            F.concat(F.lit("w"), key).alias("whatsapp_id"), F.col("c_name").alias("whatsapp_profile_name"),
            (F.col("c_acctbal") > 1000).alias("opted_in"))).alias("details"))
    return t.customer.select(*carry, _page(item).alias("value"))
