"""What the plans must and must not contain."""

import re

import pytest

from tidemerge.operators import merge as M
from tidemerge.queries import QUERIES
from tidemerge.queries import stand_ins as SI

STREAMS = {n for n in QUERIES if n.startswith(("stream_", "dataset_", "published_"))} | {"publish_view"}  # run on build
# ordered reports of one row for each day, pipeline or table: numbered in one task
NUMBERED = {"card_pipeline_freshness", "card_ingestion_trend", "card_contact_snapshots", "sync_state_list", "transfer_freshness",
            "sync_status_report"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STREAMS])
def test_no_cross_join_no_python_no_single_task_window(spark, folder, name):
    plan = plan_of(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "ArrowEval" not in plan and "MapInPandas" not in plan
    if name not in NUMBERED and "Window [" in plan and "Exchange SinglePartition" in plan:
        assert "TakeOrderedAndProject" in plan or "GlobalLimit" in plan or re.search(r"Window .*\], \[[a-z]", plan)


@pytest.mark.parametrize("name, filters, columns", [
    ("scan_time_range", ["GreaterThanOrEqual(o_orderdate", "LessThan(o_orderdate"], "o_orderkey:bigint,o_orderdate:timestamp_ntz"),
    ("scan_since_watermark", ["GreaterThan(ts"], "event_id:bigint,ts:timestamp_ntz"),
    ("source_row_count", ["GreaterThanOrEqual(l_shipdate"], "l_shipdate:timestamp_ntz"),
    ("sample_window_rows", ["GreaterThanOrEqual(o_orderdate", "LessThan(l_shipdate"], None),
    ("view_sanity_trend_30d", ["GreaterThanOrEqual(o_orderdate", "GreaterThanOrEqual(l_shipdate"], None)])
def test_pushdown(spark, folder, name, filters, columns):
    plan = plan_of(QUERIES[name](spark, folder))
    pushed = " ".join(re.findall(r"PushedFilters: \[[^\]]*\]?", plan))
    assert all(f in pushed for f in filters), pushed
    if columns:
        assert f"ReadSchema: struct<{columns}>" in plan


def test_dedupe_limits_groups_before_the_shuffle(tables):
    plan = plan_of(M.dedupe(SI.merge_batch(tables), SI.MERGE_KEYS, SI.MERGE_ORDER))
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan


def test_insert_only_reads_only_target_keys(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = SI.merge_batch(tables).where("amount > 50000")
        plan = plan_of(M.new_rows(target, SI.merge_batch(tables), SI.MERGE_KEYS, SI.MERGE_ORDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double>" in plan
    assert plan.count("Exchange hashpartitioning") == 2  # the ranked batch keeps its partitioning for the join


def test_hot_groups_are_reduced_before_they_travel(tables):
    from tidemerge.operators import quality as Q
    from tidemerge.operators import views as V
    for df in (V.message_volume_daily(SI.messages(tables)), Q.reconcile_keys(SI.merge_batch(tables), SI.merge_target(tables), SI.MERGE_KEYS),
               M.fold_batch(SI.merge_batch(tables), SI.MERGE_KEYS, ["status"], SI.MERGE_ORDER)):
        assert "partial_" in plan_of(df)
    days = V.status_funnel_daily(SI.messages(tables), SI.statuses(tables))
    assert "Expand" not in plan_of(days)  # no row multiplication for the distinct counts


def test_records_are_opened_once(tables):
    from tidemerge.queries.normalized import _statuses
    from tidemerge.operators.normalize import normalize_statuses
    plan = plan_of(normalize_statuses(_statuses(tables), "r"))
    assert plan.count("parseJson") == 1
    assert plan.count("StructsToJsonEvaluator(Map(),VariantType") == 1
