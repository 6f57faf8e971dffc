"""What the physical plans must and must not contain."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("LEDGERLENS_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry.library_queries()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")

# Nested-loop joins emit all pairs, Python nodes leave the JVM.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow", "MapPartitions", "ExternalRDD")


def plan(spark, name: str) -> str:
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairs_no_python_no_single_task_window(spark, name):
    text = plan(spark, name)
    assert [node for node in FORBIDDEN if node in text] == []
    # What meets in one task must be partial aggregates, one row per task.
    for below in re.findall(r"Exchange SinglePartition[^\n]*\n([^\n]*)", text):
        assert re.search(r"Aggregate\(keys?=\[\]", below), below


@pytest.mark.parametrize("name", ["stage_dedupe", "state_as_of", "prune_changelog", "customer_fraud_360", "high_risk_fraud", "join_sample"])
def test_ranking_is_cut_on_both_sides_of_the_shuffle(spark, name):
    text = plan(spark, name)
    assert re.search(r"WindowGroupLimit[^\n]*Final", text) and re.search(r"WindowGroupLimit[^\n]*Partial", text)


@pytest.mark.parametrize("name", ["high_risk_fraud", "pep_high_fraud"])
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_only_alerts_of_watched_accounts_are_ranked(spark, name, broadcast):
    """Also where the join is shuffled, an account's alerts are cut before the shuffle of the ranking."""
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        text = plan(spark, name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    final, partial = re.search(r"WindowGroupLimit[^\n]*Final", text).end(), re.search(r"WindowGroupLimit[^\n]*Partial", text).start()
    assert "Exchange hashpartitioning(account_id" in text[final:partial]
    assert "LeftSemi" in text[partial:].split("events.parquet")[0] and "LeftSemi" not in text[:partial]


def test_master_is_read_once_for_all_sources(spark):
    """One scan for the match rates; the report adds one for the master's own checks and one or two for each analysis."""
    scan = r"Scan parquet[^\n]*customer\.parquet"
    assert len(re.findall(scan, plan(spark, "match_rate_events"))) == 1
    assert len(re.findall(scan, plan(spark, "quality_report"))) <= 5


@pytest.mark.parametrize("name", ["top_customers", "risk_exposure", "channel_comparison", "match_rate_events", "fraud_by_city", "attribute_agreement"])
def test_events_are_aggregated_before_the_join(spark, name):
    """Every scan of events lies below a partial aggregate and its shuffle, whatever is joined above."""
    text = plan(spark, name)
    for path in re.split(r"\n(?=[^\n]*(?:Join|Union))", text):
        if "events.parquet" in path:
            assert "partial_count" in path.split("events.parquet")[0]


@pytest.mark.parametrize(
    "name,columns",
    [
        ("fraud_by_type", {"ts", "event_type", "props"}),
        ("top_merchant_categories", {"ts", "event_type", "props", "value"}),
        ("payments_daily", {"l_orderkey", "l_suppkey", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"}),
        ("key_uniqueness", {"c_custkey", "c_nationkey"}),
    ],
)
def test_scans_read_only_what_is_used(spark, name, columns):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", QUERIES[name](spark, SF_DIR)._jdf.queryExecution().explainString(mode(spark)))
    read = {field.split(":")[0] for schema in schemas for field in schema.split(",")}
    assert columns <= read and not read & ({"event_id", "user_id", "l_partkey", "l_quantity", "l_tax", "c_name", "c_acctbal"} - columns)


def mode(spark):
    return spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")


def test_time_bounds_reach_the_scan(spark):
    text = QUERIES["fraud_by_type"](spark, SF_DIR)._jdf.queryExecution().explainString(mode(spark))
    assert re.search(r"PushedFilters:.*EqualTo\(event_type,error\).*GreaterThanOrEqual\(ts,2023-12-31T00:00\)", text)
