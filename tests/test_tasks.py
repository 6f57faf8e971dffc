"""Large joins and groupings: what one task holds does not grow with the input."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerlens.operators import tasks
from ledgerlens.plans.activity import payments_daily
from ledgerlens.sources.driver_tables import DriverTables
from tests.comparison import connect, differences

SF_DIR = os.environ.get("LEDGERLENS_SF_DIR", "/root/testdata/sf0.001")
BULK = ["idempotency_check", "payments_daily", "rollup_lookback", "top_customers_bulk"]

needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture
def few_rows(spark, monkeypatch):
    """A task's share so small that the line items ask for three times the session's cores."""
    rows = DriverTables(spark, SF_DIR).raw("lineitem").count()
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(tasks, "ROWS_PER_TASK", rows // (3 * cores) + 1)
    return tasks.ROWS_PER_TASK


@needs_data
@pytest.mark.parametrize("name", BULK)
def test_dealt_queries_equal_sql(spark, few_rows, name):
    with connect(SF_DIR) as connection:
        assert differences(entry.library_queries()[name](spark, SF_DIR), connection, entry.library_oracle_sql()[name]) is None


@needs_data
def test_groups_of_one_task_are_bounded(spark, few_rows):
    t = DriverTables(spark, SF_DIR)
    per_task = payments_daily(t.payments_bulk, t.bulk_tasks).groupBy(F.spark_partition_id()).count()
    assert per_task.agg(F.max("count")).first()[0] < 2 * few_rows


@needs_data
@pytest.mark.parametrize("name", BULK)
def test_plan_deals_by_row_count(spark, few_rows, name):
    plan = entry.library_queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    n = DriverTables(spark, SF_DIR).bulk_tasks
    groupings = 0 if name == "top_customers_bulk" else 1  # that one groups by account, which combines before the shuffle
    assert n > spark.sparkContext.defaultParallelism
    assert plan.count(f", {n}), REPARTITION_BY_NUM") == 2 + groupings
    if groupings:
        dealt = [line for line in plan.splitlines() if "hashpartitioning(event_date" in line]
        assert len(dealt) == 1 and f", {n}), REPARTITION_BY_NUM" in dealt[0]


def test_few_rows_are_not_dealt(spark):
    df = spark.range(100)
    assert tasks.tasks_for(df) is None
    assert tasks.dealt(df, None, "id") is df


def test_tasks_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(tasks, "ROWS_PER_TASK", 10)
    assert [tasks.tasks_for(spark.range(n)) for n in (80, 1_000, 6_001)] == [None, 100, 601]
