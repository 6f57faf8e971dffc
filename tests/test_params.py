from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import pytest

from ledgerlens.functions import params
from tests.frames import payments


@pytest.mark.parametrize("value", [0, 1001, -5, "ten", "1.5", [], object()])
def test_limits_outside_the_range_are_refused(value):
    with pytest.raises(ValueError):
        params.asked_limit(value)


def test_defaults_and_bounds():
    assert params.row_limit() is None and params.asked_limit() is None
    assert params.row_limit(None, 20) == 20
    assert (params.asked_limit(1), params.asked_limit(1000), params.row_limit("7"), params.row_limit(5000)) == (1, 1000, 7, 5000)
    assert params.look_back_hours() == 24
    assert params.look_back_hours(8760) == 8760
    assert params.score_threshold() == 0.85
    assert params.score_threshold(0) == 0.0


@pytest.mark.parametrize("value", [0, 8761, "day"])
def test_hours_outside_the_range_are_refused(value):
    with pytest.raises(ValueError):
        params.look_back_hours(value)


@pytest.mark.parametrize("value", [-0.01, 1.01, "high", float("nan")])
def test_scores_outside_the_range_are_refused(value):
    with pytest.raises(ValueError):
        params.score_threshold(value)


def test_window_is_a_lower_bound_with_its_border_inside(spark):
    df = payments(
        spark,
        [
            ("early", "A", "01 11:59:59", 1.0, "POS", "APPROVED"),
            ("border", "A", "01 12:00:00", 1.0, "POS", "APPROVED"),
            ("future", "A", "03 00:00:00", 1.0, "POS", "APPROVED"),
        ],
    )
    as_of = datetime(2024, 5, 2, 12)
    assert {r.event_id for r in params.since(df, as_of, 24).collect()} == {"border", "future"}
    bangkok = as_of.replace(tzinfo=timezone.utc).astimezone(timezone(timedelta(hours=7)))
    assert {r.event_id for r in params.since(df, bangkok, 24).collect()} == {"border", "future"}
    assert {r.event_id for r in params.since_date(df, date(2024, 5, 2), 0).collect()} == {"future"}
    assert {r.event_id for r in params.on_day(df, date(2024, 5, 1)).collect()} == {"early", "border"}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_time_bound_reaches_the_scan_and_prunes_partitions(spark, tmp_path, kind):
    path = str(tmp_path / "p")
    df = payments(spark, [("a", "A", "01 10:00:00", 1.0, "POS", "X"), ("b", "A", "02 10:00:00", 1.0, "POS", "X")])
    df.withColumn("timestamp", df["timestamp"].cast(kind)).write.partitionBy("event_date").parquet(path)
    stored = spark.read.parquet(path)
    plan = params.since(stored, datetime(2024, 5, 2, 12), 12)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in plan
    assert "PartitionFilters: [isnotnull(event_date" in plan and ">= 2024-05-02" in plan
    assert "cast(timestamp" not in plan
