from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import history as h
from ledgerlens.sources.tables import append, ensure_table, partition_stats, read_table


def log(spark, data):
    return spark.createDataFrame([(k, v, datetime(2024, 1, d)) for k, v, d in data], "k string, v int, changed_at timestamp")


def pairs(df):
    return sorted((r.k, r.v) for r in df.collect())


DATA = [("a", 1, 1), ("a", 2, 5), ("a", 3, 9), ("b", 4, 3), ("b", 5, 3)]


def test_state_as_of(spark):
    df = log(spark, DATA)
    assert pairs(h.state_as_of(df, ["k"], datetime(2024, 1, 5))) == [("a", 2), ("b", 5)]
    assert pairs(h.state_as_of(df, ["k"], datetime(2024, 1, 4, 23))) == [("a", 1), ("b", 5)]
    assert pairs(h.state_as_of(df, ["k"], datetime(2023, 1, 1))) == []


def test_commit_history(spark):
    got = {r.changed_at.day: (r.rows_committed, r.keys_touched, r.rows_superseded) for r in h.commit_history(log(spark, DATA), ["k"]).collect()}
    assert got == {1: (1, 1, 0), 5: (1, 1, 0), 9: (1, 1, 0), 3: (2, 1, 1)}


@pytest.mark.parametrize("seed,keep", [(0, 1), (1, 2), (2, 5), (3, 50)])
def test_retention_against_brute_force(spark, seed, keep):
    rng = random.Random(seed)
    # Half of the rows belong to one key, some have none.
    data = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), i, rng.randint(1, 28)) for i in range(120)]
    bound = 20
    expected = []
    for key in {k for k, *_ in data}:
        versions = sorted((d for d in data if d[0] == key), key=lambda d: (d[2], d[1]), reverse=True)
        expected += [(v[0], v[1]) for i, v in enumerate(versions) if i < keep or v[2] >= bound]
    kept = h.prune_changelog(log(spark, data), ["k"], datetime(2024, 1, bound), keep, tie_break=["v"])
    assert sorted(((r.k, r.v) for r in kept.collect()), key=str) == sorted(expected, key=str)
    with pytest.raises(ValueError):
        h.prune_changelog(log(spark, data), ["k"], datetime(2024, 1, bound), 0)


def test_compaction_rewrites_only_the_selected_partitions(spark):
    table = ensure_table(spark, "hist.small_files", {"v": "int", "d": "date"}, ["d"])
    for v in range(5):
        append(spark.sql(f"SELECT {v} AS v, explode(array(DATE'2024-01-01', DATE'2024-01-02')) AS d").repartition(2), table)
    before = {str(r.d): r for r in partition_stats(spark.table(table), ["d"]).collect()}
    assert all(r.record_count == 5 and r.file_count == 5 and r.total_bytes > 0 for r in before.values())
    h.compact(spark, table, ["d"], F.col("d") == F.lit("2024-01-02").cast("date"))
    after = {str(r.d): (r.record_count, r.file_count) for r in partition_stats(read_table(spark, table), ["d"]).collect()}
    assert after == {"2024-01-01": (5, 5), "2024-01-02": (5, 1)}
    assert sorted(r.v for r in spark.table(table).filter("d = DATE'2024-01-02'").collect()) == list(range(5))
    h.compact(spark, table, ["d"])
    assert {r.file_count for r in partition_stats(spark.table(table), ["d"]).collect()} == {1}


def links(df):
    return sorted((str(r.k), r.v, r.valid_from, r.valid_to) for r in df.collect())


def linked_by_hand(data):
    """Versions (key, value, day) in order, each with the day of the next one of its key."""
    out = []
    for k, v, d in data:
        later = sorted((x[2], x[1]) for x in data if x[0] == k and x[2] is not None and d is not None and (x[2], x[1]) > (d, v))
        valid = d is not None and k is not None
        out.append((str(k), v, datetime(2024, 1, d) if valid else None, datetime(2024, 1, later[0][0]) if valid and later else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(4))
def test_intervals_against_brute_force(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), i, rng.choice([None, *range(1, 29)])) for i in range(150)]
    schema = "k string, v int, changed_at timestamp"
    whole = spark.createDataFrame([(k, v, d and datetime(2024, 1, d)) for k, v, d in data], schema)
    history = h.intervals(whole, ["k"], tie_break=["v"], bucket="week")
    assert sorted(links(history), key=str) == linked_by_hand(data)
    for day in (1, 9, 15, 28):
        moment = datetime(2024, 1, day)
        assert pairs(h.state_in_intervals(history, moment)) == pairs(h.state_as_of(whole, ["k"], moment, tie_break=["v"]))
    some = rng.randint(1, 140)
    for first, second in ((F.col("v") < some, F.col("v") >= some), (F.col("v") >= some, F.col("v") < some), (F.col("v") % 3 == 0, F.col("v") % 3 != 0), (F.lit(False), F.lit(True)), (F.lit(True), F.lit(False))):
        known = h.intervals(whole.filter(first), ["k"], tie_break=["v"])
        grown = h.extend_intervals(known, whole.filter(second), ["k"], tie_break=["v"], bucket="day")
        assert sorted(links(grown), key=str) == linked_by_hand(data)


def test_a_stored_history_is_filtered_without_shuffle(spark, tmp_path):
    h.intervals(log(spark, DATA), ["k"], tie_break=["v"]).write.parquet(f"{tmp_path}/history")
    state = h.state_in_intervals(spark.read.parquet(f"{tmp_path}/history"), datetime(2024, 1, 5))
    assert pairs(state) == [("a", 2), ("b", 5)] and state.columns == ["k", "v", "changed_at"]
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "LessThanOrEqual(valid_from" in plan
