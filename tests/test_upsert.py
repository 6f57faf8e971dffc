from __future__ import annotations

import random
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import upsert as u
from ledgerlens.session import list_folders, shared_dir
from ledgerlens.sources.tables import ensure_table

SCHEMA = "k string, v int, t timestamp"


def frame(spark, data):
    return spark.createDataFrame(
        [(k, v, None if t is None else datetime(2024, 1, t)) for k, v, t in data], SCHEMA
    )


def content(df):
    return {(r.k, r.v, r.t.day if r.t else None) for r in df.collect()}


def test_newest_row_per_key_wins_and_null_order_is_last(spark):
    staged = u.stage(frame(spark, [("a", 1, 1), ("a", 2, 2), ("b", 5, None), ("b", 4, 1), ("c", 7, None), (None, 9, 3)]), ["k"], "t")
    assert content(staged) == {("a", 2, 2), ("b", 4, 1), ("c", 7, None)}


def test_ties_do_not_depend_on_arrival_order(spark):
    data = [("a", v, 1) for v in range(50)]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        assert content(u.stage(frame(spark, data).repartition(4), ["k"], "t")) == {("a", 49, 1)}


def test_hot_key_is_cut_before_the_shuffle(spark):
    plan = u.stage(frame(spark, [("a", 1, 1)]).repartition(3), ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_rows_without_a_key_are_quarantined(spark):
    df = frame(spark, [(None, 1, 1), ("a", 2, 1)])
    assert content(u.quarantine(df, ["k"])) == {(None, 1, 1)}


def test_merge_guards_against_stale_rows(spark):
    target = frame(spark, [("same", 1, 5), ("stale", 1, 5), ("newer", 1, 5), ("kept", 1, 5), ("null_new", 1, 5), ("null_old", 1, None)])
    staged = frame(spark, [("same", 2, 5), ("stale", 2, 3), ("newer", 2, 9), ("added", 2, 1), ("null_new", 2, None), ("null_old", 2, 9)])
    merged = u.upsert(target, staged, ["k"], "t")
    assert content(merged) == {
        ("same", 2, 5), ("stale", 1, 5), ("newer", 2, 9), ("kept", 1, 5), ("added", 2, 1), ("null_new", 1, 5), ("null_old", 1, None),
    }
    assert tuple(u.classify_changes(target, staged, ["k"], "t").first()) == (1, 2, 3)


def test_merge_without_order_always_replaces(spark):
    target, staged = frame(spark, [("a", 1, 5)]), frame(spark, [("a", 2, 1)])
    assert content(u.upsert(target, staged, ["k"])) == {("a", 2, 1)}
    assert tuple(u.classify_changes(target, staged, ["k"]).first()) == (0, 1, 0)


def test_limited_refresh(spark):
    merged = u.upsert(frame(spark, [("a", 1, 5)]), frame(spark, [("a", 2, 9), ("b", 3, 9)]), ["k"], update_columns=["v"])
    assert content(merged) == {("a", 2, 5), ("b", 3, 9)}


@pytest.mark.parametrize("seed", range(4))
def test_merge_against_brute_force(spark, seed):
    """Idempotent, independent of order, unique keys, and stale rows never win."""
    rng = random.Random(seed)
    keys = [f"k{i}" for i in range(12)]

    def batch(n):
        return [(rng.choice(keys), rng.randint(0, 99), rng.randint(1, 28)) for _ in range(n)]

    first, second = batch(40), batch(40)
    # Of equal times the later batch wins, and within a batch the larger value.
    expected: dict[str, tuple] = {}
    for data in (first, second):
        best: dict[str, tuple] = {}
        for k, v, t in data:
            best[k] = max(best.get(k, (0, -1)), (t, v))
        for k, (t, v) in best.items():
            if k not in expected or t >= expected[k][0]:
                expected[k] = (t, v)
    target = u.stage(frame(spark, first), ["k"], "t")
    staged = u.stage(frame(spark, second), ["k"], "t")
    once = u.upsert(target, staged, ["k"], "t")
    twice = u.upsert(once, staged, ["k"], "t")
    wanted = {(k, v, t) for k, (t, v) in expected.items()}
    assert content(once) == wanted == content(twice)
    assert once.count() == len(wanted)


def test_watermark_and_incremental_reads(spark):
    df = frame(spark, [("a", 1, 1), ("b", 2, 2), ("c", 3, 3), ("d", 4, None)])
    assert u.read_watermark(df, "t").first()[0] == datetime(2024, 1, 3)
    assert u.read_watermark(df.filter("false"), "t").first()[0] is None
    assert content(u.incremental(df, "t", datetime(2024, 1, 2))) == {("c", 3, 3)}
    assert u.incremental(df, "t", None).count() == 4


def test_watermark_is_utc_on_a_driver_in_another_zone(spark, monkeypatch):
    df = spark.sql("SELECT TIMESTAMP'2024-01-03 10:00:00Z' AS t")
    monkeypatch.setenv("TZ", "Asia/Bangkok")
    time.tzset()
    try:
        assert df.first().t.hour == 17
        assert u.watermark_value(df, "t") == datetime(2024, 1, 3, 10)
        assert u.incremental(df, "t", u.watermark_value(df, "t")).count() == 0
    finally:
        monkeypatch.undo()
        time.tzset()


def test_look_back_recomputes_trailing_days(spark):
    df = frame(spark, [("a", 1, 1), ("b", 2, 2), ("c", 3, 3)]).withColumn("event_date", F.to_date("t"))
    assert {r.k for r in u.lookback(df, datetime(2024, 1, 3, 9), 1).collect()} == {"b", "c"}
    assert u.lookback(df, None, 1).count() == 3


def test_publish_replaces_an_unpartitioned_table_by_a_new_version(spark):
    table = ensure_table(spark, "pub.plain", {"k": "string", "v": "int"})
    u.publish(spark, table, spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"))
    current = spark.table(table)
    u.publish(spark, table, current.withColumn("v", F.col("v") + 1))
    assert {tuple(r) for r in spark.table(table).collect()} == {("a", 2), ("b", 3)}


def test_old_versions_expire(spark):
    table = ensure_table(spark, "pub.versions", {"v": "int"})
    assert u.expire_versions(spark, table) == 0
    for v in range(4):
        u.publish(spark, table, spark.createDataFrame([(v,)], "v int"))
    assert u.expire_versions(spark, table, 2) == 2
    assert u.expire_versions(spark, table, 2) == 0
    assert [r.v for r in spark.table(table).collect()] == [3]
    assert u.expire_versions(spark, table, 1) == 1
    assert [r.v for r in spark.table(table).collect()] == [3]
    with pytest.raises(ValueError):
        u.expire_versions(spark, table, 0)


def test_expiry_leaves_versions_that_are_being_written(spark):
    table = ensure_table(spark, "expiry.busy", {"k": "int"})
    for n in range(2):
        u.publish(spark, table, spark.range(n + 1).select(F.col("id").cast("int").alias("k")))
    home, mark, current = u._location(spark, table).partition("/version-")
    unfinished = f"{home}{mark}{int(current[:20]) + 1:020d}-abc"
    spark.range(1).write.parquet(unfinished)
    assert u.expire_versions(spark, table, 1) == 1
    assert spark.read.parquet(unfinished).count() == 1 and spark.table(table).count() == 2


def test_staged_copies_are_removed(spark):
    before = set(list_folders(spark, shared_dir(spark)))
    table = ensure_table(spark, "pub.staged", {"d": "date", "v": "int"}, ["d"])
    u.publish(spark, table, spark.sql("SELECT DATE'2024-01-01' AS d, 1 AS v"), ["d"])
    assert spark.table(table).count() == 1
    assert not [f for f in set(list_folders(spark, shared_dir(spark))) - before if "publish-staged" in f]


def test_publish_replaces_only_the_partitions_it_has_rows_for(spark):
    table = ensure_table(spark, "pub.parts", {"d": "date", "v": "int"}, ["d"])
    first = spark.sql("SELECT * FROM VALUES (DATE'2024-01-01', 1), (DATE'2024-01-02', 2) AS t(d, v)")
    u.publish(spark, table, first, ["d"])
    changed = spark.table(table).filter("d = DATE'2024-01-02'").withColumn("v", F.col("v") * 10)
    u.publish(spark, table, changed, ["d"])
    assert {(str(r.d), r.v) for r in spark.table(table).collect()} == {("2024-01-01", 1), ("2024-01-02", 20)}


def test_row_level_merge_is_left_to_the_table(spark):
    """Parquet tables have none; the statement must get as far as the table."""
    table = ensure_table(spark, "pub.merged", {"k": "string", "v": "int", "t": "timestamp"})
    with pytest.raises(Exception, match="MERGE INTO TABLE|UNSUPPORTED_FEATURE.TABLE_OPERATION"):
        u.merge_into(table, frame(spark, [("a", 1, 1)]), ["k"], "t")
