from __future__ import annotations

import random
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlens.functions import expressions as e


def test_sum_does_not_depend_on_order_and_is_exact(spark):
    rng = random.Random(5)
    cents = [rng.randint(-(10**12), 10**12) for _ in range(5000)]
    for seed in (1, 2):
        random.Random(seed).shuffle(cents)
        df = spark.createDataFrame([(c / 100,) for c in cents], "amount double").repartition(7)
        total = df.agg(e.exact_total("amount").alias("t"), e.exact_sum("amount").alias("s")).first()
        assert total.t == Decimal(sum(cents)) / 100 and total.s == sum(cents) / 100


def test_sum_beyond_the_range_of_a_long(spark):
    big = spark.range(3000).select(F.lit(9.0e13).alias("amount"))
    assert big.agg(e.exact_total("amount").alias("t")).first().t == Decimal(27) * 10**16


def test_nulls_and_empty_groups(spark):
    df = spark.createDataFrame([("a", None), ("a", 1.5), ("a", 2.5), ("b", None)], "g string, amount double")
    got = {r.g: (r.s, r.m) for r in df.groupBy("g").agg(e.exact_sum("amount").alias("s"), e.exact_mean("amount").alias("m")).collect()}
    assert got == {"a": (4.0, 2.0), "b": (None, None)}
    empty = df.filter("false").agg(
        e.exact_sum("amount").alias("s"),
        e.exact_mean("amount").alias("m"),
        e.percentage(F.count_if(F.col("g") == "a"), F.count("*")).alias("p"),
    )
    assert tuple(empty.first()) == (None, None, None)


def test_rounding_ties_go_up(spark):
    row = spark.range(1).select(
        e.rounded(F.lit(1.005), 2).alias("a"), e.rounded(F.lit(2.675), 2).alias("b"), e.rounded(F.lit(-1.005), 2).alias("c")
    )
    assert tuple(row.first()) == (1.01, 2.68, -1.01)


def test_accounts_in_text(spark):
    df = spark.createDataFrame(
        [(1, "pay acc th 10000001 now"), (2, "ACC_TH-10000001"), (3, "AccTh10000002 and acc-th-10000003"), (4, "acc th 123"), (5, None)],
        "i int, t string",
    )
    got = {r.i: r.a for r in df.select("i", e.canonical_account(F.col("t")).alias("a")).collect()}
    assert got == {1: "ACC-TH-10000001", 2: "ACC-TH-10000001", 3: "ACC-TH-10000002", 4: None, 5: None}


def test_account_format(spark):
    df = spark.createDataFrame([("ACC-TH-10000001",), ("ACC-TH-1000001",), ("acc-th-10000001",), ("xACC-TH-10000001",)], "a string")
    assert [r.ok for r in df.select(e.is_account(F.col("a")).alias("ok")).collect()] == [True, False, False, False]


def test_shards_are_stable_and_complete(spark):
    keys = spark.range(2000).select(F.concat(F.lit("k"), F.col("id")).alias("k"))
    shards = keys.select("k", e.shard_of(F.col("k"), 8).alias("s"))
    assert {r.s for r in shards.collect()} == set(range(8))
    assert shards.collect() == keys.repartition(5).select("k", e.shard_of(F.col("k"), 8).alias("s")).orderBy(F.expr("cast(substr(k,2) as int)")).collect()


def test_totals_neither_overflow_nor_vanish(spark):
    for values, total in (([1e15, 0.25], 1e15 + 0.25), ([1e18, 1.0], 1e18), ([0.00004] * 1000, 0.04), ([1e300, 1.0], 1e300)):
        df = spark.createDataFrame([(v,) for v in values], "amount double")
        got = df.agg(e.exact_sum("amount").alias("s"), e.exact_total("amount").alias("t")).first()
        assert abs(got.s - total) <= 1e-12 * total
        assert got.t is None if total > 1e33 else abs(float(got.t) - total) <= 1e-9 * total
    odd = spark.createDataFrame([(float("inf"),), (1.0,)], "amount double").agg(e.exact_sum("amount").alias("s")).first()
    assert odd.s == float("inf")
    assert spark.createDataFrame([], "amount double").agg(e.exact_sum("amount").alias("s")).first().s is None
