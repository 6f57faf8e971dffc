"""Exact top-k over groups and blocks of vectors: results against plain sums, and what a task and the driver hold."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import topk


def _plain(asked, rows, top):
    """For (id, vector) the best of the other rows of its length: (id, score), of whole numbers of any size."""
    others = [(i, v) for i, v in rows if i != asked[0] and len(v) == len(asked[1])]
    scores = [(i, sum(int(a) * int(b) for a, b in zip(asked[1], v, strict=True))) for i, v in others]
    return sorted(scores, key=lambda x: (-x[1], x[0]))[:top]


def _lists(ids, vectors, asked, top, step, block):
    held = topk._Held(ids[asked], np.arange(len(asked)), vectors[asked], top, step)
    order = np.lexsort((ids, -topk._norms(vectors)))
    for first in range(0, len(ids), block):
        at = order[first : first + block]
        held.meet(ids[at], vectors[at])
    found = defaultdict(list)
    for r in held.lists().to_pylist():
        found[r["mark"]].append((r["vec_id"], r["score"]))
    return [found[m] for m in range(len(asked))]


def test_no_table_is_joined_or_broadcast(spark):
    """A table exploded by the number of blocks counts as small in Spark's estimate, and would be broadcast."""
    df = spark.range(600).select(F.col("id").alias("vec_id"), F.array(*(F.col("id") * k % 17 - 8 for k in range(1, 9))).alias("embedding"))
    found = topk.top_k(df, F.col("vec_id") % 20 == 0, block=32)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan and "Broadcast" not in plan
    assert "collect_list" not in plan  # no row holds a block


def test_many_groups(spark):
    """Groups of few queries and cells of few products: repeated ids, equal vectors, two lengths, one id on many rows."""
    rng = np.random.default_rng(3)
    vectors = rng.integers(-9, 10, (500, 6))
    vectors[100:180] = vectors[40]
    rows = [(int(i), v.tolist()) for i, v in enumerate(vectors)] + [(int(i), v.tolist()) for i, v in enumerate(rng.integers(-9, 10, (60, 3)))]
    rows += [(20, rows[20][1])] * 3 + [(7, rows[7][1])] * 40 + [(60, v.tolist()) for v in rng.integers(-9, 10, (30, 6))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<bigint>").repartition(3)
    got = defaultdict(list)
    for r in topk.top_k(df, F.col("vec_id") % 20 == 0, top=5, block=16, step=4, held=60, products=4000).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    want = defaultdict(list)
    for asked in {(i, tuple(v)) for i, v in rows if i % 20 == 0}:
        want[asked[0]] += [(k, *x) for k, x in enumerate(_plain(asked, rows, 5), 1)]
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(x) for i, x in want.items()}


@pytest.mark.parametrize("scale", [1, 60, 10**5, 10**6, 2**27, 2**28])
def test_sums_are_exact_in_every_type(scale):
    rng = np.random.default_rng(scale)
    for size, step, block in ((1, 1, 7), (5, 16, 400), (33, 8, 64)):
        vectors = rng.integers(-scale, scale + 1, (300, size))
        vectors[:4] = [[0], [scale], [-scale], [1]]
        vectors[150:220] = vectors[rng.integers(0, 9, 70)]
        vectors[::7] //= 1000
        ids = rng.integers(0, 250, 300)
        asked = np.arange(0, 300, 2)
        rows = list(zip(ids.tolist(), vectors.tolist(), strict=True))
        assert _lists(ids, vectors, asked, 6, step, block) == [_plain(rows[a], rows, 6) for a in asked]


def test_only_its_own_rows_leave_a_query_without_a_list():
    ids, vectors = np.full(50, 3), np.arange(100).reshape(50, 2)
    assert _lists(ids, vectors, np.arange(50), 4, 1, 8) == [[]] * 50


def test_pairs_are_ruled_out_by_their_bounds(monkeypatch):
    """Clusters that the first dimensions tell apart: what is left after those is followed pair by pair."""
    rng = np.random.default_rng(8)
    codes = rng.choice([-40, 40], (100, 16))
    vectors = np.concatenate([np.repeat(codes, 60, axis=0), rng.integers(-3, 4, (6000, 32))], axis=1)
    ids = rng.permutation(6000)
    left = []
    followed = topk._Block._followed

    def noted(self, queries, tails, least, k, asked, *rest):
        left.append(len(asked) / (len(queries) * len(self.rows)))
        return followed(self, queries, tails, least, k, asked, *rest)

    monkeypatch.setattr(topk._Block, "_followed", noted)
    asked = np.arange(0, 6000, 15)
    got = _lists(ids, vectors, asked, 10, 8, 1500)
    assert len(left) > 4 and max(left) <= 1 / topk.SPARSE
    scores = vectors[asked] @ vectors.T
    for a, row, found in zip(asked, scores, got, strict=True):
        assert found == sorted(((int(i), int(s)) for i, s in zip(ids, row, strict=True) if i != ids[a]), key=lambda x: (-x[1], x[0]))[:10]


def test_a_task_holds_a_bounded_group(spark, monkeypatch):
    """More queries make more cells, not larger ones."""
    from ledgerlens.llm import staging

    made = []
    monkeypatch.setattr(topk, "over_batches", lambda df, *rest: made.append(df) or staging.over_batches(df, *rest))
    for n in (400, 1600):
        df = spark.range(n).select(F.col("id").alias("vec_id"), F.array(*(F.col("id") * k % 17 - 8 for k in range(1, 9))).alias("embedding"))
        assert topk.top_k(df, F.col("vec_id") % 2 == 0, top=3, block=64, held=400, products=10**9).count() == 3 * n // 2
        cells = made.pop().groupBy("cell").agg(F.sum(F.col("asks").cast("int")).alias("n")).collect()
        assert max(r["n"] for r in cells) <= 60  # 400 components are 50 queries
