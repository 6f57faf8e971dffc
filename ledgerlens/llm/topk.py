"""Exact top-k by inner product: columnar branch-and-bound over blocks of vectors.

Queries and candidates are dealt into groups, and every pair of groups is one cell of
work. A cell's rows reach one task as a sorted stream, its queries first: the task holds
those, a group of bounded size, and their best candidates so far, and lets the candidates
pass by in blocks, the largest norms first. Neither a cell nor a group is ever one row,
and no table is joined or broadcast.

Inside, candidates lie dimension by dimension. Products are added up one block of
dimensions at a time; after each, a pair whose sum plus the most that the remaining
dimensions can give (the product of both remaining norms) stays below the query's k-th
best score so far is ruled out, and once few pairs are left, those alone are followed. A
query whose norm times the block's largest is below its k-th best score skips the block.

Rows whose id or vector is null, or whose vector holds a null or non-finite component,
take no part. Vectors meet only vectors of their own dimension. Rows with the query's id
are its own and no candidates; other repeated rows are all returned. Query rows with equal
id and vector are one query; unequal vectors of one id have lists of their own. Ties go to the smaller id.
Components are integers; scores must fit 64 bits. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.staging import over_batches, staged

TOP = 20
BLOCK = 2048
DIMENSIONS = 16
#: Components of the queries that a task holds (16,384 queries of 64 dimensions).
HELD = 1 << 20
#: Products in a cell, about a minute of one core: candidates are dealt into more groups beyond.
PRODUCTS = 1 << 38
#: Queries that meet a block at once.
TILE = 128
#: Components of a block, if the vectors are long.
SLICE = 1 << 22
#: Pairs are followed one by one where at most one in so many is left.
SPARSE = 64
#: Where pairs could not be ruled out, it is not tried again for so many tiles.
PAUSE = 16
#: Bounds are computed in floating point and raised by more than its error.
RAISED, SLACK = 1 + 1e-6, 2.0
NONE = np.iinfo(np.int64).min


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component; null where a component is null or not finite."""
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    finite = ~F.exists(vector, lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    return F.when(finite, whole)


def _norms(vectors: np.ndarray) -> np.ndarray:
    real = vectors.astype(np.float64)
    return np.sqrt(np.einsum("ij,ij->i", real, real))


def _tails(vectors: np.ndarray, step: int) -> np.ndarray:
    """For each block of dimensions, the norm of what follows it, by vector."""
    parts = np.add.reduceat(vectors.astype(np.float64) ** 2, np.arange(0, vectors.shape[1], step), axis=1)
    after = np.zeros_like(parts)
    after[:, :-1] = np.cumsum(parts[:, ::-1], axis=1)[:, ::-1][:, 1:]
    return np.sqrt(after).T * RAISED


def _exact_kind(most: float) -> type:
    """The fastest type in which sums of products are exact, if both vectors' norms multiply to ``most``."""
    return np.float32 if most < 2**23 else np.float64 if most < 2**52 else np.int64


def _pairs(alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.divmod(np.flatnonzero(alive), alive.shape[1])


class _Block:
    """Candidates that pass by, in the type their products are exact in; ``columns`` has them dimension by dimension."""

    def __init__(self, vectors: np.ndarray, kind: type, step: int):
        self.kind, self.step = kind, step
        self.rows = vectors.astype(kind)
        self.columns = np.ascontiguousarray(self.rows.T)
        self.rest = None if kind is np.int64 else _tails(vectors, step).astype(kind)

    def reached_by(self, queries: np.ndarray, tails: np.ndarray, bound: np.ndarray, own: tuple[np.ndarray, np.ndarray], top: int, pause: np.ndarray):
        """query, candidate and score of the pairs that reach the query's bound, at least; pairs of ``own`` may be among them.

        ``pause``: for how many tiles not to look for pairs to rule out, by block of dimensions.
        """
        queries, bounds, sums, done = queries.astype(self.kind), bound.astype(self.kind), None, 0
        if self.rest is not None and bounds.min() > NONE:  # in 64-bit integers the sums on the way may exceed their range
            tails, least = tails.astype(self.kind), (bound.astype(np.float64) - SLACK).astype(self.kind)
            for k in np.flatnonzero(pause[:-1] == 0):
                sums, done = self._added(sums, queries, done, (k + 1) * self.step), (k + 1) * self.step
                alive = sums + tails[k, :, None] * self.rest[k] >= least[:, None]
                if np.count_nonzero(alive) * SPARSE <= alive.size:
                    return self._followed(queries, tails, least, k + 1, *_pairs(alive), sums)
                pause[k] = PAUSE
            np.maximum(pause - 1, 0, out=pause)
        sums = self._added(sums, queries, done, len(self.columns))
        sums[own] = NONE if self.rest is None else -np.inf
        alive = sums >= bounds[:, None]
        if sums.shape[1] > top and np.count_nonzero(alive) > 4 * top * len(queries):
            alive = sums >= np.maximum(bounds, np.partition(sums, sums.shape[1] - top, axis=1)[:, -top])[:, None]
        pairs = _pairs(alive)
        return *pairs, sums[pairs]

    def _added(self, sums: np.ndarray | None, queries: np.ndarray, first: int, end: int) -> np.ndarray:
        products = queries[:, first:end] @ self.columns[first:end]
        return sums + products if first else products

    def _followed(self, queries: np.ndarray, tails: np.ndarray, least: np.ndarray, k: int, asked: np.ndarray, found: np.ndarray, sums: np.ndarray):
        """The same for few pairs, from block ``k`` of dimensions on; those ruled out are compacted away."""
        sums = sums[asked, found]
        for first in range(k * self.step, len(self.columns), self.step):
            part = slice(first, first + self.step)
            sums = sums + np.einsum("ij,ij->i", queries[asked, part], self.rows[found, part])
            alive = sums + tails[k, asked] * self.rest[k, found] >= least[asked]
            asked, found, sums, k = asked[alive], found[alive], sums[alive], k + 1
        return asked, found, sums


class _Held:
    """The queries of one cell, and the best of the candidates that they have met."""

    def __init__(self, ids: np.ndarray, marks: np.ndarray, vectors: np.ndarray, top: int, step: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.marks, self.vectors = ids[order], marks[order], vectors[order]
        self.top, self.step = top, step
        self.norms, self.tails = _norms(self.vectors), _tails(self.vectors, step)
        self.pause = np.zeros(len(self.tails), dtype=np.int64)
        self.size = np.zeros(len(ids), dtype=np.int64)
        self.best_ids, self.best = (np.zeros((len(ids), top), dtype=np.int64) for _ in range(2))
        # Score and id in the last place of a full list.
        self.bound, self.last = np.full(len(ids), NONE), np.zeros(len(ids), dtype=np.int64)

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        largest = _norms(vectors).max()
        asking = np.flatnonzero(self.norms * (largest * RAISED) + SLACK >= self.bound)
        if not len(asking):
            return
        block = _Block(vectors, _exact_kind(self.norms[asking].max() * largest), self.step)
        known = np.flatnonzero(self.ids[np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)] == ids)
        for first in range(0, len(asking), TILE):
            at = asking[first : first + TILE]
            low, high = (np.searchsorted(self.ids[at], ids[known], side) for side in ("left", "right"))
            ends = np.cumsum(high - low)
            own = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - high, high - low), np.repeat(known, high - low)
            asked, found, scores = block.reached_by(self.vectors[at], self.tails[:, at], self.bound[at], own, self.top, self.pause)
            asked, found_ids, scores = at[asked], ids[found], scores.astype(np.int64)
            better = (self.size[asked] < self.top) | (scores > self.bound[asked]) | ((scores == self.bound[asked]) & (found_ids < self.last[asked]))
            better &= found_ids != self.ids[asked]
            if better.any():
                self._take(asked[better], found_ids[better], scores[better])

    def _take(self, asked: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Put candidates into the lists of their queries."""
        touched = np.unique(asked)
        filled = np.arange(self.top) < self.size[touched, None]
        asked = np.concatenate([np.repeat(touched, self.size[touched]), asked])
        ids = np.concatenate([self.best_ids[touched][filled], ids])
        scores = np.concatenate([self.best[touched][filled], scores])
        order = np.lexsort((ids, ~scores, asked))
        asked = asked[order]
        place = np.arange(len(asked)) - np.searchsorted(asked, asked)
        kept = place < self.top
        asked, place, order = asked[kept], place[kept], order[kept]
        self.best_ids[asked, place], self.best[asked, place] = ids[order], scores[order]
        np.maximum.at(self.size, asked, place + 1)
        full = touched[self.size[touched] == self.top]
        self.bound[full], self.last[full] = self.best[full, -1], self.best_ids[full, -1]

    def lists(self) -> pa.RecordBatch:
        filled = np.arange(self.top) < self.size[:, None]
        columns = [np.repeat(self.ids, self.size), np.repeat(self.marks, self.size), self.best_ids[filled], self.best[filled]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "mark", "vec_id", "score"])


def _search(top: int, block: int, step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, asking, held = None, [], None
        for batch in batches:
            cell, dim, asks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "dim", "asks"))
            changes = np.flatnonzero((cell[1:] != cell[:-1]) | (dim[1:] != dim[:-1]) | (asks[1:] != asks[:-1])) + 1
            for first, end in pairwise([0, *changes.tolist(), len(cell)] if len(cell) else []):
                if (cell[first], dim[first]) != at:
                    if held:
                        yield held.lists()
                    at, asking, held = (cell[first], dim[first]), [], None
                part = batch.slice(first, end - first)
                ids, marks = (part.column(c).to_numpy() for c in ("id", "mark"))
                vectors = part.column("v").flatten().to_numpy().astype(np.int64, copy=False).reshape(len(ids), -1)
                if asks[first]:
                    asking.append((ids, marks, vectors))
                    continue
                if asking:
                    held, asking = _Held(*map(np.concatenate, zip(*asking, strict=True)), top, step), []
                if held:
                    rows = max(1, min(block, SLICE // vectors.shape[1]))
                    for low in range(0, len(ids), rows):
                        held.meet(ids[low : low + rows], vectors[low : low + rows])
        if held:
            yield held.lists()

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    top: int = TOP,
    block: int = BLOCK,
    step: int = DIMENSIONS,
    held: int = HELD,
    products: int = PRODUCTS,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row for which ``is_query`` holds, its ``top`` best other rows.

    ``vector`` holds integers. All rows are candidates; the queries are a stated set of
    them. A task holds queries of at most about ``held`` components, whatever the table's
    size. Rows are dealt by a number that each gets when it is staged, so repeated ones
    are spread, and each cell gives at most ``top`` rows a query.
    """
    picked = vectors.select(vectors[vec_id].cast("bigint").alias("id"), vectors[vector].alias("v"), is_query.alias("is_query"))
    numbers = {"dim": F.size("v"), "row": F.monotonically_increasing_id()}
    rows = staged(picked.filter("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL)").withColumns(numbers), "vectors")
    wanted = staged(rows.filter("is_query").groupBy("id", "v").agg(F.xxhash64("v").alias("mark")).withColumns(numbers), "queries")
    (n, components), (q, asked) = (df.agg(F.count("*"), F.coalesce(F.sum("dim"), F.lit(0))).first() for df in (rows, wanted))
    q_groups = max(1, ceil(asked / held))
    spread = min(ceil(n / block), ceil(2 * vectors.sparkSession.sparkContext.defaultParallelism / q_groups))
    n_groups = max(1, spread, ceil(components * q / q_groups / products))
    group, own = F.col("row") % q_groups, F.col("row") % n_groups
    norm = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    asking = wanted.withColumns({"asks": F.lit(True), "norm": F.lit(0.0), "cells": F.sequence(group * n_groups, (group + 1) * n_groups - 1)})
    passing = rows.withColumns({"asks": F.lit(False), "norm": norm, "mark": F.lit(0).cast("bigint"), "cells": F.sequence(own, own + (q_groups - 1) * n_groups, F.lit(n_groups).cast("bigint"))})
    columns = (F.explode("cells").alias("cell"), "dim", "asks", "norm", "id", "mark", "v")
    cells = asking.select(*columns).unionByName(passing.select(*columns)).repartitionById(q_groups * n_groups, F.col("cell").cast("int"))
    stream = cells.sortWithinPartitions("cell", "dim", F.col("asks").desc(), F.col("norm").desc(), "id")
    scored = over_batches(stream, _search(top, block, step), "query_id bigint, mark bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id", "mark").orderBy(F.col("score").desc(), "vec_id")
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
