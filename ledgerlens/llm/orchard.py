"""Vector code compression: product quantisation whose nearest entries are found by Orchard search.

Vectors of integers are cut into equal parts, and each part position has a codebook of a
few entries. Codebooks start from the rows of least id, then rounds assign every part to
its nearest entry and move each entry to the componentwise mean, rounded down. An entry
without parts stays.

Orchard search: every entry keeps the list of the others in order of distance. A part
starts at some entry and walks down that entry's list. Where it meets a nearer entry it
jumps to that one's list; entries met before are marked and not measured again. It stops
where the list is farther from its entry than twice the part is: by the triangle
inequality nothing beyond can be nearer. Entries at exactly that distance are still
looked at, since they can tie, and ties go to the lower index. All parts of a slice walk
at once, so a step is a few array operations.

A round moves no vector: tasks add up their parts by entry, and only the sums of the
codebook's few entries are shuffled. Codebooks, whose size does not depend on the table,
are all that reaches the driver and returns to the tasks.

Rows without a vector (null, or with a null component) take no part, nor do vectors of
another length than the one of the row that starts the first codebooks. Ids may be null
(last in order) or repeated (ordered by their vectors), labels may be null. With fewer
rows than entries the codebooks are shorter. An empty table gives an empty result. If
the length is no multiple of the parts, parts differ by one component. Components must
be below 2^27 in size, so that squared distances fit 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.staging import over_batches, staged

PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Vectors that walk at once.
SLICE = 8192
#: Rows of one label are spread over so many keys where its sum returns to them.
SALTS = 64


class Codebooks(NamedTuple):
    """One array (entries x components) for each part position; none for an empty table."""

    books: list[np.ndarray]

    def sha256(self) -> str:
        """Of all components as decimal text, by part, entry and place."""
        return hashlib.sha256(",".join(str(int(x)) for b in self.books for x in b.reshape(-1)).encode()).hexdigest()


def neighbour_lists(book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the other entries in order of distance (ties: lower index), and their squared distances."""
    gaps = ((book[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    own = gaps.copy()
    np.fill_diagonal(own, -1)  # an equal entry of lower index must not come before the entry itself
    order = np.argsort(own, axis=1, kind="stable")[:, 1:]
    return order, np.take_along_axis(gaps, order, axis=1)


def nearest(points: np.ndarray, book: np.ndarray, measured: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of each point's nearest entry by Orchard search; ties go to the lower index.

    ``measured`` gets the number of distances computed.
    """
    n, k = len(points), len(book)
    others, gaps = neighbour_lists(book)
    at = np.zeros(n, dtype=np.int64)
    if points.shape[1]:
        first = np.argsort(book[:, 0], kind="stable")
        at = first[np.minimum(np.searchsorted(book[first, 0], points[:, 0]), k - 1)]
    best = ((points - book[at]) ** 2).sum(axis=1)
    place = np.zeros(n, dtype=np.int64)
    marked = np.zeros((n, k), dtype=bool)
    marked[np.arange(n), at] = True
    walking = np.arange(n if k > 1 else 0)
    count = n
    while len(walking):
        walking = walking[gaps[at[walking], place[walking]] <= 4 * best[walking]]
        entry = others[at[walking], place[walking]]
        place[walking] += 1
        fresh = ~marked[walking, entry]
        rows, entry = walking[fresh], entry[fresh]
        marked[rows, entry] = True
        gap = ((points[rows] - book[entry]) ** 2).sum(axis=1)
        count += len(rows)
        better = (gap < best[rows]) | ((gap == best[rows]) & (entry < at[rows]))
        won = rows[better]
        at[won], best[won], place[won] = entry[better], gap[better], 0
        walking = walking[place[walking] < k - 1]
    if measured is not None:
        measured.append(count)
    return at, best


def _cuts(size: int, parts: int) -> list[tuple[int, int]]:
    return [(size * p // parts, size * (p + 1) // parts) for p in range(parts)]


def _vectors(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    for first in range(0, batch.num_rows, SLICE):
        column = batch.column("v").slice(first, SLICE)
        yield first, column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), size)


def _sums(model: Codebooks, size: int):
    """part, entry, place, total, n of a task's vectors; place -1 for the number of parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = _cuts(size, len(model.books))
        totals = [np.zeros((len(b), b.shape[1] + 1), dtype=np.int64) for b in model.books]
        for batch in batches:
            for _, vectors in _vectors(batch, size):
                for (a, b), book, total in zip(cuts, model.books, totals, strict=True):
                    at, _ = nearest(vectors[:, a:b], book)
                    np.add.at(total, at, np.concatenate([np.ones((len(vectors), 1), np.int64), vectors[:, a:b]], axis=1))
        for part, total in enumerate(totals):
            entry, place = (x.reshape(-1) for x in np.indices(total.shape))
            columns = [np.full(total.size, part, np.int32), entry.astype(np.int32), place.astype(np.int32) - 1, total.reshape(-1)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "entry", "place", "total"])

    return run


def _codes(model: Codebooks, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, vectors in _vectors(batch, size):
                found = [nearest(vectors[:, a:b], book) for (a, b), book in zip(_cuts(size, len(model.books)), model.books, strict=True)]
                codes = np.stack([at for at, _ in found], axis=1).astype(np.int32)
                n, parts = codes.shape
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * parts), pa.array(codes.reshape(-1)))
                error = sum(gap for _, gap in found)
                keys = [batch.column(c).slice(first, n) for c in ("id", "label")]
                yield pa.RecordBatch.from_arrays([*keys, lists, pa.array(error)], names=["id", "label", "codes", "error"])

    return run


def prepared(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """id, label, v of the rows that have a vector, written once for all rounds."""
    rows = vectors.select(vectors[vec_id].alias("id"), vectors[label].alias("label"), vectors[vector].cast("array<bigint>").alias("v"))
    return staged(rows.filter("v IS NOT NULL AND NOT exists(v, x -> x IS NULL)"), "code-vectors")


def _first_rows(rows: DataFrame, n: int) -> list[list[int]]:
    """Vectors of the ``n`` rows of least id that are as long as the first one."""
    order = [F.col("id").asc_nulls_last(), F.col("v")]
    first = rows.orderBy(*order).select("v").first()
    if first is None:
        return []
    same = rows.filter(F.size("v") == len(first["v"]))
    return [r["v"] for r in same.orderBy(*order).select("v").limit(n).collect()]


def trained(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of ``prepared`` rows."""
    first = np.array(_first_rows(rows, entries), dtype=np.int64)
    if not len(first):
        return Codebooks([])
    size = first.shape[1]
    model = Codebooks([first[:, a:b].copy() for a, b in _cuts(size, parts)])
    alike = rows.filter(F.size("v") == size).select("v")
    for _ in range(rounds):
        summed = over_batches(alike, _sums(model, size), "part int, entry int, place int, total bigint")
        # One row for each component of each entry, whatever the table's size.
        found = summed.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
        totals = {(r["part"], r["entry"], r["place"]): int(r["total"]) for r in found}
        books = [b.copy() for b in model.books]
        for (part, entry, place), total in totals.items():
            count = totals[(part, entry, -1)]
            if place >= 0 and count:
                books[part][entry, place] = total // count
        model = Codebooks(books)
    return model


def encoded(rows: DataFrame, model: Codebooks) -> DataFrame:
    """id, label, codes (index of the entry by part), error (squared distance) of ``prepared`` rows."""
    size = sum(b.shape[1] for b in model.books)
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    alike = rows.filter(F.size("v") == size) if model.books else rows.limit(0)
    return over_batches(alike, _codes(model, size), f"id {kind['id']}, label {kind['label']}, codes array<int>, error bigint")


def with_label_error(codes: DataFrame) -> DataFrame:
    """Adds ``label_error``: the errors of all rows of a label together, null labels as one.

    Sums are combined before the shuffle; a label's sum returns to its rows under
    ``SALTS`` keys, so that a label of a third of all rows is no single task.
    """
    sums = staged(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    spread = sums.select(F.col("label").alias("_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salted = codes.withColumn("_mine", F.pmod(F.xxhash64("id", "codes"), F.lit(SALTS)).cast("int"))
    same = salted["label"].eqNullSafe(spread["_label"]) & (salted["_mine"] == spread["_salt"])
    return salted.join(spread, same).drop("_label", "_salt", "_mine")


def compressed(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, Codebooks]:
    """Codes with errors of a table of integer vectors, and the codebooks that decode them."""
    rows = prepared(vectors, vec_id, vector, label)
    model = trained(rows)
    return with_label_error(staged(encoded(rows, model), "codes")), model


def decoded(codes: list[int], model: Codebooks) -> list[int]:
    """The vector that a row's codes stand for."""
    return [int(x) for c, book in zip(codes, model.books, strict=True) for x in book[c]]
