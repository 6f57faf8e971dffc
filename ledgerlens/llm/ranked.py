"""Ranked lexical search: best-first intervals of documents over range-maximum tables of posting lists.

1. The items' terms form a vocabulary. One pass over all texts counts terms and documents
   and lays the postings of that vocabulary out in blocks of documents, shortest document
   first, without a shuffle. Items come in passes of bounded vocabulary (``TERMS``).
2. Document frequencies are added up by term; weights follow.
3. A block is searched for every item. Over each posting list lies a sparse table of
   maxima: where the greatest impact of any stretch stands, by two look-ups. An interval of
   documents is bounded by the sum of its terms' greatest impacts. Intervals wait in the
   order of their bounds; the best ones are split at the document in which the greatest
   single impact stands, which is scored exactly, and both rests are bounded anew. The
   search ends where no bound reaches the item's last rank. That rank is carried from block
   to block of a task, so later blocks are mostly dismissed as one interval.
4. Each task gives at most ``top`` documents an item; those are ranked together.

All scores are 64-bit integers and independent of blocks and order. Hashes of terms have
64 bits. Null or wordless texts are no documents of the statistics and never found. Rows
that share a doc_id are documents of their own; ids may be null (last among equal scores).
Equal (id, text) item rows are one item, unequal rows of one id have lists of their own,
items without a term have none. Empty tables give an empty result; columns other than
the named ones are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm import words as W
from ledgerlens.llm.staging import over_batches, staged

TOP = 20
#: Bounds of a block: documents, and postings after which it is closed.
DOCS, POSTINGS = 4096, 1 << 18
#: Different terms of the items of a pass (about; one item's terms stay together).
TERMS = 1 << 17
#: Intervals that are split at a time.
FRONT = 32

_IS_TERM = np.zeros(256, dtype=bool)
_IS_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_FOLDED = W.BYTE_VALUES.copy()
_FOLDED[0x41:0x5B] = _FOLDED[0x61:0x7B]


class Query(NamedTuple):
    """One item: places of its terms in the pass's vocabulary, and how often it has each."""

    number: int
    terms: np.ndarray
    times: np.ndarray


def _terms(batch: pa.RecordBatch) -> Iterator[tuple[int, int, W.Words, np.ndarray]]:
    data, offsets = W.text_bytes(batch.column("text"))
    for first, last in W.slices(offsets):
        words = W.Words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], _IS_TERM)
        yield first, last, words, words.hashes(_FOLDED)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        numbers = batch.column("item").to_numpy()
        for first, _, words, hashes in _terms(batch):
            pairs, times = np.unique(np.stack([words.owners().view(np.uint64), hashes], axis=1), axis=0, return_counts=True)
            columns = [numbers[pairs[:, 0].astype(np.int64) + first], pairs[:, 1].view(np.int64), times]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["item", "h", "times"])


# -- the index -----------------------------------------------------------------------

_BLOCK = "ids array<bigint>, lengths array<int>, terms array<int>, ends array<int>, docs array<int>, counts array<int>, n_docs bigint, n_terms bigint"


def _laid_out(parts: list[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]], n_docs: int, n_terms: int) -> pa.RecordBatch:
    """One block, its documents by length, its postings by term and document."""
    shift = np.cumsum([0, *(len(p[1]) for p in parts)])
    ids = pa.concat_arrays([p[0] for p in parts])
    lengths, terms, counts = (np.concatenate([p[k] for p in parts]) for k in (1, 3, 4))
    docs = np.concatenate([p[2] + s for p, s in zip(parts, shift, strict=False)])
    order = np.argsort(lengths, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    docs = place[docs]
    by_term = np.lexsort((docs, terms))
    docs, counts = docs[by_term], counts[by_term]
    held, begins = np.unique(terms[by_term], return_index=True)
    ends = np.append(begins[1:], len(docs)) if len(held) else begins
    lists = [pa.array([x], pa.list_(pa.int32())) for x in (lengths[order], held, ends, docs, counts)]
    columns = [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pa.array(order))), *lists]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64())],
        names=["ids", "lengths", "terms", "ends", "docs", "counts", "n_docs", "n_terms"],
    )


def _blocks_of(vocabulary: np.ndarray):
    """Blocks of the postings of a sorted vocabulary, with the number of documents and terms they were read from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, docs, postings, n_docs, n_terms = [], 0, 0, 0, 0
        for batch in batches:
            ids = batch.column("doc_id")
            for first, _, words, hashes in _terms(batch):
                lengths = np.diff(words.bounds)
                n_docs, n_terms = n_docs + int((lengths > 0).sum()), n_terms + len(words)
                at = np.minimum(np.searchsorted(vocabulary, hashes), max(len(vocabulary) - 1, 0))
                known = np.flatnonzero(vocabulary[at] == hashes) if len(vocabulary) else np.empty(0, np.int64)
                pairs, counts = np.unique(words.owners()[known] * len(vocabulary) + at[known], return_counts=True)
                owner, term = pairs // max(len(vocabulary), 1), pairs % max(len(vocabulary), 1)
                held, doc = np.unique(owner, return_inverse=True)
                if not len(held):
                    continue
                parts.append((ids.take(pa.array(held + first)), lengths[held], doc, term, counts))
                docs, postings = docs + len(held), postings + len(pairs)
                if docs >= DOCS or postings >= POSTINGS:
                    yield _laid_out(parts, n_docs, n_terms)
                    parts, docs, postings, n_docs, n_terms = [], 0, 0, 0, 0
        if not parts:
            empty = np.empty(0, np.int64)
            parts = [(pa.array([], pa.int64()), empty, empty, empty, empty)]
        yield _laid_out(parts, n_docs, n_terms)

    return run


# -- the search ----------------------------------------------------------------------


class Block:
    """Posting lists with impacts, and where the greatest one of any stretch of a list stands."""

    def __init__(self, terms: np.ndarray, ends: np.ndarray, docs: np.ndarray, impacts: np.ndarray, size: int):
        self.size, self.docs, self.impacts = size, docs, impacts
        self.terms, self.ends = terms, ends
        self.begins = np.append(0, ends[:-1]) if len(ends) else ends
        owner = np.repeat(np.arange(len(terms)), ends - self.begins)
        #: Postings in one order, so that one search finds a document's place in several lists.
        self.keys = owner * np.int64(size + 1) + docs
        longest = int((ends - self.begins).max(initial=1))
        level = np.arange(len(docs), dtype=np.int32)
        self.greatest = [level]
        for k in range(longest.bit_length() - 1):
            left, right = level[: len(level) - (1 << k)], level[1 << k :]
            level = np.where(impacts[left] >= impacts[right], left, right)
            self.greatest.append(level)
        width = len(docs)
        self.table = np.stack([np.pad(x, (0, width - len(x))) for x in self.greatest]) if width else np.zeros((1, 0), np.int32)

    def maxima(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Place of the greatest impact in each [low, high) of one list; -1 for none."""
        filled = high > low
        span = np.where(filled, high - low, 1)
        k = np.frexp(span.astype(np.float64))[1] - 1
        a = self.table[k, np.where(filled, low, 0)]
        b = self.table[k, np.where(filled, high - (1 << k.astype(np.int64)), 0)]
        return np.where(filled, np.where(self.impacts[a] >= self.impacts[b], a, b), -1)

    def best(self, lists: np.ndarray, times: np.ndarray, least: int, top: int) -> list[tuple[int, int]]:
        """(score, document) of all documents that can be among the ``top`` with a score of ``least`` or more.

        ``lists``: numbers of the query's terms in this block, ``least``: 1 at least.
        """
        found: list[tuple[int, int]] = []
        ranks: list[int] = []  # the greatest scores so far, as a heap
        last = len(self.docs) - 1

        def bounded(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Sum of the greatest impacts of each interval, and the document in which the greatest of them stands."""
            at = self.maxima(low, high)
            parts = np.where(at >= 0, self.impacts[at] * times, 0)
            return parts.sum(axis=1), self.docs[at[np.arange(len(at)), parts.argmax(axis=1)]]

        low, high = self.begins[lists][None, :], self.ends[lists][None, :]
        bound, split = bounded(low, high)
        waiting = [(-int(bound[0]), 0, low[0], high[0], int(split[0]))]
        number = 1
        while waiting and -waiting[0][0] >= least:
            front = [heapq.heappop(waiting)]
            while waiting and len(front) < FRONT and -waiting[0][0] >= least:
                front.append(heapq.heappop(waiting))
            low, high = np.stack([x[2] for x in front]), np.stack([x[3] for x in front])
            split = np.array([x[4] for x in front], dtype=np.int64)
            keys = lists[None, :] * np.int64(self.size + 1) + split[:, None]
            at = np.searchsorted(self.keys, keys)
            hit = self.keys[np.minimum(at, last)] == keys
            scores = np.where(hit, self.impacts[np.minimum(at, last)] * times, 0).sum(axis=1)
            for score, doc in zip(scores.tolist(), split.tolist(), strict=True):
                if score >= least:
                    found.append((score, doc))
                    heapq.heappush(ranks, score)
                    if len(ranks) > top:
                        heapq.heappop(ranks)
            if len(ranks) == top:
                least = max(least, ranks[0])
            low, high = np.concatenate([low, at + hit]), np.concatenate([at, high])  # before and after the split
            bound, split = bounded(low, high)
            for i in np.flatnonzero(bound >= least).tolist():
                heapq.heappush(waiting, (-int(bound[i]), number, low[i], high[i], int(split[i])))
                number += 1
        return [x for x in found if x[0] >= least]


def _searched(queries: list[Query], weights: np.ndarray, n_docs: int, n_terms: int, top: int):
    """item, doc_id, score of the best documents of a task's blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, bool, int]]] = [[] for _ in queries]  # (-score, id is null, id), in order
        for batch in batches:
            for row in range(batch.num_rows):
                lengths, terms, ends, docs, counts = (
                    batch.column(c)[row].values.to_numpy(zero_copy_only=False).astype(np.int64) for c in ("lengths", "terms", "ends", "docs", "counts")
                )
                if not len(docs):
                    continue
                ids = batch.column("ids")[row].values
                long = 75 + 25 * lengths * n_docs // n_terms
                weight = np.repeat(weights[terms], np.diff(ends, prepend=0))
                block = Block(terms, ends, docs, weight * (1000000000 * counts // (1000 * counts + 12 * long[docs])), len(lengths))
                for query, known in zip(queries, best, strict=True):
                    at = np.minimum(np.searchsorted(terms, query.terms), len(terms) - 1)
                    here = terms[at] == query.terms
                    if not here.any():
                        continue
                    least = -known[-1][0] if len(known) == top else 1
                    found = block.best(at[here], query.times[here], least, top)
                    if found:
                        names = ids.take(pa.array([d for _, d in found])).to_pylist()
                        known.extend((-s, i is None, i or 0) for (s, _), i in zip(found, names, strict=True))
                        known.sort()
                        del known[top:]
        rows = [(q.number, None if null else i, -s) for q, known in zip(queries, best, strict=True) for s, null, i in known]
        columns = zip(*rows, strict=True) if rows else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])

    return run


def weights_of(frequencies: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 * ln((2 N + 2) / (2 df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for f in frequencies.tolist()], dtype=np.int64)


def _queries(rows: list, vocabulary: np.ndarray) -> list[Query]:
    items = np.array([r["item"] for r in rows], dtype=np.int64)
    terms = np.searchsorted(vocabulary, np.array([r["h"] for r in rows], dtype=np.int64).view(np.uint64))
    times = np.array([r["times"] for r in rows], dtype=np.int64)
    order = np.lexsort((terms, items))
    items, terms, times = items[order], terms[order], times[order]
    first = np.flatnonzero(np.diff(items, prepend=-1))
    return [Query(int(items[a]), terms[a:b], times[a:b]) for a, b in zip(first, [*first[1:], len(items)], strict=True)]


def ranked(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of every item."""
    spark = docs.sparkSession
    asked = items.select(items[item_id].alias("item_id"), F.coalesce(items[text].cast("string"), F.lit("")).alias("text")).distinct()
    asked = staged(asked.withColumn("item", F.monotonically_increasing_id()), "items")
    schema = "item bigint, h bigint, times bigint"
    terms = staged(over_batches(asked.select("item", "text"), _item_terms, schema), "item-terms")
    passes = max(1, -(-terms.count() // TERMS))
    texts = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].cast("string").alias("text"))
    found = spark.createDataFrame([], "item bigint, doc_id bigint, score bigint")
    for k in range(passes):
        rows = terms.filter(F.pmod(F.xxhash64("item"), F.lit(passes)) == k).collect()  # about TERMS rows
        if not rows:
            continue
        vocabulary = np.unique(np.array([r["h"] for r in rows], dtype=np.int64).view(np.uint64))
        blocks = staged(over_batches(texts, _blocks_of(vocabulary), _BLOCK), "posting-blocks")
        total = blocks.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
        if not total["terms"]:
            continue
        held = F.explode(F.expr("transform(terms, (t, i) -> named_struct('t', t, 'n', ends[i] - IF(i = 0, 0, ends[i - 1])))")).alias("e")
        frequencies = np.zeros(len(vocabulary), dtype=np.int64)
        for r in blocks.select(held).groupBy("e.t").agg(F.sum("e.n").alias("n")).collect():  # one row a term
            frequencies[r["t"]] = r["n"]
        search = _searched(_queries(rows, vocabulary), weights_of(frequencies, total["docs"]), total["docs"], total["terms"], top)
        columns = ["ids", "lengths", "terms", "ends", "docs", "counts"]
        found = found.unionByName(over_batches(blocks.select(*columns), search, "item bigint, doc_id bigint, score bigint"))
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranks = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranks.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
