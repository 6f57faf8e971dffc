"""Substring dedup by level-wise doubling: only windows that repeat are extended to twice their length.

A window of ``WINDOW`` words is repeated if its words also start anywhere else, in the
same text or another one. Levels, each over all texts:

1. Grams of a quarter of the window, at the anchor of every window: the gram of least
   hash in it. Equal windows have equal anchors at equal places, so nothing is lost.
2. Grams of half the window at the anchors that repeat, to the right and, for windows
   that end too early, to the left.
3. Spans of all windows that share an anchor (one to two windows long), where the
   grams before survived. A repeated span settles all its windows.
4. Single windows of the spans that are left, and of one span of each settled kind
   whose anchor some span that is left has too.

A level gives each different hash of a text once, counts are combined before the
shuffle, and survivors return to their texts as lists. Copies of a whole text are
counted instead and need no level. Texts are shuffled once, into the layout by key
that every level reads. Hashes have 64 bits on the way and 96 bits at the levels that decide.

Null and blank texts have no words, texts shorter than a window keep all of theirs.
Null or repeated ids are legal, equal rows give equal results (their windows repeat in
each other), an empty table gives an empty result. Other columns of the input pass
through, whatever their names, but ``dedup`` is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import words as W
from ledgerlens.llm.staging import distinct_texts, keyed_texts, over_batches, settled, staged

WINDOW = 35
#: A longer text is looked at in parts of so many words.
PART_WORDS = 1 << 16


class Runs:
    """Runs of windows that share an anchor, over the items (by hash) of some texts."""

    def __init__(self, hashes: np.ndarray, bounds: np.ndarray, window: int, gram: int):
        self.hashes, self.window, self.gram = hashes, window, gram
        self.starts = W.window_starts(bounds, window)
        n = len(self.hashes)
        if len(self.starts):
            at = np.arange(n - self.gram + 1)
            self.grams = W.range_hashes(self.hashes, at, at + self.gram)
            self.anchor = W.anchors(self.grams, self.starts, window - self.gram + 1)
        else:
            self.grams, self.anchor = np.empty(0, np.uint64), np.empty(0, np.int64)
        # Runs of windows with one anchor; windows of one text follow one another.
        change = np.ones(len(self.starts), dtype=bool)
        change[1:] = (self.anchor[1:] != self.anchor[:-1]) | (np.diff(self.starts) != 1)
        first = np.flatnonzero(change)
        self.first = self.starts[first]
        self.last = self.starts[np.append(first[1:], len(self.starts)) - 1] if len(first) else self.first
        self.at = self.anchor[first]
        self.run_owner = np.searchsorted(bounds, self.at, side="right") - 1

    def level(self, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the run, start and end of each of its windows at this level."""
        runs = np.arange(len(self.at))
        if number == 1:
            return runs, self.at, self.at + self.gram
        if number == 2:
            double = 2 * self.gram
            # A window with room to the right of its anchor has the right half, the others the left one.
            right = self.at + double <= self.last + self.window
            left = self.first + self.window < self.at + double
            left &= self.at + self.gram - double >= self.first
            index = np.concatenate([runs[right], runs[left]])
            begin = np.concatenate([self.at[right], self.at[left] + self.gram - double])
            return index, begin, begin + double
        if number == 3:
            return runs, self.first, self.last + self.window
        size = self.last - self.first + 1
        index = np.repeat(runs, size)
        begin = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.first, size)
        return index, begin, begin + self.window


def _runs(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[W.Words, Iterator[tuple[int, Runs]]]:
    """The words of some texts and their runs; a long text alone comes in parts, each with the place of its first word."""
    words = W.Words(data, offsets)
    gram = max(1, -(-window // 4))

    def parts() -> Iterator[tuple[int, Runs]]:
        hashes = words.hashes()
        if len(offsets) > 2:
            yield 0, Runs(hashes, words.bounds, window, gram)
            return
        for begin, end in W.pieces(len(hashes), window, PART_WORDS):
            yield begin, Runs(hashes[begin:end], np.array([0, end - begin]), window, gram)

    return words, parts()


def _with_owner(hashes: np.ndarray, owners: np.ndarray) -> np.ndarray:
    return W.mix(hashes + owners.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _listed(column: pa.Array, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Values and owners (from 0) of the lists of some rows; null lists are empty."""
    part = column.slice(first, last - first)
    lengths = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return part.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), np.repeat(np.arange(last - first), lengths)


def _alive(texts: Runs, survivors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Runs that passed the levels of these survivors."""
    alive = np.ones(len(texts.at), dtype=bool)
    for number, (values, owners) in enumerate(survivors, 1):
        index, begin, end = texts.level(number)
        known = np.isin(_with_owner(W.range_hashes(texts.hashes, begin, end), texts.run_owner[index]), _with_owner(values, owners))
        passed = np.zeros(len(texts.at), dtype=bool)
        passed[index[known]] = True  # at level 2 one half is enough to stay
        alive &= passed
    return alive


def _emit(number: int, window: int):
    """Each different window of a text at this level: h, c, g (its anchor), k1, k2, n (2: known to repeat)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_bytes(batch.column("text"))
            copies = batch.column("copies").to_numpy(zero_copy_only=False)
            k1, k2 = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("k1", "k2"))
            for first, last in W.slices(offsets):
                _, parts = _runs(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], window)
                lists = [_listed(batch.column(f"s{i}"), first, last) for i in range(1, min(number, 3))]
                for _, texts in parts:
                    alive = _alive(texts, lists)
                    known = np.zeros(len(alive), dtype=bool)
                    if number == 4:
                        _, begin, end = texts.level(3)
                        spans = _with_owner(W.range_hashes(texts.hashes, begin, end), texts.run_owner)
                        known = np.isin(spans, _with_owner(*_listed(batch.column("s3"), first, last)))
                        alive &= ~known | np.isin(spans, _with_owner(*_listed(batch.column("lead"), first, last)))
                    index, begin, end = texts.level(number)
                    pick = alive[index]
                    index, begin, end = index[pick], begin[pick], end[pick]
                    owner, known = texts.run_owner[index], known[index]
                    h = W.range_hashes(texts.hashes, begin, end)
                    _, once, times = np.unique(_with_owner(h, owner), return_index=True, return_counts=True)
                    owner, known = owner[once] + first, known[once]
                    check = W.range_hashes(texts.hashes, begin[once], end[once], seed=1) if number > 2 else np.zeros(len(once), np.uint64)
                    g = texts.grams[texts.at[index[once]]] if number == 3 else np.zeros(len(once), np.uint64)
                    n = np.where(known | (times > 1) | (copies[owner] > 1), 2, 1)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(h[once].view(np.int64)),
                            pa.array((check >> np.uint64(33)).astype(np.int32)),
                            pa.array(g.view(np.int64)),
                            pa.array(k1[owner]),
                            pa.array(k2[owner]),
                            pa.array(n.astype(np.int32)),
                        ],
                        names=["h", "c", "g", "k1", "k2", "n"],
                    )

    return run


def _finish(window: int):
    """n_words, n_removed, hash and kept words of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_bytes(batch.column("text"))
            copies = batch.column("copies").to_numpy(zero_copy_only=False)
            for first, last in W.slices(offsets):
                part = data[offsets[first] : offsets[last]]
                words, parts = _runs(part, offsets[first : last + 1] - offsets[first], window)
                lists = [_listed(batch.column(f"s{i}"), first, last) for i in (3, 4)]
                out = np.zeros(len(words), dtype=bool)
                for at, texts in parts:
                    here = out[at : at + len(texts.hashes)]
                    for number, survivors in zip((3, 4), lists, strict=True):
                        index, begin, end = texts.level(number)
                        known = np.isin(_with_owner(W.range_hashes(texts.hashes, begin, end), texts.run_owner[index]), _with_owner(*survivors))
                        here |= W.covered(begin[known], end[known], len(here))
                size = np.diff(words.bounds)
                whole = (copies[first:last] > 1) & (size >= window)
                out |= np.repeat(whole, size)
                raw = part.tobytes()
                rows = []
                starts, ends = words.starts.tolist(), words.ends.tolist()
                for i in range(last - first):
                    a, b = int(words.bounds[i]), int(words.bounds[i + 1])
                    gone = out[a:b]
                    removed = int(gone.sum())
                    stay = np.flatnonzero(~gone) + a
                    kept = b" ".join([raw[starts[j] : ends[j]] for j in stay.tolist()])
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                    rows.append((b - a, removed, hashlib.sha256(kept).hexdigest(), kept.decode(), edges.reshape(-1, 2).tolist()))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("k1").slice(first, last - first),
                        batch.column("k2").slice(first, last - first),
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.int64()),
                        pa.array(columns[2], pa.string()),
                        pa.array(columns[3], pa.string()),
                        pa.array(columns[4], pa.list_(pa.list_(pa.int64()))),
                    ],
                    names=["k1", "k2", "n_words", "n_removed", "kept_sha256", "kept_text", "spans"],
                )

    return run


def _survivors(found: DataFrame, number: int) -> DataFrame:
    """k1, k2 and the hashes of the text's windows that repeat at this level.

    ``lead``: those of them for which this text speaks for all that have them.
    """
    rows = staged(found if number == 3 else found.drop("g"), f"windows-{number}")
    totals = rows.groupBy("h", "c").agg(F.sum("n").alias("n"), *([F.min(F.struct("k1", "k2")).alias("first")] if number == 3 else []))
    again = staged(totals.filter("n > 1").drop("n"), f"repeated-{number}")
    if number != 3:
        return rows.join(again, ["h", "c"]).groupBy("k1", "k2").agg(F.collect_list("h").alias(f"s{number}"))
    settled = rows.join(again, ["h", "c"], "left").select("h", "g", "k1", "k2", "first")
    settled = staged(settled.withColumn("leads", F.struct("k1", "k2") == F.col("first")), "spans")
    left = staged(settled.filter("first IS NULL").select("g").distinct(), "open-anchors")
    leads = settled.filter("leads").join(left, "g", "left_semi").groupBy("k1", "k2").agg(F.collect_list("h").alias("lead"))
    return settled.filter("first IS NOT NULL").groupBy("k1", "k2").agg(F.collect_list("h").alias("s3")).join(leads, ["k1", "k2"], "left")


def removals(texts: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """k1, k2, n_words, n_removed, kept_sha256, kept_text, spans ([first, end) words) of laid-out different texts."""
    if window < 2:
        raise ValueError("a window has two words at least")
    state = texts
    for number in range(1, 5):
        candidates = state if number == 1 else state.filter(f"s{number - 1 if number < 4 else 2} IS NOT NULL")
        columns = ["k1", "k2", "text", "copies", *(f"s{i}" for i in range(1, number)), *["lead"] * (number == 4)]
        found = over_batches(candidates.select(*columns), _emit(number, window), "h bigint, c int, g bigint, k1 bigint, k2 bigint, n int")
        survivors = settled(texts.sparkSession, f"survivors-{number}", partial(_survivors, found, number))
        state = state.join(survivors, ["k1", "k2"], "left")
    schema = "k1 bigint, k2 bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string, spans array<array<bigint>>"
    done = over_batches(state.select("k1", "k2", "text", "copies", "s1", "s2", "s3", "s4"), _finish(window), schema)
    return done if with_text else done.drop("kept_text", "spans")


def cleaned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with a struct column ``dedup``: n_words, n_removed, kept_sha256, kept_text, spans."""
    results = settled(docs.sparkSession, "removals", lambda: removals(distinct_texts(docs, doc_id, text), window))
    kept = [c for c in docs.columns if c != "dedup"]
    return _joined(docs, results, kept, text)


def digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row; kept texts are not moved."""
    found = settled(docs.sparkSession, "removals", lambda: removals(distinct_texts(docs, doc_id, text), window, with_text=False))
    rows = keyed_texts(docs, doc_id, text).select("doc_id", "k1", "k2")
    return rows.join(found, ["k1", "k2"]).select("doc_id", "n_words", "n_removed", "kept_sha256")


def _joined(docs: DataFrame, results: DataFrame, kept: list[str], text: str) -> DataFrame:
    digest_of = F.sha2(F.coalesce(docs[text].cast("string"), F.lit("")), 256)
    keys = [F.conv(F.substring(digest_of, at, 16), 16, -10).cast("bigint").alias(k) for at, k in ((1, "_k1"), (17, "_k2"))]
    rows = docs.select(F.struct(*(docs[c] for c in kept)).alias("_row"), *keys)
    values = F.struct(*(results[c] for c in ("n_words", "n_removed", "kept_sha256", "kept_text", "spans")))
    joined = rows.join(results, (rows["_k1"] == results["k1"]) & (rows["_k2"] == results["k2"]))
    return joined.select("_row", values.alias("dedup")).select("_row.*", "dedup")
