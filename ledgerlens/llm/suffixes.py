"""Substring dedup on bytes by deep-shallow suffix sorting.

A string of ``WINDOW`` bytes is repeated if it also starts anywhere else. To find them
all without sorting every suffix of the corpus:

1. Every window has an anchor, the 32-byte gram of least hash in it. Windows that share
   one form a run. Only runs whose anchor repeats somewhere can hold repeated windows.
2. Runs whose whole span repeats are settled. One run of each settled kind stays as a
   witness where its anchor has other runs.
3. The other runs of an anchor meet in one task. The suffixes from the anchor rightwards
   and the reversed prefixes leftwards are sorted: multikey quicksort over 8-byte
   characters to a shallow depth, then a blind trie for each group with a longer
   common prefix. Longest common prefixes of neighbours then tell for every distance
   from the anchor which windows are equal, byte for byte.
4. Anchors with more than ``CROWD`` such runs, as at the edge of a passage that very many
   texts share, are not gathered: 96-bit hashes are counted, combined before the shuffle.
   First those of ``BLOCK`` windows together: if all they cover repeats, so do they; if
   what they have in common does not, none of them does. Then those of the single
   windows of the other blocks.

Copies of a whole text are counted, not compared. Null and empty texts have no bytes.
Null or repeated ids are legal, equal rows give equal results, an empty table gives an
empty result, other columns pass through, but ``dedup`` is replaced. A long text is
looked at in overlapping parts, so that memory follows no text's length but for the
arrays of its own bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import words as W
from ledgerlens.llm.staging import distinct_texts, keyed_texts, over_batches, staged
from ledgerlens.llm.substrings import Runs

WINDOW = 200
GRAM = 32
SHALLOW = 32
CROWD = 1024
BLOCK = 13
#: Contexts that are sorted at a time; one anchor has at most CROWD.
LOT = 2048


# -- deep-shallow sorting ------------------------------------------------------------


def _common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def blind_trie(strings: list[bytes], depth: int = 0) -> list[int]:
    """Sorted order of strings that agree up to ``depth``.

    Inner nodes know the place they branch at and nothing of the skipped bytes: a string
    walks down blindly to some leaf, is compared with it once, and enters where the two part.
    """

    def at(i: int, place: int) -> int:
        return strings[i][place] if place < len(strings[i]) else -1

    root: list | int | None = None  # a leaf is a list of equal strings: (-1, [numbers]); a node: (place, {byte: child})
    for i in range(len(strings)):
        if root is None:
            root = (-1, [i])
            continue
        node = root
        while node[0] >= 0:
            node = node[1].get(at(i, node[0])) or next(iter(node[1].values()))
        like = node[1][0]
        shared = depth + _common(strings[i][depth:], strings[like][depth:])
        if shared == len(strings[i]) == len(strings[like]):
            node[1].append(i)
            continue
        parent, key, node = None, None, root
        while 0 <= node[0] < shared:
            parent, key, node = node, at(i, node[0]), node[1][at(i, node[0])]
        if node[0] == shared:
            node[1][at(i, shared)] = (-1, [i])
            continue
        fresh = (shared, {at(like, shared): node, at(i, shared): (-1, [i])})
        if parent is None:
            root = fresh
        else:
            parent[1][key] = fresh
    out: list[int] = []
    stack = [root] if root is not None else []
    while stack:
        node = stack.pop()
        if node[0] < 0:
            out.extend(node[1])
        else:
            stack.extend(node[1][k] for k in sorted(node[1], reverse=True))
    return out


def sort_strings(table: np.ndarray, lengths: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a zero-padded byte table by group and content, and what each shares with the one before.

    Multikey quicksort with characters of eight bytes up to ``SHALLOW``: every round parts all
    groups that are still tied in three around a pivot, the middle one in its next character.
    What is tied at that depth goes into blind tries, which begin there.
    """
    n, width = table.shape
    padded = np.zeros((n, -(-max(width, 8) // 8) * 8), dtype=np.uint8)
    padded[:, :width] = table
    characters = padded.view(">u8")
    deepest = min(SHALLOW // 8, characters.shape[1])
    order = np.argsort(groups, kind="stable")
    fresh = np.ones(n, dtype=bool)  # where a part begins
    fresh[1:] = groups[order][1:] != groups[order][:-1]
    depth = np.zeros(n, dtype=np.int64)  # characters that a part is known to agree in
    while True:
        alone = fresh & np.append(fresh[1:], True)
        where = np.flatnonzero(~alone & (depth < deepest))
        if not len(where):
            break
        rows, first = order[where], np.flatnonzero(fresh[where])
        sizes = np.diff(np.append(first, len(where)))
        part = np.repeat(np.arange(len(first)), sizes)
        keys = characters[rows, depth[where]].astype(np.uint64)
        pivots = keys[first + sizes // 2][part]
        side = 1 + (keys > pivots).astype(np.int64) - (keys < pivots)
        inner = np.argsort(3 * part + side, kind="stable")  # below, at and above the part's pivot
        order[where] = rows[inner]
        side, known = side[inner], depth[where]
        fresh[where[1:]] |= (side[1:] != side[:-1]) | (part[1:] != part[:-1])
        depth[where] = known + (side == 1)
    first = np.flatnonzero(fresh)
    sizes = np.diff(np.append(first, n))
    for begin, size in zip(first[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
        members = order[begin : begin + size]
        agreed = min(8 * deepest, int(lengths[members].min()))
        inner = blind_trie([table[m, : lengths[m]].tobytes() for m in members], agreed)
        order[begin : begin + size] = members[inner]
    shared = np.zeros(n, dtype=np.int64)
    if n > 1:
        a, b = order[1:], order[:-1]
        least = np.minimum(lengths[a], lengths[b])
        differs = np.concatenate([table[a] != table[b], np.ones((n - 1, 1), dtype=bool)], axis=1)
        shared[1:] = np.where(groups[a] == groups[b], np.minimum(differs.argmax(axis=1), least), -1)
    shared[:1] = -1
    return order, shared


def _table(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, step: int) -> np.ndarray:
    """Bytes from each start, onwards (1) or backwards (-1), padded with zeros."""
    width = int(lengths.max(initial=0))
    reach = np.arange(width)
    places = np.clip(starts[:, None] + step * reach[None, :], 0, max(len(data) - 1, 0))
    return np.where(reach[None, :] < lengths[:, None], data[places], 0).astype(np.uint8)


def repeated_offsets(data: np.ndarray, starts: np.ndarray, anchors: np.ndarray, ends: np.ndarray, groups: np.ndarray, known: np.ndarray, window: int) -> np.ndarray:
    """For each context data[start:end] and each distance o, whether its window from ``anchor - o`` occurs twice in the group."""
    n = len(starts)
    left, right = anchors - starts, ends - anchors
    sides = []
    for begin, length, step in ((anchors, right, 1), (anchors - 1, left, -1)):
        order, shared = sort_strings(_table(data, begin, length, step), length, groups)
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n)
        sides.append((place, shared))
    (place_r, shared_r), (place_l, shared_l) = sides
    least, most = window - right, left  # distances of the context's own windows
    out = np.zeros((n, int(most.max(initial=0)) + 1), dtype=bool)
    for o in range(int(least.min(initial=0)), out.shape[1]):
        here = np.flatnonzero((least <= o) & (o <= most))
        if not len(here):
            continue
        kind = np.cumsum(shared_r < window - o)[place_r[here]] * np.int64(n + 1) + np.cumsum(shared_l < o)[place_l[here]]
        _, back, count = np.unique(kind, return_inverse=True, return_counts=True)
        count = count + np.bincount(back, weights=known[here], minlength=len(count))
        out[here, o] = count[back] > 1
    return out


# -- the levels ----------------------------------------------------------------------


def _in_slices(batch: pa.RecordBatch, window: int) -> Iterator[tuple[int, int, np.ndarray, Runs]]:
    """First and last text, where each text's own first byte would stand, and runs; a long text comes in parts."""
    data, offsets = W.text_bytes(batch.column("text"))
    for first, last in W.slices(offsets):
        begin, size = int(offsets[first]), int(offsets[last] - offsets[first])
        for a, b in W.pieces(size, window) if last == first + 1 else [(0, size)]:
            bounds = offsets[first : last + 1] - begin if last > first + 1 else np.array([0, b - a])
            values = W.BYTE_VALUES[data[begin + a : begin + b]]
            yield first, last, bounds - a, Runs(values, bounds, window, min(GRAM, window))


def _owned(h: np.ndarray, owner: np.ndarray) -> np.ndarray:
    return W.mix(h + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _list(batch: pa.RecordBatch, name: str, first: int, last: int) -> np.ndarray:
    part = batch.column(name).slice(first, last - first)
    lengths = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return _owned(part.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), np.repeat(np.arange(last - first), lengths))


def _anchors_of(window: int):
    """g, node, n of each different anchor of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies, node = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("copies", "node"))
            for first, _, _, runs in _in_slices(batch, window):
                g = runs.grams[runs.at] if len(runs.at) else np.empty(0, np.uint64)
                _, once, times = np.unique(_owned(g, runs.run_owner), return_index=True, return_counts=True)
                owner = runs.run_owner[once] + first
                n = np.where((times > 1) | (copies[owner] > 1), 2, 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g[once].view(np.int64)), pa.array(node[owner]), pa.array(n.astype(np.int32))], names=["g", "node", "n"]
                )

    return run


def _spans_of(window: int):
    """h, c, g, node, n and place (in its text), size, anchor of each run whose anchor repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies, node = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("copies", "node"))
            for first, last, zero, runs in _in_slices(batch, window):
                if not len(runs.at):
                    continue
                pick = np.flatnonzero(np.isin(_owned(runs.grams[runs.at], runs.run_owner), _list(batch, "anchors", first, last)))
                begin, end, at = runs.first[pick], runs.last[pick] + window, runs.at[pick]
                h, c = (W.range_hashes(runs.hashes, begin, end, seed=k) for k in (0, 1))
                mine = runs.run_owner[pick]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h.view(np.int64)),
                        pa.array((c >> np.uint64(33)).astype(np.int32)),
                        pa.array(runs.grams[at].view(np.int64)),
                        pa.array(node[mine + first]),
                        pa.array(np.where(copies[mine + first] > 1, 2, 1).astype(np.int32)),
                        pa.array(begin - zero[mine]),
                        pa.array((end - begin).astype(np.int32)),
                        pa.array((at - begin).astype(np.int32)),
                    ],
                    names=["h", "c", "g", "node", "n", "place", "size", "anchor"],
                )

    return run


def _contexts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the listed spans of each text."""
    for batch in batches:
        data, offsets = W.text_bytes(batch.column("text"))
        lists = batch.column("spans")
        entries, sizes = lists.flatten(), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(lists)), sizes)
        begin = offsets[owner] + entries.field("place").to_numpy(zero_copy_only=False)
        size = entries.field("size").to_numpy(zero_copy_only=False)
        cut = pa.array([data[b : b + s].tobytes() for b, s in zip(begin.tolist(), size.tolist(), strict=True)], pa.binary())
        node = batch.column("node").take(pa.array(owner))
        yield pa.RecordBatch.from_arrays(
            [entries.field("g"), node, entries.field("place"), entries.field("anchor"), entries.field("known"), cut],
            names=["g", "node", "place", "anchor", "known", "bytes"],
        )


_RANGES = "node bigint, begin bigint, end bigint"


def _ranges(node: np.ndarray, anchor_place: np.ndarray, hit: np.ndarray, window: int) -> pa.RecordBatch:
    """Runs of repeated windows as byte ranges of their texts."""
    edges = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, low = np.nonzero(edges == 1)
    _, high = np.nonzero(edges == -1)
    begin, end = anchor_place[row] - (high - 1), anchor_place[row] - low + window
    return pa.RecordBatch.from_arrays([pa.array(node[row]), pa.array(begin), pa.array(end)], names=["node", "begin", "end"])


def _sorted_groups(window: int):
    """Repeated byte ranges of contexts that come ordered by anchor."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        column = lambda c: rows.column(c).to_numpy()
        sizes = np.array([len(x) for x in rows.column("bytes").to_pylist()], dtype=np.int64)
        data = np.frombuffer(b"".join(rows.column("bytes").to_pylist()), np.uint8)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        anchors = starts + column("anchor")
        _, groups = np.unique(column("g"), return_inverse=True)
        hit = repeated_offsets(data, starts, anchors, ends, groups, column("known").astype(np.int64), window)
        return _ranges(column("node"), column("place") + column("anchor"), hit, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None  # the last anchor may go on in the next batch
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if kept is None else pa.concat_tables([kept, rows])
            g = rows.column("g").to_numpy()
            whole = int(np.searchsorted(g, g[-1])) if len(g) else 0
            done = 0
            while done < whole:  # anchors of about LOT contexts together
                far = min(done + LOT, whole)
                far = whole if far == whole else max(int(np.searchsorted(g, g[far])), int(np.searchsorted(g, g[done], side="right")))
                yield solve(rows.slice(done, far - done))
                done = far
            kept = rows.slice(whole)
        if kept is not None and kept.num_rows:
            yield solve(kept)

    return run


def _blocks(batch: pa.RecordBatch, window: int):
    """Bytes of all contexts, and for each block its context, first and last window, and the part that all windows
    of a whole block share (places in the bytes)."""
    cut = batch.column("bytes").to_pylist()
    data = np.frombuffer(b"".join(cut), np.uint8)
    bounds = np.cumsum([0, *map(len, cut)])
    starts = W.window_starts(bounds, window)
    owner = np.searchsorted(bounds, starts, side="right") - 1
    # Blocks are cut by distance from the anchor, so that they compare between contexts.
    distance = bounds[owner] + batch.column("anchor").to_numpy(zero_copy_only=False)[owner] - starts
    change = np.ones(len(starts), dtype=bool)
    change[1:] = (owner[1:] != owner[:-1]) | (distance[1:] // BLOCK != distance[:-1] // BLOCK)
    first = np.flatnonzero(change)
    last = np.append(first[1:], len(starts)) - 1
    near = starts[first] + distance[first] - distance[first] // BLOCK * BLOCK  # start of the block's nearest window
    return data, bounds, owner[first], starts[first], starts[last], (near, near - BLOCK + 1 + window)


def _hashed(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[pa.Array]:
    values = W.BYTE_VALUES[data]
    h, c = (W.range_hashes(values, begin, end, seed=k) for k in (0, 1))
    return [pa.array(h.view(np.int64)), pa.array((c >> np.uint64(33)).astype(np.int32))]


def _block_rows(window: int):
    """For each block of crowded contexts: hash of all it covers (kind 0) and of what its windows share (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds, owner, first, last, shared = _blocks(batch, window)
            node, place, known = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("node", "place", "known"))
            for kind, begin, end in ((0, first, last + window), (1, *shared)):
                columns = [pa.array(node[owner]), pa.array(place[owner] + first - bounds[owner]), pa.array(np.full(len(owner), kind, np.int32))]
                yield pa.RecordBatch.from_arrays(
                    [*_hashed(data, begin, end), *columns, pa.array((last - first).astype(np.int32)), pa.array(known[owner].astype(np.int32) + 1)],
                    names=["h", "c", "node", "begin", "kind", "more", "n"],
                )

    return run


def _window_rows(window: int):
    """h, c, node, begin, n of every window of the blocks that are listed as open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds, owner, first, last, _ = _blocks(batch, window)
            node, place, known = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("node", "place", "known"))
            begin = place[owner] + first - bounds[owner]
            listed = [set(x or ()) for x in batch.column("open").to_pylist()]
            pick = np.array([b in listed[o] for b, o in zip(begin.tolist(), owner.tolist(), strict=True)], dtype=bool)
            owner, first, last = owner[pick], first[pick], last[pick]
            size = last - first + 1
            starts = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
            owner = np.repeat(owner, size)
            yield pa.RecordBatch.from_arrays(
                [*_hashed(data, starts, starts + window), pa.array(node[owner]), pa.array(place[owner] + starts - bounds[owner]), pa.array(known[owner].astype(np.int32) + 1)],
                names=["h", "c", "node", "begin", "n"],
            )

    return run


def _crowded(contexts: DataFrame, window: int) -> DataFrame:
    """Repeated byte ranges of the contexts of crowded anchors."""
    columns = "h bigint, c int, node bigint, begin bigint, kind int, more int, n int"
    blocks = staged(over_batches(contexts, _block_rows(window), columns), "crowd-blocks")
    me = F.struct("node", "begin")
    twice = blocks.groupBy("h", "c", "kind").agg(F.sum("n").alias("n"), F.min(me).alias("first")).filter("n > 1").drop("n")
    kinds = blocks.join(staged(twice, "crowd-repeats"), ["h", "c", "kind"]).withColumn("leads", (F.col("kind") == 0) & (F.col("first") == me))
    judged = staged(kinds.groupBy("node", "begin", "more").agg(F.min("kind").alias("kind"), F.max("leads").alias("leads")), "crowd-verdicts")
    settled = judged.filter("kind = 0").select("node", "begin", (F.col("begin") + F.col("more") + window).alias("end"))
    # One settled block of each kind speaks again, as a witness for blocks that are open.
    opened = judged.filter("kind = 1 OR leads").groupBy("node").agg(F.collect_list("begin").alias("open"))
    joined = contexts.join(staged(opened, "crowd-open"), "node")
    if judged.filter("kind = 1").isEmpty():
        return settled
    windows = staged(over_batches(joined, _window_rows(window), "h bigint, c int, node bigint, begin bigint, n int"), "crowd-windows")
    often = windows.groupBy("h", "c").agg(F.sum("n").alias("n")).filter("n > 1").select("h", "c")
    single = windows.join(staged(often, "crowd-repeats"), ["h", "c"]).select("node", "begin", (F.col("begin") + window).alias("end"))
    return settled.unionByName(single)


def _finish(window: int):
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes", "spans"]
    kinds = [pa.int64()] * 3 + [pa.string(), pa.binary(), pa.list_(pa.list_(pa.int64()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_bytes(batch.column("text"))
            copies = batch.column("copies").to_pylist()
            for first, last in W.slices(offsets):
                rows = []
                for i, ranges in enumerate(batch.column("ranges").slice(first, last - first).to_pylist(), first):
                    raw = data[offsets[i] : offsets[i + 1]]
                    gone = np.zeros(len(raw), dtype=bool)
                    if copies[i] > 1 and len(raw) >= window:
                        gone[:] = True
                    elif ranges:
                        begin, end = (np.array([r[k] for r in ranges]) for k in ("begin", "end"))
                        gone = W.covered(begin, end, len(raw))
                    edges = np.flatnonzero(np.diff(np.pad(gone.view(np.int8), 1)))
                    kept = raw[~gone].tobytes()
                    rows.append((len(raw), int(gone.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest(), kept, edges.reshape(-1, 2).tolist()))
                out = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                keys = [batch.column(k).slice(first, last - first) for k in ("k1", "k2")]
                yield pa.RecordBatch.from_arrays([*keys, *out], names=["k1", "k2", *names])

    return run


def removals(texts: DataFrame, window: int = WINDOW, with_bytes: bool = True) -> DataFrame:
    """k1, k2, n_bytes, n_removed, n_spans, kept_sha256, kept_bytes, spans ([first, end) bytes) of laid-out different texts."""
    keys = texts.select("node", "k1", "k2")
    base = ["k1", "k2", "node", "copies", "text"]

    def by_key(lists: DataFrame, label: str) -> DataFrame:
        return staged(lists.join(keys, "node").drop("node"), label)

    anchors = staged(over_batches(texts.select(*base), _anchors_of(window), "g bigint, node bigint, n int"), "anchors")
    twice = staged(anchors.groupBy("g").agg(F.sum("n").alias("n")).filter("n > 1").select("g"), "repeated-anchors")
    listed = by_key(anchors.join(twice, "g").groupBy("node").agg(F.collect_list("g").alias("anchors")), "anchor-lists")
    with_anchors = texts.select(*base).join(listed, ["k1", "k2"])
    columns = "h bigint, c int, g bigint, node bigint, n int, place bigint, size int, anchor int"
    spans = staged(over_batches(with_anchors, _spans_of(window), columns), "spans")
    same = staged(
        spans.groupBy("h", "c").agg(F.sum("n").alias("total"), F.min(F.struct("node", "place")).alias("first")).filter("total > 1").drop("total"),
        "repeated-spans",
    )
    judged = staged(
        spans.join(same, ["h", "c"], "left").select("g", "node", "place", "size", "anchor", F.col("first").isNotNull().alias("known"), (F.col("first") == F.struct("node", "place")).alias("leads")),
        "judged-spans",
    )
    left = staged(judged.filter("NOT known").select("g").distinct(), "open-anchors")
    shown = judged.filter("NOT known").unionByName(judged.filter("leads").join(left, "g", "left_semi")).drop("leads")
    picked = by_key(shown.groupBy("node").agg(F.collect_list(F.struct("g", "place", "size", "anchor", "known")).alias("spans")), "span-lists")
    contexts = over_batches(
        texts.select("k1", "k2", "node", "text").join(picked, ["k1", "k2"]).select("node", "text", "spans"),
        _contexts_of,
        "g bigint, node bigint, place bigint, anchor int, known boolean, bytes binary",
    )
    contexts = staged(contexts, "contexts")
    crowds = staged(contexts.groupBy("g").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD).select("g"), "crowds")
    few = contexts.join(crowds, "g", "left_anti").repartition("g").sortWithinPartitions("g")
    found = over_batches(few, _sorted_groups(window), _RANGES)
    crowded = _crowded(contexts.join(crowds, "g", "left_semi"), window)
    whole = judged.filter("known").select("node", F.col("place").alias("begin"), (F.col("place") + F.col("size")).alias("end"))
    ranges = found.unionByName(crowded).unionByName(whole).groupBy("node").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    state = texts.select("k1", "k2", "text", "copies").join(by_key(ranges, "ranges"), ["k1", "k2"], "left")
    schema = "k1 bigint, k2 bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_bytes binary, spans array<array<bigint>>"
    done = over_batches(state, _finish(window), schema)
    return done if with_bytes else done.drop("kept_bytes", "spans")


def digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row; kept bytes are not moved."""
    found = staged(removals(distinct_texts(docs, doc_id, text), window, with_bytes=False), "removals")
    rows = keyed_texts(docs, doc_id, text).select("doc_id", "k1", "k2")
    return rows.join(found, ["k1", "k2"]).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
