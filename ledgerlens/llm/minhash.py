"""Near-duplicate classes by DartMinHash: weighted Jaccard similarity of word shingles.

A text is the multiset of its runs of five words (a shorter one: of its only run). For
each shingle of weight w, darts are thrown at the plane of weight and rank: the plane
is cut into cells of area one, each cell's hash says how many darts it holds (Poisson
with mean one) and where. Darts below w and below the rank ``DARTS / total weight``
hit; each falls into one of ``COORDINATES`` coordinates, which keeps its earliest. Two
texts agree in a coordinate with a chance equal to their similarity. Texts with an
empty coordinate are thrown again with twice the rank.

Candidates are texts that agree in a band of ``ROWS`` coordinates (at similarity 0.8,
three in a million pairs agree in none of ``BANDS``). Every candidate pair that the
signatures do not rule out (by six standard deviations) is compared by its shingles.

No bucket's members are paired off with each other at first: each meets the bucket's
first member. Where the classes found so far leave a bucket divided, members outside
its largest class meet a few of that class, as long as a round links some of them, which
joins nearly all of a large group. What is still divided then meets everything in its bucket that is of
another class, so no link is lost.

A divided bucket's members are paired under a condition that is part of the join: an
odd sketch (one bit of parity for each of 1,024 slots of shingles) bounds from below
how much two texts differ. It is exact in that it rules out no link, so the pairs that
leave the join are nearly links, however many members a bucket has. For texts of many
thousands of words, whose permitted difference exceeds the slots, only their lengths
and signatures rule out pairs.

Copies of a text are one node with a count. Null, empty and blank texts are alone in
their classes, repeated rows are copies, ids may be null or repeated, an empty table
gives an empty result. Other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm import words as W
from ledgerlens.llm.staging import distinct_texts, keyed_texts, over_batches, settled, staged

SHINGLE = 5
#: Similarity from which two texts are near copies, as a fraction.
SIMILAR = (4, 5)
#: Rounds in which a divided bucket's outsiders meet so many members of its largest class.
ROUNDS, LEADS = 3, 4
ROWS, BANDS = 6, 42
COORDINATES = ROWS * BANDS
DARTS = math.ceil(COORDINATES * math.log(COORDINATES)) + 2 * COORDINATES
#: Cells of the plane that are looked at together.
CELLS = 1 << 17
#: Edges that one task of a star round takes at least; so many rows of one task need no shuffle.
EDGES = 500_000
#: Members of open buckets, with their sketches, that one task takes at least.
MEMBERS = 100_000
#: A round that links fewer than this share of the members it opened is followed by the last one.
WORTHWHILE = 0.01
#: Pairs whose signatures one task compares at least.
PAIRS = 5_000
#: 64-bit words of an odd sketch.
SKETCH = 16
#: Six standard deviations of the agreement at the least similarity.
_SLACK = 6 * math.sqrt(0.16 / COORDINATES)
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(20)])
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and count of each different shingle, by text."""
    words = W.Words(data, offsets)
    hashes = words.hashes()
    starts = W.window_starts(words.bounds, size)
    ends = starts + size
    lengths = np.diff(words.bounds)
    short = np.flatnonzero((lengths > 0) & (lengths < size))
    starts, ends = np.concatenate([starts, words.bounds[short]]), np.concatenate([ends, words.bounds[short + 1]])
    h = W.range_hashes(hashes, starts, ends)
    owner = words.owners()[starts] if len(starts) else np.empty(0, np.int64)
    _, once, counts = np.unique(W.mix(h + owner.astype(np.uint64) * _STEP), return_index=True, return_counts=True)
    order = np.argsort(owner[once], kind="stable")
    return h[once][order], owner[once][order], counts[order]


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _throw(h: np.ndarray, owner: np.ndarray, weight: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text, coordinate, rank and identity of all darts that hit; ``rank``: the limit of each text."""
    reach = np.cumsum(np.ceil(rank[owner]))
    cuts = [0, *(np.flatnonzero(np.diff(reach // CELLS)) + 1).tolist(), len(h)]
    thrown = [_thrown(h[a:b], owner[a:b], weight[a:b], rank) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]
    return tuple(np.concatenate(x) for x in zip(*thrown, strict=True)) if thrown else _thrown(h, owner, weight, rank)


def _thrown(h: np.ndarray, owner: np.ndarray, weight: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
    parts, level = [], 0
    while len(h):
        wide = float(1 << level)
        cells = np.ceil(rank[owner] * wide).astype(np.int64)
        of = np.repeat(np.arange(len(h)), cells)
        row = np.arange(len(of)) - np.repeat(np.cumsum(cells) - cells, cells)
        seed = W.mix(h[of] + W.mix(row.astype(np.uint64) * _STEP + np.uint64(level + 1)))
        darts = np.searchsorted(_POISSON, _unit(seed))
        of2 = np.repeat(np.arange(len(of)), darts)
        nth = np.arange(len(of2)) - np.repeat(np.cumsum(darts) - darts, darts)
        dart = W.mix(seed[of2] + (nth + 1).astype(np.uint64) * _STEP)
        high = wide - 1 + wide * _unit(dart)
        dart = W.mix(dart + _STEP)
        at = (row[of2] + _unit(dart)) / wide
        element = of[of2]
        hit = (high < weight[element]) & (at < rank[owner[element]])
        dart = W.mix(dart[hit] + _STEP)
        parts.append((owner[element[hit]], (dart % np.uint64(COORDINATES)).astype(np.int64), at[hit], dart))
        level += 1
        more = weight >= 1 << level
        h, owner, weight = h[more], owner[more], weight[more]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else tuple(np.empty(0, t) for t in (np.int64, np.int64, np.float64, np.uint64))


def signatures(h: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """n x COORDINATES earliest darts, and the total weight of each text; rows of texts without shingles are 0."""
    total = np.bincount(owner, weights=weight, minlength=n)
    out = np.zeros((n, COORDINATES), dtype=np.uint64)
    limit = DARTS / np.maximum(total, 1)
    todo = total > 0
    while todo.any():
        mine = todo[owner]
        text, coordinate, at, dart = _throw(h[mine], owner[mine], weight[mine], limit)
        order = np.argsort(-at, kind="stable")  # the earliest is written last
        out[todo] = 0
        filled = np.zeros((n, COORDINATES), dtype=bool)
        out[text[order], coordinate[order]] = dart[order]
        filled[text, coordinate] = True
        todo &= ~filled.all(axis=1)
        limit[todo] *= 2
    return out, total.astype(np.int64)


def sketches(h: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """n x SKETCH words: each bit is the parity of the number of shingles, repeats counted, in its slot."""
    of = np.repeat(np.arange(len(h)), weight)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(weight) - weight, weight)
    slot = W.mix(h[of] + nth.astype(np.uint64) * _STEP) >> np.uint64(64 - (SKETCH * 64 - 1).bit_length())
    counts = np.bincount(owner[of] * (SKETCH * 64) + slot.astype(np.int64), minlength=n * SKETCH * 64)
    return np.packbits(counts & 1 == 1, bitorder="little").view("<u8").reshape(n, SKETCH)


def _apart(x: str, y: str) -> str:
    """SQL: the least number of shingles, repeats counted, that only one of two texts has."""
    return " + ".join(f"bit_count({x}[{i}] ^ {y}[{i}])" for i in range(SKETCH))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = W.text_bytes(batch.column("text"))
        for first, last in W.slices(offsets):
            found = shingles(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
            marks, total = signatures(*found, last - first)
            some = np.flatnonzero(total)
            flat = marks[some].reshape(-1)
            begin = np.arange(0, len(flat), ROWS)
            bands = W.range_hashes(flat, begin, begin + ROWS) + np.tile(np.arange(BANDS, dtype=np.uint64), len(some)) * _STEP
            keys = [batch.column(c).slice(first, last - first).take(pa.array(some)) for c in ("node", "k1", "k2")]
            codes = (marks[some] >> np.uint64(56)).astype(np.uint8)
            odd = sketches(*found, last - first)[some].reshape(-1)
            lists = [
                pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * size), pa.array(flat.view(np.int64)))
                for flat, size in ((odd, SKETCH), (bands, BANDS))
            ]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array(total[some]), pa.array([c.tobytes() for c in codes], pa.binary()), *lists],
                names=["node", "k1", "k2", "total", "code", "odd", "bands"],
            )


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that total weights and signatures do not rule out."""
    least = (SIMILAR[0] / SIMILAR[1] - _SLACK) * COORDINATES
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, COORDINATES) for c in ("code_a", "code_b"))
        ta, tb = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("total_a", "total_b"))
        keep = ((a == b).sum(axis=1) >= least) & (np.minimum(ta, tb) * SIMILAR[1] >= np.maximum(ta, tb) * SIMILAR[0])
        rows = pa.array(np.flatnonzero(keep))
        names = ["a", "b", "a1", "a2", "b1", "b2"]
        yield pa.RecordBatch.from_arrays([batch.column(c).take(rows) for c in names], names=names)


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose texts are similar enough, by all their shingles."""
    for batch in batches:
        sides = [W.text_bytes(batch.column(c)) for c in ("text_a", "text_b")]
        both = sides[0][1] + sides[1][1]
        for first, last in W.slices(both):
            counted = []
            for data, offsets in sides:
                h, owner, n = shingles(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                counted.append((W.mix(h + owner.astype(np.uint64) * _STEP), owner, n))
            (ka, oa, na), (kb, ob, nb) = counted
            _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
            rows = last - first
            common = np.bincount(oa[ia], weights=np.minimum(na[ia], nb[ib]), minlength=rows)
            every = np.bincount(oa, weights=na, minlength=rows) + np.bincount(ob, weights=nb, minlength=rows) - common
            keep = pa.array(np.flatnonzero((common * SIMILAR[1] >= every * SIMILAR[0]) & (every > 0)) + first)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(keep) for c in ("a", "b")], names=["a", "b"])


def _sized(rows: DataFrame, n: int, each: int = MEMBERS) -> DataFrame:
    """In as many tasks as ``n`` counted rows ask for. What one task holds is grouped and joined without a shuffle."""
    return rows.coalesce(max(1, -(-n // each)))


def _verified(pairs: DataFrame, signs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that are near copies. Texts move only for pairs that signatures leave."""
    n = pairs.count()
    for side in "ba":
        part = signs.select(
            F.col("node").alias(side), F.col("total").alias(f"total_{side}"), F.col("code").alias(f"code_{side}"), F.col("k1").alias(f"{side}1"), F.col("k2").alias(f"{side}2")
        )
        pairs = pairs.join(part, side)
    likely = staged(
        over_batches(_sized(pairs, n, PAIRS), _likely, "a bigint, b bigint, a1 bigint, a2 bigint, b1 bigint, b2 bigint"), "likely-pairs"
    )
    words = texts.select("k1", "k2", "text")
    second = staged(
        likely.join(words.toDF("b1", "b2", "text_b"), ["b1", "b2"]).select("a", "b", "a1", "a2", "text_b"), "pair-texts"
    )
    leads = likely.select("a1", "a2").distinct()
    first = staged(words.toDF("a1", "a2", "text_a").join(leads, ["a1", "a2"], "left_semi"), "lead-texts")
    joined = second.join(first, ["a1", "a2"]).select("a", "b", "text_a", "text_b")
    return staged(over_batches(joined, _similar, "a bigint, b bigint"), "links")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its least node) of every node with a link, by alternating large and small stars.

    Each round hangs neighbours on the least one they know; rounds grow with the
    logarithm of a component's size. Rows are staged, so rounds do not pile up lineage.
    """

    def mark(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 31))).first()

    def few(rows: DataFrame) -> DataFrame:
        return _sized(rows, seen[0], EDGES)

    seen = (links.count(),)
    edges = few(links).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    edges = staged(few(edges), "star")
    seen = mark(edges)
    while seen[0]:
        both = few(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        least = staged(few(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))), "star-least")
        large = staged(few(both.join(few(least), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()), "star")
        large = few(large)
        least = staged(few(large.groupBy("u").agg(F.min("v").alias("m"))), "star-least")
        ends = F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        small = large.join(few(least), "u").select(ends.alias("e")).select("e.*").filter("u != v").distinct()
        edges = staged(few(small), "star")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    edges = few(edges)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return staged(few(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)), "components")


def node_classes(texts: DataFrame) -> DataFrame:
    """node, component of every node that has a near copy."""
    columns = "node bigint, k1 bigint, k2 bigint, total bigint, code binary, odd array<bigint>, bands array<bigint>"
    signs = staged(over_batches(texts.select("node", "k1", "k2", "text"), _sign, columns), "signatures")
    banded = signs.select("node", F.explode("bands").alias("band"))
    shared = staged(banded.groupBy("band").agg(F.min("node").alias("lead"), F.count("*").alias("n")).filter("n > 1").drop("n"), "bands")
    members = staged(banded.join(shared, "band"), "band-members")
    first = staged(members.filter("node != lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    links = _verified(first, signs, texts)
    tested, found = first, components(links)
    p, q = SIMILAR
    possible = F.expr(
        f"{q} * least(total_x, total) >= {p} * greatest(total_x, total) AND {p + q} * ({_apart('odd_x', 'odd')}) <= {q - p} * (total_x + total)"
    )
    attempt, last = 0, False
    while True:
        last = last or attempt == ROUNDS
        classed = members.join(found, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
        classed = staged(classed, "band-classes")
        sizes = classed.groupBy("band", "component").agg(F.count("*").alias("n"))
        largest = F.max_by("component", F.struct("n", "component")).alias("largest")
        divided = sizes.groupBy("band").agg(largest, F.count("*").alias("classes")).filter("classes > 1").drop("classes")
        divided = staged(_sized(divided, classed.count()), "divided-bands")
        if divided.isEmpty():
            break
        opened = staged(classed.join(divided, "band"), "open-bands")
        n = opened.count()
        members = opened.select("band", "node")  # a bucket of one class has nothing more to tell
        opened = opened.join(signs.select("node", "total", "odd"), "node")
        outside = opened.filter("component != largest").select("band", *(F.col(c).alias(f"{c}_x") for c in ("node", "component", "total", "odd")))
        inside, apart = opened, F.expr("component_x != component AND (component = largest OR node_x < node)")
        if not last:
            turn = Window.partitionBy("band").orderBy(F.xxhash64("node", F.lit(attempt)), "node")
            inside = opened.filter("component = largest").withColumn("turn", F.row_number().over(turn)).filter(F.col("turn") <= LEADS)
            inside = staged(_sized(inside.drop("turn"), n), "band-leads")
        met = outside.join(inside, "band").filter(apart & possible).select(F.least("node_x", "node").alias("a"), F.greatest("node_x", "node").alias("b"))
        pairs = met.distinct().join(tested, ["a", "b"], "left_anti")
        pairs = staged(pairs if last else _sized(pairs, LEADS * n), "pairs")
        more = _verified(pairs, signs, texts)
        tested = tested.unionByName(pairs)
        linked = more.count()
        if linked:
            known = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
            found = components(known.unionByName(more))
        if last:
            break
        attempt, last = attempt + 1, linked < WORTHWHILE * n
    return found


def _classes(texts: DataFrame) -> DataFrame:
    """k1, k2, node, component, class_id (least document id of the component), class_size (rows)."""
    keys = texts.select("k1", "k2", "node", "least_id", "copies")
    joined = keys.join(node_classes(texts), "node", "left").withColumn("component", F.coalesce("component", "node"))
    joined = staged(joined, "node-classes")
    per_class = joined.groupBy("component").agg(
        F.min("least_id").alias("class_id"), F.sum("copies").alias("class_size"), F.min(F.struct(F.col("least_id").isNull(), "least_id", "node")).alias("first")
    )
    return joined.join(per_class, "component").withColumn("leads", F.col("node") == F.col("first.node")).drop("first")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, class_id, class_size, kept of every row.

    ``class_id`` is the least doc_id of the class; blank texts are classes of their own,
    with their own doc_id. ``kept`` holds for exactly one row of each class: one with the
    class's least id, also where ids are null or repeated.
    """
    # Blank texts are left out of the grouping: copies of nothing are no copies.
    keyed = keyed_texts(docs, doc_id, text)
    rows = staged(keyed.select("doc_id", "k1", "k2", (~keyed["text"].rlike(W.WORD_CLASS)).alias("blank"), F.monotonically_increasing_id().alias("row")), "class-rows")
    columns = ["k1", "k2", "class_id", "class_size", "leads"]
    found = settled(docs.sparkSession, "text-classes", lambda: _classes(distinct_texts(docs, doc_id, text)).select(*columns))
    first = rows.groupBy("k1", "k2").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("first"))
    per_text = found.join(first, ["k1", "k2"])
    own = F.col("blank")
    return rows.join(per_text, ["k1", "k2"]).select(
        "doc_id",
        F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(own, F.lit(1).cast("bigint")).otherwise(F.col("class_size")).alias("class_size"),
        (own | (F.col("leads") & (F.col("row") == F.col("first")))).alias("kept"),
    )


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One whole row of each class: the one with the least id. Of blank texts, one row for each different text stays."""
    texts = distinct_texts(docs, doc_id, text, with_rows=True)
    leads = settled(docs.sparkSession, "leads", lambda: _classes(texts).filter("leads").select("k1", "k2"))
    kept = texts.join(leads, ["k1", "k2"], "left_semi")
    columns = [F.when(~F.col("absent"), F.col("text")).alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns]
    return kept.select(*columns)
