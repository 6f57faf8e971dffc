"""Mixing sources to target weights by Pareto order sampling.

A source that must give ``r`` times its words gives every document ``floor(r)`` whole
copies. The rest of the target is drawn: each document has inclusion odds
``p / (1 - p)`` with ``p = r - floor(r)`` and random odds ``u / (1 - u)``; documents
are ranked by the quotient, and the first ones are taken until the words of their
source's target are reached. Probabilities differ between sources, sizes are fixed.

Ranks are never built over a whole source: quotients fall into bins, the bins' words
are added up, and only the bin in which a source's target lies is ordered. What
remains is one row per source, the rank to stop at, so texts are never shuffled.

Null or blank texts have size 0. Sources may be null (the last one). The random
number comes from ``doc_id`` and size, so reruns agree. Rows equal in both are one rank,
of which as many are taken as the target asks for, whichever they are. An empty table gives an empty result. Other columns pass through,
whatever their names, but ``mix`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.staging import staged
from ledgerlens.llm.words import WORD_CLASS

# Weights of the sources by rank, the share of all words, the most copies.
WEIGHTS = [3, 1, 2]
SHARE_PERCENT = 150
MOST_COPIES = 2

BINS = 4096
_RANDOM_BITS = 48


def targets(sizes: DataFrame, weights: list[int] = WEIGHTS, share_percent: int = SHARE_PERCENT) -> DataFrame:
    """source, source_size, target: one row per source of ``sizes`` (source, size).

    Sources are filled in proportion to their weights; one whose share would pass
    ``MOST_COPIES`` times its size stops there. In the order of size by weight, the
    full sources come first, so one running sum finds them all. The window without a
    partition holds one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = per_source.withColumn(
        "place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")))
    order = Window.orderBy(
        (F.col("source_size") * MOST_COPIES / F.col("weight")).asc(), F.col("place").asc()
    )
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onwards = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * share_percent / 100 - F.col("full_before")) / F.col("weight_from")
    marked = (
        ranked.withColumn("full_before", F.coalesce(F.sum(F.col("source_size") * MOST_COPIES).over(before), F.lit(0)))
        .withColumn("weight_from", F.sum("weight").over(onwards))
        .withColumn("level", level)
        .withColumn("full", F.col("level") * F.col("weight") >= F.col("source_size") * MOST_COPIES)
    )
    water = F.max(F.when(~F.col("full"), F.struct(-F.col("place_in_order"), F.col("level")))).over(everything)
    numbered = marked.withColumn("place_in_order", F.row_number().over(order))
    return numbered.withColumn("water", water.getField("level")).select(
        "source",
        "source_size",
        F.when(F.col("full"), (F.col("source_size") * MOST_COPIES).cast("double"))
        .otherwise(F.col("water") * F.col("weight"))
        .alias("target"),
    )


def uniform(key: Column) -> Column:
    """A number in (0, 1) that depends on the key alone."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, _RANDOM_BITS // 4)
    return (F.conv(digits, 16, 10).cast("bigint").cast("double") + 0.5) / float(1 << _RANDOM_BITS)


def _ranked(rows: DataFrame) -> DataFrame:
    """Adds whole copies, inclusion probability and, where that is over 0, the rank."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string"))
    return (
        rows.withColumn("ratio", ratio)
        .withColumn("whole", F.floor("ratio"))
        .withColumn("p", F.col("ratio") - F.col("whole"))
        .withColumn("u", uniform(key))
        .withColumn("rank", F.when(F.col("p") > 0, F.col("u") / (1 - F.col("u")) / (F.col("p") / (1 - F.col("p")))))
        .drop("ratio", "u")
    )


def _with_source(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Adds what ``table`` holds for the row's source, null included."""
    other = table.withColumnRenamed("source", "_source")
    return rows.join(other, rows["source"].eqNullSafe(other["_source"])).drop("_source")


def stops(sizes: DataFrame) -> DataFrame:
    """source, source_size, target, last_rank, last_rows, last_all: documents below that rank get one more copy.

    Of those at it, which are equal in id and size, ``last_rows`` do (``last_all``: all of
    them). A document on the edge is taken where that brings its source nearer to the target.
    Equal documents are one row with a count before anything is ordered.
    """
    goal = staged(targets(sizes), "mix-targets")
    alike = sizes.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    drawn = _ranked(_with_source(alike, goal)).filter("p > 0")
    ranks = drawn.groupBy("source", "rank").agg(
        F.sum("rows").alias("rows"), F.sum(F.col("rows") * F.col("size")).alias("words"), F.max(F.col("target") - F.col("whole") * F.col("source_size")).alias("wanted")
    )
    ranks = staged(ranks.withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS)), "mix-ranks")
    by_bin = ranks.groupBy("source", "bin").agg(F.sum("words").alias("bin_words"), F.max("rank").alias("bin_last"), F.max("wanted").alias("wanted"))
    earlier = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    by_bin = staged(by_bin.withColumn("before", F.coalesce(F.sum("bin_words").over(earlier), F.lit(0))), "mix-bins")
    fits = F.col("before") + F.col("bin_words") <= F.col("wanted")
    edges = by_bin.filter(~fits & (F.col("before") < F.col("wanted"))).select(F.col("source").alias("_s"), F.col("bin").alias("_b"), "before")
    on_edge = ranks.join(edges, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bin") == F.col("_b")))
    inside = Window.partitionBy("source", "bin").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("wanted") - F.col("before") - F.coalesce(F.sum("words").over(inside), F.lit(0))
    each = F.col("words") / F.col("rows")
    most = F.when(F.col("words") == 0, F.col("rows")).otherwise(F.floor(room / each + 0.5))
    taken = on_edge.withColumn("taken", F.least(most, F.col("rows"))).filter("taken > 0")
    last = taken.select("source", F.col("rank").alias("last_rank"), F.col("taken").alias("last_rows"), (F.col("taken") == F.col("rows")).alias("last_all")).unionByName(
        by_bin.filter(fits).select("source", F.col("bin_last").alias("last_rank"), F.lit(0).cast("bigint").alias("last_rows"), F.lit(True).alias("last_all"))
    )
    last = last.groupBy("source").agg(F.max(F.struct("last_rank", "last_rows", "last_all")).alias("last")).select(F.col("source").alias("_s"), "last.*")
    joined = goal.join(last, goal["source"].eqNullSafe(last["_s"]), "left")
    return joined.select("source", "source_size", "target", "last_rank", "last_rows", "last_all")


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows of each source numbered from 1: inside the partition they were read in, above what earlier ones hold.

    They are written first, so that a task that runs again finds the same rows. No
    partition of the window holds more than one task has read.
    """
    read = staged(rows.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "mix-edge")
    inside = F.row_number().over(Window.partitionBy("source", "_part").orderBy("_at"))
    counts = read.groupBy("source", "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("source").alias("_s"), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    joined = read.join(counts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p")))
    return joined.withColumn("number", inside + F.col("_before")).drop("_part", "_at", "_s", "_p", "_before")


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with a struct column ``mix``: size, source_size, target, copies, taken (words, copies counted)."""
    size = F.regexp_count(F.coalesce(docs[text].cast("string"), F.lit("")), F.lit(WORD_CLASS + "+")).cast("bigint")
    keyed = docs.select(docs[doc_id].alias("doc_id"), docs[source].alias("source"), size.alias("size"))
    stop = staged(stops(staged(keyed, "mix-sizes")), "mix-stops")
    kept = [c for c in docs.columns if c != "mix"]
    rows = docs.select(
        F.struct(*(docs[c] for c in kept)).alias("_row"), docs[doc_id].alias("doc_id"), docs[source].alias("source"), size.alias("size")
    )
    drawn = _ranked(_with_source(rows, stop))
    in_part = F.coalesce((F.col("rank") == F.col("last_rank")) & ~F.col("last_all"), F.lit(False))
    more = F.coalesce((F.col("rank") <= F.col("last_rank")).cast("int"), F.lit(0))
    parts = [(drawn.filter(~in_part), more)]
    if not stop.filter("NOT last_all").isEmpty():
        parts.append((_numbered(drawn.filter(in_part)), (F.col("number") <= F.col("last_rows")).cast("int")))
    out = None
    for part, extra in parts:
        copied = part.withColumn("copies", (F.col("whole") + extra).cast("bigint"))
        mix = F.struct("size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
        copied = copied.select("_row", mix.alias("mix"))
        out = copied if out is None else out.unionByName(copied)
    return out.select("_row.*", "mix")


def repeated(mix: DataFrame) -> DataFrame:
    """The mix itself: every row as often as it is taken, without the struct."""
    kept = [c for c in mix.columns if c != "mix"]
    times = F.explode(F.sequence(F.lit(1), F.col("mix.copies")))
    return mix.filter("mix.copies > 0").select(*kept, times.alias("_copy")).select(*kept)
