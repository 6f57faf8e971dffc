"""Shards of near equal bytes: ranges of a key between sampled splitters.

1. Keys are drawn with a chance in proportion to their record's size, and quantiles of
   the draw become the bounds of ``RANGES`` ranges. The key is a hash of the text, so
   equal texts are neighbours and share a range.
2. The bytes of every range are added up over all records. A range that is too large,
   such as one with a text that a third of all rows hold, is cut into pieces by a hash
   of a number that each row gets when the records are written, as many as its size asks for.
3. Pieces in key order fill the shards one after the other. A shard's size is off by at
   most about one piece.

Only the bounds and sums of ranges, whose number is fixed, reach the driver. Slots are
numbered within pieces, and each piece knows how many rows its shard has before it.

Null texts have size 1, the crc32 of nothing and one common key; ids may be null or
repeated, on any share of the rows; equal rows get slots of their own. An empty table gives an empty result. Columns of
the input are not looked at, but for the two named.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.staging import staged

SHARDS = 16
#: Ranges between splitters, and the mean number of sampled keys for each.
RANGES = 1024
KEYS_PER_RANGE = 64
#: A range of more bytes than this share of a shard is cut.
PIECES_PER_SHARD = 64
_FAN = 32


def _chance(key: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 40)).cast("double") / float(1 << 40)


def splitters(records: DataFrame, total: int, ranges: int, per_range: int) -> list[int]:
    """At most ``ranges - 1`` bounds at equal shares of the bytes, from a size-weighted draw of the keys."""
    wanted = ranges * per_range
    # A record of more than its share of the draw is taken once for each whole share.
    share = F.col("size") * float(wanted) / float(max(total, 1))
    whole = F.floor(share)
    times = whole + (_chance(F.struct("key", "row"), 1) < share - whole).cast("bigint")
    drawn = records.select("key", times.alias("times")).filter("times > 0")
    quantiles = F.percentile("key", F.array(*(F.lit(i / ranges) for i in range(1, ranges))), F.col("times"))
    found = drawn.agg(quantiles.alias("q")).first()["q"]
    return sorted({int(x) for x in found or []})


def range_of(key: Column, bounds: list[int]) -> Column:
    """How many bounds are at or below the key, in two short look-ups of constant arrays."""
    if not bounds:
        return F.lit(0)
    groups = [bounds[i : i + _FAN] for i in range(0, len(bounds), _FAN)]
    heads = F.expr("array(" + ", ".join(f"{g[0]}L" for g in groups) + ")")
    inner = F.expr("array(" + ", ".join("array(" + ", ".join(f"{x}L" for x in g) + ")" for g in groups) + ")")
    group = F.size(F.filter(heads, lambda x: x <= key))
    within = F.size(F.filter(F.get(inner, group - 1), lambda x: x <= key))
    return F.when(group == 0, 0).otherwise((group - 1) * _FAN + within)


def _constant(values: list[int]) -> Column:
    return F.expr("array(" + ", ".join(f"{v}L" for v in values) + ")")


def sharded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, range, piece, shard, slot of every row."""
    whole = F.coalesce(docs[text].cast("string"), F.lit(""))
    records = staged(
        docs.select(
            docs[doc_id].alias("doc_id"),
            (F.octet_length(whole) + 1).cast("bigint").alias("size"),
            F.crc32(whole.cast("binary")).alias("text_crc32"),
            F.xxhash64(whole).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-records",
    )
    total = records.agg(F.sum("size")).first()[0] or 0
    bounds = splitters(records, total, RANGES, KEYS_PER_RANGE)
    ranged = records.withColumn("range", range_of(F.col("key"), bounds))
    sizes = {r["range"]: r["bytes"] for r in ranged.groupBy("range").agg(F.sum("size").alias("bytes")).collect()}
    most = max(1, total // (shards * PIECES_PER_SHARD))
    cuts = [max(1, -(-sizes.get(r, 0) // most)) if sizes.get(r, 0) > 2 * most else 1 for r in range(len(bounds) + 1)]
    in_range = F.least(F.floor(_chance(F.col("row"), 2) * F.get(_constant(cuts), F.col("range"))), F.get(_constant(cuts), F.col("range")) - 1)
    pieced = ranged.withColumn("piece", in_range.cast("int"))
    counted = pieced.groupBy("range", "piece").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    # At most RANGES pieces and as many cuts as PIECES_PER_SHARD allows for all shards.
    pieces = sorted(counted.collect(), key=lambda r: (r["range"], r["piece"]))
    first, at, number = [], 0, 0
    for cut in cuts:
        first.append(number)
        number += cut
    shard_of, slot_of, used = [0] * max(number, 1), [0] * max(number, 1), [0] * shards
    for p in pieces:
        shard = min(shards - 1, (2 * at + p["bytes"]) * shards // (2 * max(total, 1)))
        k = first[p["range"]] + p["piece"]
        shard_of[k], slot_of[k] = shard, used[shard]
        at += p["bytes"]
        used[shard] += p["rows"]
    number_of = (F.get(_constant(first), F.col("range")) + F.col("piece")).cast("int")
    within = F.row_number().over(Window.partitionBy("range", "piece").orderBy("key", "doc_id", "size", "text_crc32", "row")) - 1
    return pieced.withColumn("within", within).select(
        "doc_id",
        "size",
        "text_crc32",
        "range",
        "piece",
        F.get(_constant(shard_of), number_of).cast("int").alias("shard"),
        (F.get(_constant(slot_of), number_of) + F.col("within")).cast("bigint").alias("slot"),
    )
