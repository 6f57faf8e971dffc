"""Idempotent keyed upserts.

A batch is reduced to one row per key, merged into the current version of the
table by one join on the key, and published as a new version. Replaying a batch
changes nothing.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.functions.params import in_utc, moment_like
from ledgerlens.session import list_folders, remove_folder, scratch_path


def read_watermark(target: DataFrame, column: str | None) -> DataFrame:
    """One row with the highest ``column`` seen so far, NULL for an empty target."""
    return target.agg(F.max(column).alias("high_water_mark"))


def watermark_value(target: DataFrame, column: str | None) -> datetime | None:
    """:func:`read_watermark` as a UTC value, whatever the zone of the driver machine."""
    seen = read_watermark(target, column).select(F.unix_micros(F.col("high_water_mark").cast("timestamp"))).first()[0]
    return None if seen is None else datetime(1970, 1, 1) + timedelta(microseconds=seen)


def incremental(df: DataFrame, column: str, watermark: datetime | None) -> DataFrame:
    """Rows changed after the watermark; all rows where there is none."""
    return df if watermark is None else df.filter(F.col(column) > moment_like(df, column, watermark))


def lookback(df: DataFrame, watermark: datetime | None, days: int) -> DataFrame:
    """Rows of the trailing days an incremental roll-up has to recompute.

    Events may arrive late, into days that were rolled up before.
    """
    if watermark is None:
        return df
    return df.filter(F.col("event_date") >= F.lit((in_utc(watermark) - timedelta(days=days)).date()))


def has_keys(keys: Iterable[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return condition


def quarantine(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a full merge key: they could never be matched again."""
    return df.filter(~has_keys(keys))


def stage(
    df: DataFrame,
    keys: Sequence[str],
    ordering: str | None,
    columns: Sequence[str] | None = None,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key, the newest; rows without an ordering value come last.

    Ties fall to the highest remaining columns, so that the choice does not
    depend on arrival order. ``rank = 1`` is cut before the shuffle as well as
    after it, so a key with very many versions sends one row per task.
    """
    rest = tie_break if tie_break is not None else [c for c in df.columns if c not in {*keys, ordering}]
    newest_first = [F.col(c).desc_nulls_last() for c in ([ordering] if ordering else []) + list(rest)]
    window = Window.partitionBy(*keys).orderBy(*(newest_first or [F.lit(1)]))
    newest = df.filter(has_keys(keys)).withColumn("_rank", F.row_number().over(window)).filter("_rank = 1")
    return newest.select(*(columns or df.columns))


def stamp(df: DataFrame, batch_id: str, batch_ts: datetime, source_system: str | None = None) -> DataFrame:
    """Batch lineage as constants, so that a replay yields the same rows."""
    stamped = df.withColumns({"batch_id": F.lit(batch_id), "ingested_at": F.lit(None).cast("timestamp")})
    stamped = stamped.withColumn("ingested_at", moment_like(stamped, "ingested_at", batch_ts))
    return stamped if source_system is None else stamped.withColumn("source_system", F.lit(source_system))


def _side_by_side(target: DataFrame, staged: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    old = target.select(*keys, F.struct(*target.columns).alias("_old"))
    new = staged.select(*keys, F.struct(*staged.columns).alias("_new"))
    return new.join(old, list(keys), how)


def _supersedes(ordering: str | None) -> Column:
    """Whether a matched row replaces the target's. A NULL on either side keeps the target."""
    if ordering is None:
        return F.lit(True)
    return F.coalesce(F.col(f"_new.{ordering}") >= F.col(f"_old.{ordering}"), F.lit(False))


def upsert(
    target: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    ordering: str | None = None,
    update_columns: Sequence[str] | None = None,
    counts: Observation | None = None,
) -> DataFrame:
    """The target after the merge: newer rows replace, older ones are ignored, new ones are added.

    ``staged`` holds one row per key (:func:`stage`). ``update_columns`` limits
    what a match refreshes. Nothing is ever deleted. ``counts`` receives what
    :func:`classify_changes` would count, once the rows have been written.
    """
    joined = _side_by_side(target, staged, keys, "full_outer")
    if counts is not None:
        joined = joined.observe(counts, *_change_counts(ordering))
    added = F.col("_old").isNull()
    replaced = F.col("_new").isNotNull() & F.col("_old").isNotNull() & _supersedes(ordering)
    refreshed = set(update_columns if update_columns is not None else target.columns)
    return joined.select(
        *(
            F.when(added | replaced if c in refreshed else added, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c)
            for c in target.columns
        )
    )


def merge_into(table: str, staged: DataFrame, keys: Sequence[str], ordering: str | None = None) -> None:
    """The same merge done by the table itself, for providers with row-level operations."""
    on = reduce(Column.__and__, (F.col(f"{table}.{k}") == F.col(f"staged.{k}") for k in keys))
    merge = staged.alias("staged").mergeInto(table, on)
    newer = None if ordering is None else F.col(f"staged.{ordering}") >= F.col(f"{table}.{ordering}")
    matched = merge.whenMatched() if newer is None else merge.whenMatched(newer)
    matched.updateAll().whenNotMatched().insertAll().merge()


def classify_changes(target: DataFrame, staged: DataFrame, keys: Sequence[str], ordering: str | None = None) -> DataFrame:
    """One row: how many staged rows insert, update, or are stale.

    Counted from keys and ordering values alone, so neither side's payload is read.
    """
    narrow = list(dict.fromkeys([*keys, *([ordering] if ordering else [])]))
    joined = _side_by_side(target.select(*narrow), staged.select(*narrow), keys, "left")
    return joined.agg(*_change_counts(ordering))


def _change_counts(ordering: str | None) -> list[Column]:
    """How many staged rows of :func:`_side_by_side` insert, update, or are stale."""
    new, old = F.col("_new").isNotNull(), F.col("_old").isNotNull()
    return [
        F.count_if(new & ~old).alias("rows_inserted"),
        F.count_if(new & old & _supersedes(ordering)).alias("rows_updated"),
        F.count_if(new & old & ~_supersedes(ordering)).alias("rows_stale"),
    ]


_VERSION = "/version-"


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.filter("col_name = 'Location'").first()["data_type"]


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrite only partitions that receive rows. ``insertInto`` takes this from the session alone."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def publish(spark: SparkSession, table: str, rows: DataFrame, partition_by: Sequence[str] = ()) -> int | None:
    """Make ``rows`` the content of ``table``, or of the partitions they fall into.

    An unpartitioned table gets a new version in a folder of its own, and the
    catalog entry is then moved to it: readers see the old or the new version,
    and a failed run leaves the old one. For a partitioned table the rows are
    written to the shared folder first, since they derive from partitions that
    cannot be overwritten while they are read, and then replace just those; the
    staged copy goes once that is done. Rebalancing spreads a large partition over
    several tasks and files.

    Returns the number of the new version (microseconds since 1970), None for a partitioned table.
    """
    number = None
    arranged = rows.select(*spark.table(table).columns)
    if not partition_by:
        home = _location(spark, table).partition(_VERSION)[0]
        number = time.time_ns() // 1000
        version = f"{home}{_VERSION}{number:020d}-{uuid.uuid4().hex}"
        arranged.write.parquet(version)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
    else:
        staging = scratch_path(spark, f"publish-{table.rpartition('.')[2]}")
        arranged.write.parquet(staging)
        staged = spark.read.schema(arranged.schema).parquet(staging).hint("rebalance", *partition_by)
        with _dynamic_overwrite(spark):
            staged.write.insertInto(table, overwrite=True)
        remove_folder(spark, staging)
    spark.catalog.refreshTable(table)
    return number


def expire_versions(spark: SparkSession, table: str, keep_last: int = 2) -> int:
    """Delete the oldest versions :func:`publish` left of an unpartitioned table; returns their number.

    The current version always stays, and with it the newest ``keep_last`` in all,
    for queries that still read an earlier one. Age is told by the versions' names,
    as object stores have no times of folders. Versions after the current one stay as
    well: a run may still be writing them.
    """
    if keep_last < 1:
        raise ValueError("keep_last must be at least 1")
    current = _location(spark, table)
    home, mark, name = current.partition(_VERSION)
    if not mark:
        return 0

    def age(version: str) -> str:  # names without a time come from earlier releases
        return version if re.fullmatch(r"\d{20}-\w+", version) else ""

    folders = {f.partition(_VERSION)[2].rstrip("/"): f for f in list_folders(spark, home) if _VERSION in f}
    earlier = sorted((v for v in folders if v != name and age(v) <= age(name)), key=lambda v: (age(v), v), reverse=True)
    stale = earlier[keep_last - 1 :]
    for version in stale:
        remove_folder(spark, folders[version])
    return len(stale)
