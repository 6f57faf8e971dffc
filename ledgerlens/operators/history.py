"""Reports over a change log: as-of state, validity intervals, commit history, retention, compaction."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.functions.params import moment_like
from ledgerlens.operators.upsert import has_keys, publish, stage


def state_as_of(
    changelog: DataFrame,
    keys: Sequence[str],
    moment: datetime,
    committed: str = "changed_at",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The table as it stood at ``moment``: per key the newest version committed by then."""
    seen = changelog.filter(F.col(committed) <= moment_like(changelog, committed, moment))
    return stage(seen, keys, committed, tie_break=tie_break)


def intervals(
    changelog: DataFrame, keys: Sequence[str], committed: str = "changed_at", tie_break: Sequence[str] = (), bucket: str = "month"
) -> DataFrame:
    """Each version with ``valid_from`` and ``valid_to``: from its commit up to the next one of its key.

    ``valid_to`` is NULL for a key's newest version. Of versions committed at one moment
    the last by ``tie_break`` is valid, the others end where they begin. Versions without
    a commit time or a full key are never valid.

    A key's history is linked ``bucket`` by bucket, and buckets by their first moments, so
    that a key with very many versions is spread over tasks.
    """
    dated = changelog.filter(has_keys(keys) & F.col(committed).isNotNull()).withColumn("_bucket", F.date_trunc(bucket, F.col(committed)))
    oldest_first = [F.col(c).asc_nulls_first() for c in (committed, *tie_break)]
    within = F.lead(committed).over(Window.partitionBy(*keys, "_bucket").orderBy(*oldest_first))
    firsts = dated.groupBy(*keys, "_bucket").agg(F.min(committed).alias("_first"))
    after = firsts.withColumn("_after", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_bucket"))).drop("_first")
    linked = dated.withColumn("_next", within).join(after, [*keys, "_bucket"])
    valid = linked.select(*changelog.columns, F.col(committed).alias("valid_from"), F.coalesce("_next", "_after").alias("valid_to"))
    kind = changelog.schema[committed].dataType
    never = F.lit(None).cast(kind)
    rest = changelog.filter(~has_keys(keys) | F.col(committed).isNull())
    return valid.unionByName(rest.withColumns({"valid_from": never, "valid_to": never}))


def state_in_intervals(history: DataFrame, moment: datetime) -> DataFrame:
    """What :func:`state_as_of` gives, from validity intervals: a filter, with nothing to rank or to shuffle."""
    then = moment_like(history, "valid_from", moment)
    valid = (F.col("valid_from") <= then) & (F.col("valid_to").isNull() | (F.col("valid_to") > then))
    return history.filter(valid).drop("valid_from", "valid_to")


def extend_intervals(
    history: DataFrame, changes: DataFrame, keys: Sequence[str], committed: str = "changed_at", tie_break: Sequence[str] = (), bucket: str = "month"
) -> DataFrame:
    """``history`` with further versions, late ones included.

    Only versions that are valid at or after the earliest change of their key are linked
    anew; all others keep their intervals and are not shuffled where the changed keys fit
    a broadcast.
    """
    earliest = changes.filter(has_keys(keys)).groupBy(*keys).agg(F.min(committed).alias("_earliest"))
    marked = history.join(earliest, list(keys), "left")
    reaches = F.col("valid_from").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("_earliest")))
    again = F.coalesce(F.col("_earliest").isNotNull() & reaches, F.lit(False))
    relinked = marked.filter(again).select(*changes.columns).unionByName(changes)
    return marked.filter(~again).select(*history.columns).unionByName(intervals(relinked, keys, committed, tie_break, bucket))


def commit_history(changelog: DataFrame, keys: Sequence[str], committed: str = "changed_at") -> DataFrame:
    """Rows and keys touched per commit, with the running row count of the log.

    Counted per commit and key first: a commit that touches one key very often is
    reduced before the shuffle.
    """
    per_key = changelog.groupBy(committed, *keys).agg(F.count("*").alias("versions"))
    return per_key.groupBy(committed).agg(
        F.sum("versions").alias("rows_committed"),
        F.count("*").alias("keys_touched"),
        F.sum(F.col("versions") - 1).alias("rows_superseded"),
    )


def prune_changelog(
    changelog: DataFrame,
    keys: Sequence[str],
    older_than: datetime,
    keep_last: int,
    committed: str = "changed_at",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """What retention keeps: everything since ``older_than``, and the newest ``keep_last`` versions per key.

    Ranking a key's whole history would put it into one task. An old version is
    kept only if fewer than ``keep_last`` newer ones exist, so it suffices to
    rank the old rows up to ``keep_last`` (cut before the shuffle) and to add the
    number of recent rows, which is a plain count.
    """
    if keep_last < 1:
        raise ValueError("keep_last must be at least 1")
    bound = moment_like(changelog, committed, older_than)
    recent = changelog.filter(F.col(committed) >= bound)
    newest_first = [F.col(c).desc_nulls_last() for c in (committed, *tie_break)]
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    old = (
        changelog.filter((F.col(committed) < bound) | F.col(committed).isNull())
        .withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") <= keep_last)
    )
    recent_counts = recent.groupBy(*(F.col(k).alias(f"_key_{k}") for k in keys)).agg(F.count("*").alias("_recent"))
    same_key = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys))
    kept_old = old.join(recent_counts, same_key, "left").filter(
        F.col("_rank") + F.coalesce("_recent", F.lit(0)) <= keep_last
    )
    return recent.unionByName(kept_old.select(*changelog.columns))


def compact(spark: SparkSession, table: str, partition_by: Sequence[str], where: Column | None = None) -> None:
    """Rewrite the selected partitions into files of the advisory size.

    ``where`` uses partition columns only, so that whole partitions are read and
    replaced. Sizes come from ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
    """
    rows = spark.table(table)
    if where is not None:
        rows = rows.filter(where)
    publish(spark, table, rows, partition_by)
