"""Event tables written by streams.

A micro-batch's rows lie in folders of their own, below the table's partitions and
named after the stream and the batch. After a failure Spark hands out the same
micro-batch again; it then replaces its folders and does not count twice. A stream
started afresh has a new identity, so it never replaces what an earlier one wrote.
The file sink would give the same guarantees, but readers then follow its log, and
no job could ever compact the files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.schemas import EVENT_LAYOUTS, EVENT_PARTITIONS, ddl
from ledgerlens.session import list_folders, path_exists, remove_folder

BATCH = "stream_batch"
COMPACTED = "compacted"
#: Folder of the notes on unfinished compactions; the underscore hides it from readers.
NOTES = "_compaction"


def stream_of(batch: DataFrame) -> str:
    """The identity of the stream that hands out ``batch``; it lives as long as the checkpoint."""
    identity = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not identity:
        raise ValueError("not inside a streaming query")
    return identity


def replace_batch(rows: DataFrame, root: str, table: str, stream: str, batch_id: int) -> None:
    """Write one micro-batch, or write it again.

    Rebalancing keeps the number of files per partition low without putting a
    large partition into one task.
    """
    partitions = EVENT_PARTITIONS[table]
    (
        rows.withColumn(BATCH, F.lit(f"{stream}-{batch_id}"))
        .hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions, BATCH)
        .parquet(f"{root}/{table}")
    )


def read_event_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A streamed table with its declared columns, each event once even while or after a compaction stops halfway."""
    layout, home = EVENT_LAYOUTS[table], f"{root}/{table}"
    rows = spark.read.schema(ddl({**layout, BATCH: "string"})).parquet(home)
    notes = list(_notes(spark, home).values())
    if notes:
        rows = rows.join(_ignored(spark, notes), ["event_date", BATCH], "left_anti")
    return rows.select(*layout)


def _notes(spark: SparkSession, home: str) -> dict[str, str]:
    """The note that holds of each unfinished compaction. Notes say which batches readers ignore.

    ``pending`` names the compacted batch, ``ready`` the batches it stands for; once
    there is a complete ``ready``, it holds.
    """
    found: dict[str, str] = {}
    for folder in sorted(list_folders(spark, f"{home}/{NOTES}")):  # ready follows pending
        if path_exists(spark, f"{folder}/_SUCCESS"):
            found[folder.rpartition("/")[2].partition(".")[0]] = folder
    return found


def _ignored(spark: SparkSession, notes: list[str]) -> DataFrame:
    return spark.read.schema(f"event_date date, {BATCH} string").parquet(*notes)


def _note(spark: SparkSession, home: str, name: str, state: str, day: date, batches: Iterable[str]) -> None:
    rows = spark.createDataFrame([(day, batch) for batch in sorted(batches)], f"event_date date, {BATCH} string")
    rows.coalesce(1).write.parquet(f"{home}/{NOTES}/{name}.{state}")


def _batch_folders(spark: SparkSession, table: str, home: str, day: date) -> list[tuple[str, str]]:
    """Name and path of every batch folder of one day; no other day is listed."""
    folders = [f"{home}/event_date={day.isoformat()}"]
    for _ in EVENT_PARTITIONS[table]:
        folders = [f for parent in folders for f in list_folders(spark, parent)]
    return [(name, f) for f in folders for _, mark, name in [f.rpartition(f"{BATCH}=")] if mark]


def _settled(batches: Iterable[str]) -> set[str]:
    """Batches that no stream will write again: only its newest one can be handed out once more."""
    batches, newest = set(batches), {}
    for batch in batches:
        stream, _, number = batch.rpartition("-")
        if not batch.startswith(COMPACTED):
            newest[stream] = max(newest.get(stream, 0), int(number))
    return batches - {f"{stream}-{number}" for stream, number in newest.items()}


def _finish(spark: SparkSession, home: str, table: str) -> None:
    """Delete what the notes say is to be ignored, then the notes; may be repeated after a failure."""
    for name, note in _notes(spark, home).items():
        gone = {(r["event_date"], r[BATCH]) for r in _ignored(spark, [note]).collect()}  # one day's batch names
        for day in {day for day, _ in gone}:
            for batch, folder in _batch_folders(spark, table, home, day):
                if (day, batch) in gone:
                    remove_folder(spark, folder)
        for state in ("pending", "ready"):
            remove_folder(spark, f"{home}/{NOTES}/{name}.{state}")


def compact_days(spark: SparkSession, root: str, table: str, days: Iterable[date]) -> None:
    """Merge the small files of some days into files of the advisory size; one run at a time for a table.

    The files of a partition are ranges of accounts, sorted, so that a look-up of one
    account skips nearly all of them by their statistics. Ranges go on to the event,
    so that a very busy account is several files.

    The batches of a day are listed once. Their rows go to a new batch beside them,
    and only those folders are deleted, so a batch that arrives meanwhile stays.
    Each stream's newest batch of the day is left alone, as it may be written
    again. Notes tell readers which side to ignore until all is done, and the
    next run finishes or takes back what a failed one has left.
    """
    home, inner = f"{root}/{table}", [*EVENT_PARTITIONS[table][1:], BATCH]
    _finish(spark, home, table)
    for day in days:
        settled = _settled(name for name, _ in _batch_folders(spark, table, home, day))
        if len(settled) < 2:
            continue
        merged, of_day = f"{COMPACTED}-{uuid.uuid4().hex}", f"{home}/event_date={day.isoformat()}"
        layout = ddl({**EVENT_LAYOUTS[table], BATCH: "string"})
        rows = spark.read.schema(layout).option("basePath", home).parquet(of_day).filter(F.col(BATCH).isin(*settled))
        _note(spark, home, merged, "pending", day, [merged])
        merged_rows = rows.drop("event_date").withColumn(BATCH, F.lit(merged))
        by = [*inner, *(c for c in ("account_id", "event_id") if c in EVENT_LAYOUTS[table])]
        arranged = merged_rows.repartitionByRange(*by).sortWithinPartitions(*by)
        arranged.write.mode("append").partitionBy(*inner).parquet(of_day)
        _note(spark, home, merged, "ready", day, settled)
        _finish(spark, home, table)
