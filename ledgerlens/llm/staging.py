"""Tables of a run in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import remove_folder, scratch_path


# Applications whose workers have this package.
_shipped: set[str] = set()

# Folder and catalog entry (or none) of what was staged for the innermost ``settled``.
_within: ContextVar[list[tuple[str, str | None]] | None] = ContextVar("_within", default=None)


def _remember(path: str, table: str | None = None) -> None:
    made = _within.get()
    if made is not None:
        made.append((path, table))


def _ship(spark: SparkSession) -> None:
    """Send this package to the workers, wherever the driver has found it; Spark serves the file from the driver."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="ledgerlens-")) / "ledgerlens-package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def over_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with a function of this package."""
    _ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows as written to the shared folder: lineage ends here, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    _remember(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The rows of ``build()`` as staged. What was staged to get them is deleted once they are written.

    Nothing else may read what ``build`` stages. After a failure the folders stay.
    """
    made: list[tuple[str, str | None]] = []
    outer = _within.set(made)
    try:
        rows = build()
        path = scratch_path(spark, label)
        rows.write.parquet(path)
    finally:
        _within.reset(outer)
    for folder, table in made:
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove_folder(spark, folder)
    _remember(path)
    return spark.read.schema(rows.schema).parquet(path)


def staged_buckets(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """As ``staged``, laid out by the keys: joins and groups on them move no row of this table.

    The rows must come from a group by the keys, so that a task holds few buckets.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, label)
    df.write.option("path", path).format("parquet").bucketBy(n, *keys).saveAsTable(name)
    _remember(path, name)
    return spark.table(name)


def keyed_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text (null: empty) and the two halves of a 128-bit key of the text."""
    picked = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    digest = F.sha2("text", 256)
    return picked.select(
        "doc_id",
        "text",
        *(F.conv(F.substring(digest, at, 16), 16, -10).cast("bigint").alias(k) for at, k in ((1, "k1"), (17, "k2"))),
    )


def distinct_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_rows: bool = False) -> DataFrame:
    """Each different text once, laid out by its key: node, k1, k2, text, copies, least_id.

    ``node`` numbers the texts. ``with_rows`` adds ``row``, the other columns of the
    document with the least id (null last). Copies are combined before the shuffle, so
    that thousands of them cost one row per task.
    """
    keyed = keyed_texts(docs, doc_id, text)
    picks = [F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least_id")]
    if with_rows:
        digest = F.sha2("text", 256)
        rest = F.struct(*(docs[c] for c in docs.columns if c != text))
        keyed = docs.select(
            docs[doc_id].alias("doc_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"), docs[text].isNull().alias("absent"), rest.alias("row")
        ).withColumns({k: F.conv(F.substring(digest, at, 16), 16, -10).cast("bigint") for at, k in ((1, "k1"), (17, "k2"))})
        picks.append(F.min_by(F.struct("row", "absent"), F.struct(F.col("doc_id").isNull(), F.col("doc_id"))).alias("first"))
    once = keyed.groupBy("k1", "k2").agg(*picks).withColumn("node", F.monotonically_increasing_id())
    if with_rows:
        once = once.withColumn("row", F.col("first.row")).withColumn("absent", F.col("first.absent")).drop("first")
    return staged_buckets(once, ["k1", "k2"], "texts")
