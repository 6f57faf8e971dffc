"""Delimited-file sources."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.params import moment_like
from ledgerlens.operators.upsert import classify_changes, publish, stage, upsert
from ledgerlens.schemas import ACCOUNT_FILE, CUSTOMER_MASTER, ddl


CORRUPT = "_corrupt_line"


def account_lines(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """Every line of the account files, with its file and, where it does not parse, the line itself in ``CORRUPT``.

    A file whose header names other columns, or the same in another order, is an error.
    All columns are parsed, whichever are asked for: a line must not be well formed in
    one query and malformed in another.
    """
    return (
        spark.read.schema(ddl({**ACCOUNT_FILE, CORRUPT: "string"}))
        .options(header="true", enforceSchema="false", mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, columnPruning="false")
        .option("pathGlobFilter", pattern)
        .csv(path)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )


def read_accounts(spark: SparkSession, path: str, pattern: str = "*.csv", batch_ts: datetime | None = None) -> DataFrame:
    """Account reference files: a full snapshot with its lineage.

    A line that does not parse or names no account is left to :func:`rejected_lines`; it
    must not blank out an account. Without a change time in the files, the run's own
    stands in: the last run wins.
    """
    rows = (
        account_lines(spark, path, pattern)
        .filter(F.col(CORRUPT).isNull() & F.col("account_id").isNotNull())
        .drop(CORRUPT)
        .withColumn("source_system", F.lit(f"file://{path}"))
    )
    if batch_ts is None:
        return rows
    stamped = rows.withColumn("src_updated_at", F.lit(None).cast("timestamp"))
    return stamped.withColumn("src_updated_at", moment_like(stamped, "src_updated_at", batch_ts))


def rejected_lines(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """source_file, reason, line: what :func:`read_accounts` leaves out. A parsed line without an account is given as JSON."""
    lines = account_lines(spark, path, pattern).filter(F.col(CORRUPT).isNotNull() | F.col("account_id").isNull())
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed").otherwise("no account")
    return lines.select("source_file", reason.alias("reason"), F.coalesce(CORRUPT, F.to_json(F.struct(*ACCOUNT_FILE))).alias("line"))


def read_master_csv(spark: SparkSession, path: str) -> DataFrame:
    """The 25-column customer file; empty fields are NULL.

    Columns are found by the header, whatever their order. A header without all
    of them is an error, as are files whose headers differ and a file without rows.
    """
    header = spark.read.option("header", "true").csv(path).columns
    missing = [c for c in CUSTOMER_MASTER if c not in header]
    if missing:
        raise ValueError(f"{path} lacks column(s) {missing}")
    text = spark.read.schema(ddl({c: "string" for c in header})).options(header="true", enforceSchema="false", nullValue="").csv(path)
    flags = {c for c, kind in CUSTOMER_MASTER.items() if kind == "boolean"}
    typed = text.select(
        *(
            (F.col(c).isin("1", "true", "TRUE", "True") if c in flags else F.col(c).cast(kind)).alias(c)
            for c, kind in CUSTOMER_MASTER.items()
        )
    )
    if typed.isEmpty():
        raise ValueError(f"{path} has no data rows")
    return typed


def load_master(spark: SparkSession, csv_path: str, table: str) -> dict[str, int]:
    """Upsert a customer file into ``table``, refreshing all but identity and creation time."""
    current = spark.table(table)
    staged = stage(read_master_csv(spark, csv_path), ["customer_id"], "updated_at", current.columns).persist()
    try:
        changes = classify_changes(current, staged, ["customer_id"]).first()
        refreshed = [c for c in current.columns if c not in ("customer_id", "created_at")]
        publish(spark, table, upsert(current, staged, ["customer_id"], update_columns=refreshed))
    finally:
        staged.unpersist()
    return {"inserted": changes["rows_inserted"], "updated": changes["rows_updated"]}
