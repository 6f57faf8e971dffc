"""Relational sources over JDBC."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.params import in_utc
from ledgerlens.schemas import CUSTOMER_MASTER


def timestamp_text(moment: datetime) -> str:
    """A watermark for an SQL predicate: UTC, milliseconds. Naive values are UTC."""
    return in_utc(moment).isoformat(sep=" ", timespec="milliseconds")


def jdbc_options(options: Mapping[str, str], sql: str, num_partitions: int = 1, shard_sql: str | None = None) -> dict[str, str]:
    """Reader options for one statement, read serially or in hash shards.

    ``shard_sql`` is a non-negative whole-number expression over ``t`` in the
    source's dialect. Spark rejects ``query`` together with ``partitionColumn``,
    hence the sub-select.
    """
    merged = {"fetchsize": "5000", **options}
    if num_partitions <= 1:
        return {**merged, "query": sql}
    if not shard_sql:
        raise ValueError("a sharded read needs shard_sql")
    return {
        **merged,
        "dbtable": f"(SELECT t.*, MOD({shard_sql}, {num_partitions}) AS _shard FROM ({sql}) t) shards",
        "partitionColumn": "_shard",
        "lowerBound": "0",
        "upperBound": str(num_partitions),
        "numPartitions": str(num_partitions),
    }


def read_jdbc(
    spark: SparkSession, options: Mapping[str, str], sql: str, num_partitions: int = 1, shard_sql: str | None = None
) -> DataFrame:
    """Run a projection with its predicate in the source."""
    rows = spark.read.format("jdbc").options(**jdbc_options(options, sql, num_partitions, shard_sql)).load()
    return rows.drop("_shard")


def customer_sql(
    table: str,
    watermark: datetime | None = None,
    timestamp_sql: str = "{column}",
    literal_sql: str = "TIMESTAMP '{text}'",
) -> str:
    """The pushed-down statement for the customer master.

    ``timestamp_sql`` converts a source time to a plain UTC timestamp where the
    driver would otherwise return a zoned type Spark has no mapping for.
    """
    plain = [c for c in CUSTOMER_MASTER if c not in ("created_at", "updated_at")]
    created, updated = (timestamp_sql.format(column=c) for c in ("created_at", "updated_at"))
    sql = f"SELECT {', '.join(plain)}, {created} AS src_created_at, {updated} AS src_updated_at FROM {table}"
    if watermark is not None:
        sql += f" WHERE {updated} > {literal_sql.format(text=timestamp_text(watermark))}"
    return sql


def typed_customers(raw: DataFrame, source_system: str) -> DataFrame:
    """Flags and money in their declared types, whatever the driver returned."""
    casts = {
        "pep_flag": "boolean",
        "marketing_consent": "boolean",
        "annual_income": CUSTOMER_MASTER["annual_income"],
    }
    present = {c: F.col(c).cast(kind) for c, kind in casts.items() if c in raw.columns}
    return raw.withColumns({**present, "source_system": F.lit(source_system)})


def read_customers(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    watermark: datetime | None = None,
    *,
    num_partitions: int = 1,
    shard_sql: str | None = None,
    timestamp_sql: str = "{column}",
    literal_sql: str = "TIMESTAMP '{text}'",
    source_system: str | None = None,
) -> DataFrame:
    sql = customer_sql(table, watermark, timestamp_sql, literal_sql)
    raw = read_jdbc(spark, options, sql, num_partitions, shard_sql)
    return typed_customers(raw, source_system or table)
