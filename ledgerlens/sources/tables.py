"""Table reads, creation, appends and the schema contract."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.schemas import EVENT_TABLES, Layout, Target, ddl


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a Parquet folder where ``name`` is a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def ensure_table(
    spark: SparkSession, name: str, layout: Layout, partition_by: Iterable[str] = (), provider: str = "parquet"
) -> str:
    """Create schema and table from a declared layout where they are missing."""
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rpartition('.')[0]}")
    columns = tuple(partition_by)
    partitioning = f"PARTITIONED BY ({', '.join(columns)})" if columns else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl(layout)}) USING {provider} {partitioning} "
        "OPTIONS ('compression' = 'zstd')"
    )
    return name


def widen_table(spark: SparkSession, name: str, layout: Layout) -> str:
    """Add declared columns that an older table lacks; its rows read as NULL there."""
    live = set(spark.table(name).columns)
    missing = {c: kind for c, kind in layout.items() if c not in live}
    if missing:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({ddl(missing)})")
    return name


def ensure_target(spark: SparkSession, schema: str, target: Target, provider: str = "parquet") -> str:
    return ensure_table(spark, f"{schema}.{target.table}", target.layout, target.partition_by, provider)


def append(df: DataFrame, table: str, files: int | None = None) -> None:
    """Append by column name; ``files=1`` keeps a handful of rows in one file."""
    columns = df.sparkSession.table(table).columns
    narrowed = df.select(*columns)
    (narrowed.coalesce(files) if files else narrowed).write.insertInto(table)


def schema_problems(found: Iterable[str], expected: Iterable[str]) -> list[tuple[str, str]]:
    """``(column, problem)`` for each departure from the declared columns."""
    live, wanted = list(found), list(expected)
    return [(c, "missing column") for c in wanted if c not in live] + [
        (c, "unexpected column") for c in live if c not in wanted
    ]


def check_schema(
    tables: Mapping[str, DataFrame], expected: Mapping[str, Iterable[str]] = EVENT_TABLES
) -> DataFrame:
    """``(table_name, column_name, problem, rows_affected)`` over live tables.

    Only the columns are compared; the rows are counted to tell an empty table
    from one whose data lacks something.
    """
    spark = next(iter(tables.values())).sparkSession
    reports = [
        spark.createDataFrame(
            [(name, None, "missing table", 0) for name in expected if name not in tables],
            "table_name string, column_name string, problem string, rows_affected bigint",
        )
    ]
    for name, df in tables.items():
        problems = schema_problems(df.columns, expected[name])
        if problems:
            rows = [F.struct(F.lit(c).alias("column_name"), F.lit(text).alias("problem")) for c, text in problems]
            counted = df.agg(F.count("*").alias("rows_affected"))
            reports.append(counted.select(F.lit(name).alias("table_name"), F.inline(F.array(*rows)), "rows_affected"))
    return reduce(DataFrame.unionByName, reports)


def partition_stats(df: DataFrame, partition_by: Iterable[str]) -> DataFrame:
    """Rows, files and bytes per partition of a file-based table.

    Grouped by file first, so that a partition's rows are counted where they are
    read and only one row per file is shuffled.
    """
    columns = list(partition_by)
    per_file = df.groupBy(
        *columns, F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")
    ).agg(F.count("*").alias("rows"))
    return per_file.groupBy(*columns).agg(
        F.sum("rows").alias("record_count"),
        F.count("*").alias("file_count"),
        F.sum("file_size").alias("total_bytes"),
    )
