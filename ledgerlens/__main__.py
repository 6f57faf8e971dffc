"""Jobs for ``spark-submit``: streams, compaction, batch ingestion, expiry, reports and questions."""

from __future__ import annotations

import argparse
import os
import sys
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.params import asked_limit, in_utc
from ledgerlens.operators.question_rules import ACTIVITY_RULES, CUSTOMER_RULES
from ledgerlens.operators.upsert import expire_versions
from ledgerlens.plans import catalogue, ingestion
from ledgerlens.schemas import EVENT_LAYOUTS
from ledgerlens.session import build_session
from ledgerlens.sources.tables import read_table
from ledgerlens.streaming.jobs import STREAMS, StreamConfig, run_streams
from ledgerlens.streaming.tables import compact_days, read_event_table


def moment(text: str) -> datetime:
    """An ISO time; without a zone it is UTC."""
    try:
        return in_utc(datetime.fromisoformat(text))
    except ValueError:
        raise argparse.ArgumentTypeError(f"{text!r} is no ISO date or time") from None


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ledgerlens", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    stream = jobs.add_parser("stream", help="run one or all streams until stopped")
    stream.add_argument("--stream", choices=["all", *STREAMS], default="all")
    stream.add_argument("--brokers", required=True)
    stream.add_argument("--root", required=True, help="folder of the event tables")
    stream.add_argument("--checkpoints", required=True)
    stream.add_argument("--starting-offsets", choices=["latest", "earliest"], default="latest")
    stream.add_argument("--max-offsets", type=int, default=5000)
    stream.add_argument("--trigger-seconds", type=int, default=30)
    stream.add_argument("--fail-on-data-loss", action="store_true", help="stop where messages have gone before they were read")
    stream.add_argument("--progress-table", help="table that receives one row per trigger")

    batch = jobs.add_parser("batch", help="ingest customers, accounts and the daily roll-up")
    batch.add_argument("--source", choices=["all", "customers", "accounts", "payments_daily"], default="all")
    batch.add_argument("--schema", default="ingestion")
    batch.add_argument("--mode", choices=["incremental", "full"], default="incremental")
    batch.add_argument("--since", type=moment)
    batch.add_argument("--lookback-days", type=int, default=1)
    batch.add_argument("--dry-run", action="store_true")
    batch.add_argument("--provider", default="parquet", help="table format of new targets")
    batch.add_argument("--row-level", action="store_true", help="let the tables merge, where their format can")
    batch.add_argument("--jdbc-url", help="user and password come from JDBC_USER and JDBC_PASSWORD")
    batch.add_argument("--jdbc-driver")
    batch.add_argument("--jdbc-table", default="customers")
    batch.add_argument("--jdbc-fetch-size", type=int, default=5000)
    batch.add_argument("--jdbc-timestamp-sql", default="{column}", help="the source's SQL that makes {column} a plain UTC timestamp")
    batch.add_argument("--jdbc-literal-sql", default="TIMESTAMP '{text}'", help="the source's SQL for the UTC timestamp {text}")
    batch.add_argument("--num-partitions", type=int, default=1)
    batch.add_argument("--shard-sql", help="non-negative whole number per row, in the source's SQL, for parallel reads")
    batch.add_argument("--accounts-path")
    batch.add_argument("--accounts-pattern", default="*.csv")
    batch.add_argument("--payments-table", default="banking.payment_transactions")

    compact = jobs.add_parser("compact", help="merge the files of closed days of a streamed table")
    compact.add_argument("--root", required=True)
    compact.add_argument("--table", choices=list(EVENT_LAYOUTS), required=True)
    compact.add_argument("--day", type=date.fromisoformat, action="append", required=True, help="may be repeated")

    expire = jobs.add_parser("expire", help="delete old versions of a batch-loaded dimension")
    expire.add_argument("--table", required=True)
    expire.add_argument("--keep-last", type=int, default=2)

    for name, words in (("report", "run a report by name"), ("ask", "answer a question")):
        job = jobs.add_parser(name, help=words)
        job.add_argument("what", help="report name" if name == "report" else "the question")
        job.add_argument("--tables", required=True, help="schema or folder that holds the event tables and the customers")
        job.add_argument("--batch-tables", default="ingestion", help="schema or folder of the batch-loaded tables")
        job.add_argument("--as-of", type=moment, help="default: now")
        job.add_argument("--hours", type=int)
        job.add_argument("--days", type=int)
        job.add_argument("--limit", type=asked_limit)
        job.add_argument("--score", type=float)
        job.add_argument("--account")
        job.add_argument("--customers", action="store_true", help="ask about customers rather than about events")
        job.add_argument("--output", help="Parquet folder; default: print")
    return top


class LazyTables(dict):
    """Tables by name, read when a report asks for them."""

    def __init__(self, spark: SparkSession, home: str, batch_home: str) -> None:
        super().__init__()
        self._spark, self._home, self._batch_home = spark, home, batch_home

    def __missing__(self, name: str) -> DataFrame:
        home = (self._batch_home if name in catalogue.BATCH_TABLES else self._home).rstrip("/")
        if "/" not in home:
            self[name] = read_table(self._spark, f"{home}.{name}")
        elif name in EVENT_LAYOUTS:
            self[name] = read_event_table(self._spark, home, name)
        else:
            self[name] = read_table(self._spark, f"{home}/{name}")
        return self[name]


def sources(args: argparse.Namespace) -> list[ingestion.Source]:
    options = {"url": args.jdbc_url or "", "fetchsize": str(args.jdbc_fetch_size)}
    for key, value in (("driver", args.jdbc_driver), ("user", os.environ.get("JDBC_USER")), ("password", os.environ.get("JDBC_PASSWORD"))):
        if value:
            options[key] = value
    built = [
        ingestion.customers_source(
            options, args.jdbc_table, num_partitions=args.num_partitions, shard_sql=args.shard_sql,
            timestamp_sql=args.jdbc_timestamp_sql, literal_sql=args.jdbc_literal_sql,
        ),
        ingestion.accounts_source(args.accounts_path or "", args.accounts_pattern),
        ingestion.payments_source(args.payments_table),
    ]
    return [s for s in built if args.source in ("all", s.name)]


def run_batch(spark: SparkSession, args: argparse.Namespace) -> int:
    cfg = ingestion.BatchConfig(
        schema=args.schema,
        mode=args.mode,
        since=args.since,
        lookback_days=args.lookback_days,
        dry_run=args.dry_run,
        provider=args.provider,
        row_level=args.row_level,
    )
    log, failed = ingestion.run_batch(spark, cfg, sources(args))
    log.select("source", "status", "rows_read", "rows_inserted", "rows_updated", "message").show(log.count(), truncate=False)
    return 1 if failed else 0


def print_rows(result: DataFrame) -> None:
    """Every row as a line of JSON; rows pass the driver partition by partition."""
    for line in result.select(F.to_json(F.struct(*result.columns), {"ignoreNullFields": "false"})).toLocalIterator():
        print(line[0])


def run_report(spark: SparkSession, args: argparse.Namespace) -> int:
    tables = LazyTables(spark, args.tables, args.batch_tables)
    as_of = args.as_of or datetime.now(timezone.utc)
    params = {name: getattr(args, name) for name in ("hours", "days", "limit", "score")}
    if args.job == "ask":
        rules = CUSTOMER_RULES if args.customers else ACTIVITY_RULES
        name, account = catalogue.question_report(spark, args.what, rules), args.what
    else:
        name, account = args.what, args.account
    result = catalogue.run_report(name, tables, as_of=as_of, account=account, **params)
    if name == "quality_report":
        result.persist()  # a few rows, read twice
    if args.output:
        result.write.parquet(args.output)
    else:
        print_rows(result)
    return 1 if name == "quality_report" and not result.filter("status = 'FAIL'").isEmpty() else 0


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session(f"ledgerlens-{args.job}")
    if args.job == "stream":
        cfg = StreamConfig(
            args.root, args.checkpoints, args.brokers, args.starting_offsets, args.max_offsets, args.trigger_seconds,
            fail_on_data_loss=args.fail_on_data_loss,
        )
        run_streams(spark, cfg, STREAMS if args.stream == "all" else [args.stream], args.progress_table)
        return 0
    if args.job == "compact":
        compact_days(spark, args.root.rstrip("/"), args.table, args.day)
        return 0
    if args.job == "expire":
        print(f"{expire_versions(spark, args.table, args.keep_last)} version(s) deleted")
        return 0
    return run_batch(spark, args) if args.job == "batch" else run_report(spark, args)


if __name__ == "__main__":
    sys.exit(main())
