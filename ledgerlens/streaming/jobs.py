"""The three streams: raw payments, five-minute aggregates, routed signals.

Transformations are the batch functions; only source, trigger and sink differ.
"""

from __future__ import annotations

import signal
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.plans.activity import payment_windows
from ledgerlens.schemas import PAYMENT_EVENT, SIGNAL_EVENT
from ledgerlens.sources.events import (
    PAYMENTS_TOPIC,
    SIGNAL_TOPICS,
    parse_messages,
    read_topics,
    with_arrival,
)
from ledgerlens.streaming.progress import ProgressLog
from ledgerlens.streaming.routing import INTAKE, PAYMENT_ROUTES, ROUTES, batch_router, intake_counts, judged
from ledgerlens.streaming.tables import replace_batch, stream_of

WATERMARK = "2 minutes"


@dataclass(frozen=True)
class StreamConfig:
    """Where streams read and write. ``available_now`` works off what is there and stops."""

    root: str
    checkpoints: str
    brokers: str = ""
    starting_offsets: str = "latest"
    max_offsets: int = 5000
    trigger_seconds: int = 30
    available_now: bool = False
    fail_on_data_loss: bool = False

    def trigger(self, factor: int = 1) -> dict[str, object]:
        if self.available_now:
            return {"availableNow": True}
        return {"processingTime": f"{self.trigger_seconds * factor} seconds"}


def judged_payments(messages: DataFrame) -> DataFrame:
    """Payments with arrival and outcome, counted as they pass."""
    return judged(with_arrival(parse_messages(messages, PAYMENT_EVENT)), PAYMENT_ROUTES).observe(INTAKE, *intake_counts())


def judged_signals(messages: DataFrame) -> DataFrame:
    """Signals with arrival and outcome, counted as they pass."""
    return judged(with_arrival(parse_messages(messages, SIGNAL_EVENT)), ROUTES).observe(INTAKE, *intake_counts())


def write_stream(
    df: DataFrame, cfg: StreamConfig, name: str, write: Callable[[DataFrame, int], None], factor: int = 1
) -> StreamingQuery:
    """Append through ``write``, which takes each micro-batch and its number."""
    return (
        df.writeStream.foreachBatch(write)
        .outputMode("append")
        .queryName(name)
        .trigger(**cfg.trigger(factor))
        .option("checkpointLocation", f"{cfg.checkpoints}/{name}")
        .start()
    )


def _into(cfg: StreamConfig, table: str) -> Callable[[DataFrame, int], None]:
    return lambda batch, batch_id: replace_batch(batch, cfg.root, table, stream_of(batch), batch_id)


def start_payments(messages: DataFrame, cfg: StreamConfig) -> StreamingQuery:
    table = "payment_transactions"
    return write_stream(judged_payments(messages), cfg, table, batch_router(cfg.root, table, PAYMENT_ROUTES))


def start_aggregates(messages: DataFrame, cfg: StreamConfig) -> StreamingQuery:
    """A window is written once, when the watermark has passed its end.

    Malformed messages are counted here and stored by the stream of raw payments.
    """
    table = "payment_agg"
    windows = payment_windows(judged_payments(messages).filter(F.col("outcome") == "kept"), WATERMARK)
    return write_stream(windows, cfg, table, _into(cfg, table), factor=2)


def start_signals(messages: DataFrame, cfg: StreamConfig) -> StreamingQuery:
    return write_stream(judged_signals(messages), cfg, "signals", batch_router(cfg.root))


STREAMS: dict[str, tuple[tuple[str, ...], Callable[[DataFrame, StreamConfig], StreamingQuery]]] = {
    "payments": ((PAYMENTS_TOPIC,), start_payments),
    "aggregates": ((PAYMENTS_TOPIC,), start_aggregates),
    "signals": (SIGNAL_TOPICS, start_signals),
}


def topic_reader(spark: SparkSession, cfg: StreamConfig) -> Callable[[tuple[str, ...]], DataFrame]:
    """Messages of some topics; streams over several topics share half the cap."""

    def read(topics: tuple[str, ...]) -> DataFrame:
        cap = cfg.max_offsets if len(topics) == 1 else max(cfg.max_offsets // 2, 1)
        return read_topics(spark, cfg.brokers, topics, cfg.starting_offsets, cap, cfg.fail_on_data_loss)

    return read


def start_streams(
    read: Callable[[tuple[str, ...]], DataFrame], cfg: StreamConfig, names: Iterable[str] = tuple(STREAMS)
) -> Mapping[str, StreamingQuery]:
    return {name: STREAMS[name][1](read(STREAMS[name][0]), cfg) for name in names}


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    """Stop after the running micro-batch; one query that fails to stop does not keep the rest running."""
    errors = []
    for query in queries:
        try:
            if query.isActive:
                query.stop()
        except Exception as error:  # noqa: BLE001
            errors.append(f"{query.name}: {error}")
    if errors:
        raise RuntimeError("; ".join(errors))


def run_streams(
    spark: SparkSession, cfg: StreamConfig, names: Iterable[str] = tuple(STREAMS), progress_table: str | None = None, flush_seconds: int = 60
) -> None:
    """Start the named streams and wait. Raises as soon as one fails; stops all on SIGTERM or SIGINT.

    Their progress goes to ``progress_table`` every ``flush_seconds`` and at the end.
    """
    log = ProgressLog()
    if progress_table:
        spark.streams.addListener(log)
    queries: Mapping[str, StreamingQuery] = {}
    try:
        queries = start_streams(topic_reader(spark, cfg), cfg, names)
        for number in (signal.SIGTERM, signal.SIGINT):
            signal.signal(number, lambda *_: stop_all(queries.values()))
        while not spark.streams.awaitAnyTermination(flush_seconds):
            if progress_table:
                log.flush(spark, progress_table)
    finally:
        try:
            stop_all(queries.values())
        finally:
            if progress_table:
                spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
                spark.streams.removeListener(log)
                log.flush(spark, progress_table)
