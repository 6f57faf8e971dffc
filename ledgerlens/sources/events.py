"""Event payloads: JSON on the wire, typed columns afterwards.

All functions but the readers work on batch and streaming DataFrames alike.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.schemas import Layout, ddl

# Topic names.
PAYMENTS_TOPIC = "payments.raw"
SIGNAL_TOPICS = ("fraud.signals", "customer.events")


def read_topics(
    spark: SparkSession,
    brokers: str,
    topics: Iterable[str],
    starting_offsets: str = "latest",
    max_offsets: int = 5000,
    fail_on_data_loss: bool = False,
) -> DataFrame:
    """A stream over one or more topics, with a cap per trigger as back-pressure.

    ``fail_on_data_loss``: stop where messages have gone before they were read, rather than go on after them.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting_offsets)
        .option("maxOffsetsPerTrigger", max_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .load()
    )


def read_json_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same stream from a folder of JSON-lines files; one line is one message."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def parse_payload(messages: DataFrame, layout: Layout, column: str = "value") -> DataFrame:
    """Message bytes to typed columns. Absent, ill-typed and non-finite fields are NULL.

    ``inline`` rather than ``d.*``: a later filter on a parsed field would be
    pushed below the projection and parse every message a second time.
    """
    parsed = messages.select(F.inline(F.array(F.from_json(F.col(column).cast("string"), ddl(layout)))))
    return parsed.select(*(_finite(c) if kind == "double" else F.col(c) for c, kind in layout.items()))


def parse_messages(messages: DataFrame, layout: Layout, column: str = "value") -> DataFrame:
    """As :func:`parse_payload`, with the text of the message beside its fields."""
    text = F.col(column).cast("string")
    parsed = messages.select(text.alias("message"), F.inline(F.array(F.from_json(text, ddl(layout)))))
    return parsed.select("message", *(_finite(c) if kind == "double" else F.col(c) for c, kind in layout.items()))


def _finite(column: str) -> Column:
    """NaN and the infinities are no amounts; one of them would spoil every total."""
    return F.when(F.abs(column) < F.lit(float("inf")), F.col(column)).alias(column)


def drop_malformed(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows whose key did not parse are no events."""
    return events.filter(F.col(key).isNotNull())


def rejected_messages(messages: DataFrame, layout: Layout, key: str = "event_id", column: str = "value") -> DataFrame:
    """The complement of :func:`drop_malformed`: the raw text of what it drops."""
    text = F.col(column).cast("string")
    parsed = messages.select(text.alias("message"), F.from_json(text, ddl(layout)).alias("d"))
    return parsed.filter(F.col(f"d.{key}").isNull()).select("message")


def with_event_date(events: DataFrame) -> DataFrame:
    return events.withColumn("event_date", F.to_date("timestamp"))


def with_arrival(events: DataFrame) -> DataFrame:
    """Arrival time and partition date."""
    return with_event_date(events.withColumn("ingested_at", F.current_timestamp()))
