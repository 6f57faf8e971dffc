"""One event stream, several tables, and one for what belongs to none of them.

Every message has one outcome: ``kept`` by a route, ``rejected`` because its key did not
parse, or ``unrouted`` because no route takes its type. The outcomes are counted while the
messages pass, so that what was read can be held against what was stored.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.schemas import AML_COLUMNS, CUSTOMER_EVENT_COLUMNS, EVENT_LAYOUTS, FRAUD_COLUMNS
from ledgerlens.streaming.tables import replace_batch, stream_of


@dataclass(frozen=True)
class Route:
    """The events of some types (None: of any), with the columns of their table."""

    event_types: tuple[str, ...] | None
    columns: tuple[str, ...]

    def accepts(self) -> Column:
        return F.lit(True) if self.event_types is None else F.col("event_type").isin(*self.event_types)


# Event types and the tables they belong to.
ROUTES: dict[str, Route] = {
    "fraud_alerts": Route(("FRAUD_SIGNAL",), FRAUD_COLUMNS),
    "aml_alerts": Route(("AML_ALERT",), AML_COLUMNS),
    "customer_events": Route(("CUSTOMER_LOGIN", "PROFILE_CHANGE", "ACCOUNT_OPEN"), CUSTOMER_EVENT_COLUMNS),
}


PAYMENT_ROUTES: dict[str, Route] = {"payment_transactions": Route(None, tuple(EVENT_LAYOUTS["payment_transactions"]))}

OUTCOMES = ("kept", "rejected", "unrouted")
#: Name of the counts in the progress of a stream.
INTAKE = "intake"


def judged(parsed: DataFrame, routes: Mapping[str, Route] = ROUTES, key: str = "event_id") -> DataFrame:
    """``parsed`` messages with their ``outcome``."""
    taken = reduce(Column.__or__, (r.accepts() for r in routes.values()))
    return parsed.withColumn("outcome", F.when(F.col(key).isNull(), "rejected").when(taken, "kept").otherwise("unrouted"))


def intake_counts() -> list[Column]:
    """Aggregates over judged messages: rows_read and the rows of each outcome."""
    return [F.count(F.lit(1)).alias("rows_read"), *(F.count_if(F.col("outcome") == o).alias(f"rows_{o}") for o in OUTCOMES)]


def rejected_rows(events: DataFrame, name: str) -> DataFrame:
    """The judged messages that stream ``name`` keeps in no event table, as rows of ``rejected_events``.

    Their day is that of their arrival, as they may have no readable time of their own.
    """
    return events.filter(F.col("outcome") != "kept").select(
        F.lit(name).alias("stream"), "outcome", "event_id", "event_type", "message", "ingested_at", F.to_date("ingested_at").alias("event_date")
    )


def route(events: DataFrame, table: str, routes: Mapping[str, Route] = ROUTES) -> DataFrame:
    """The part of a batch that belongs to ``table``."""
    wanted = routes[table]
    return events.filter(wanted.accepts()).select(*wanted.columns)


def batch_router(
    root: str, name: str = "signals", routes: Mapping[str, Route] = ROUTES, stream: Callable[[DataFrame], str] = stream_of
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each route to its table below ``root``, and the rest to ``rejected_events``.

    It takes judged messages. The batch is read once per table, so it is kept, with
    spilling to disk. A replayed batch replaces what it wrote, rejected rows included:
    its arrival time is recorded with the batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            kept = batch.filter(F.col("outcome") == "kept")
            for table in routes:
                replace_batch(route(kept, table, routes), root, table, stream(batch), batch_id)
            replace_batch(rejected_rows(batch, name), root, "rejected_events", stream(batch), batch_id)
        finally:
            batch.unpersist()

    return write
