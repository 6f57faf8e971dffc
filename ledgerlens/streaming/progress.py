"""Progress of running streams, as rows."""

from __future__ import annotations

import threading
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ledgerlens.schemas import Layout, ddl
from ledgerlens.sources.tables import append, ensure_table, widen_table
from ledgerlens.streaming.routing import INTAKE, OUTCOMES

PROGRESS: Layout = {
    "query_id": "string",
    "query_name": "string",
    "batch_id": "bigint",
    "trigger_at": "timestamp",
    "rows_in": "bigint",
    "rows_per_second": "double",
    "trigger_ms": "bigint",
    "status": "string",
    "rows_read": "bigint",
    "rows_kept": "bigint",
    "rows_rejected": "bigint",
    "rows_unrouted": "bigint",
    "rows_late": "bigint",
    "state_rows": "bigint",
}


class ProgressLog(StreamingQueryListener):
    """Collects one row per trigger; :meth:`flush` moves them to a table.

    The callbacks only note the figures: running a job inside one would hold up
    the streams.
    """

    def __init__(self) -> None:
        self._rows: list[tuple] = []
        self._names: dict[str, str] = {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        self._names[str(event.id)] = event.name

    def onQueryProgress(self, event) -> None:
        p = event.progress
        spent = dict(p.durationMs).get("triggerExecution")
        counted = p.observedMetrics.get(INTAKE)
        intake = [counted[c] if counted else None for c in ("rows_read", *(f"rows_{o}" for o in OUTCOMES))]
        held = p.stateOperators
        late = sum(o.numRowsDroppedByWatermark for o in held) if held else None
        state = sum(o.numRowsTotal for o in held) if held else None
        self._note(str(p.id), p.name, p.batchId, p.timestamp, p.numInputRows, p.processedRowsPerSecond, spent, "RUNNING", *intake, late, state)

    def onQueryIdle(self, event) -> None:
        self._note(str(event.id), None, None, event.timestamp, 0, 0.0, None, "IDLE")

    def onQueryTerminated(self, event) -> None:
        now = datetime.now(timezone.utc).isoformat(timespec="milliseconds")
        self._note(str(event.id), None, None, now, 0, 0.0, None, "FAILED" if event.exception else "STOPPED")

    def _note(self, query_id, name, batch_id, moment, rows, rate, spent, status, *counts) -> None:
        with self._lock:
            self._rows.append((query_id, name or self._names.get(query_id), batch_id, moment, rows, rate, spent, status, *counts))

    def rows(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            noted = list(self._rows)
        return self._frame(spark, noted)

    @staticmethod
    def _frame(spark: SparkSession, noted: list[tuple]) -> DataFrame:
        plain = {**PROGRESS, "trigger_at": "string"}
        whole = [(*row, *[None] * (len(plain) - len(row))) for row in noted]
        return spark.createDataFrame(whole, ddl(plain)).withColumn("trigger_at", F.col("trigger_at").cast("timestamp"))

    def flush(self, spark: SparkSession, table: str) -> int:
        """Append what was noted since the last flush; rows stay noted if the write fails."""
        with self._lock:
            noted = list(self._rows)
        if noted:
            append(self._frame(spark, noted), widen_table(spark, ensure_table(spark, table, PROGRESS), PROGRESS), files=1)
            with self._lock:
                del self._rows[: len(noted)]
        return len(noted)


def progress_report(progress: DataFrame, idle_triggers: int = 3) -> DataFrame:
    """Per query: rows and rate in total, its last state, and whether it runs without receiving anything.

    ``starved`` means that none of the last ``idle_triggers`` triggers had a row,
    which is how a wrong topic or an idle producer shows. A query keeps its id when
    it is started again, so its newest row tells its state; an end without a time
    counts as newest.
    """
    ends = F.col("status").isin("FAILED", "STOPPED")
    triggers = progress.filter(~ends & F.col("trigger_at").isNotNull())
    never = F.col("trigger_at").isNull() & ends
    newest = Window.partitionBy("query_id").orderBy(
        F.col("trigger_at").desc(), F.col("batch_id").desc_nulls_last(), F.col("rows_in").desc()
    )
    recent = (
        triggers.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= idle_triggers)
        .groupBy("query_id")
        .agg(F.sum("rows_in").alias("_recent_rows"), F.count("*").alias("_recent_triggers"))
    )
    totals = progress.groupBy("query_id").agg(
        F.max("query_name").alias("query_name"),
        F.count_if(~ends & F.col("trigger_at").isNotNull()).alias("triggers"),
        F.sum("rows_in").alias("rows_in"),
        F.max("rows_per_second").alias("peak_rows_per_second"),
        F.max("trigger_ms").alias("slowest_trigger_ms"),
        F.max(F.when(~ends, F.col("trigger_at"))).alias("last_trigger_at"),
        F.max_by(F.when(ends, F.col("status")), F.struct(never, "trigger_at", ends, "status")).alias("_ended"),
    )
    running = F.col("_ended").isNull()
    starved = running & (F.col("_recent_triggers") >= idle_triggers) & (F.col("_recent_rows") == 0)
    return totals.join(recent, "query_id", "left").select(
        "query_id",
        "query_name",
        "triggers",
        "rows_in",
        "peak_rows_per_second",
        "slowest_trigger_ms",
        "last_trigger_at",
        F.coalesce("_ended", F.lit("RUNNING")).alias("status"),
        F.coalesce(starved, F.lit(False)).alias("starved"),
    )


def intake_report(progress: DataFrame) -> DataFrame:
    """Per query: what became of the messages it read, and of the rows that came too late for its windows.

    ``unaccounted`` is what was read and neither kept, rejected nor unrouted: 0 unless
    messages were lost on the way. ``rows_late`` are rows below the watermark that no
    window took; late rows of one window that arrive in one trigger are combined before
    they are counted, so it is a lower bound of the events. A trigger that ran twice is
    counted by its newest row.
    """
    counts = ["rows_read", *(f"rows_{o}" for o in OUTCOMES), "rows_late"]
    ran = progress.filter(F.col("batch_id").isNotNull() & (F.col("rows_read").isNotNull() | F.col("rows_late").isNotNull()))
    newest = F.max_by(F.struct("query_name", *counts, "state_rows"), F.struct("trigger_at", "rows_in")).alias("last")
    triggers = ran.groupBy("query_id", "batch_id").agg(newest).select("query_id", "batch_id", "last.*")
    totals = triggers.groupBy("query_id").agg(
        F.max("query_name").alias("query_name"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts), F.max("state_rows").alias("peak_state_rows")
    )
    stored = reduce(Column.__add__, (F.col(f"rows_{o}") for o in OUTCOMES))
    return totals.withColumn("unaccounted", F.col("rows_read") - stored)
