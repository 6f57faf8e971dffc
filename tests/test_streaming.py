from __future__ import annotations

import json
import os
from datetime import date
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerlens.schemas import EVENT_LAYOUTS, PAYMENT_EVENT, SIGNAL_EVENT
from ledgerlens.session import list_folders
from ledgerlens.sources.events import drop_malformed, parse_messages, parse_payload, read_json_files, rejected_messages, with_arrival
from ledgerlens.streaming import jobs, tables
from ledgerlens.streaming.jobs import StreamConfig, start_aggregates, start_payments, start_signals, start_streams, stop_all
from ledgerlens.streaming.progress import PROGRESS, ProgressLog, intake_report, progress_report
from ledgerlens.streaming.routing import ROUTES, batch_router, judged, route
from ledgerlens.streaming.tables import compact_days, read_event_table, replace_batch, stream_of


@pytest.fixture
def lake(tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    return inbox, StreamConfig(root=str(tmp_path / "out"), checkpoints=str(tmp_path / "chk"), available_now=True)


def drop(inbox, name, messages):
    """One file per micro-batch, moved into place whole."""
    text = "\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages) + "\n"
    (inbox / f".{name}").write_text(text)
    (inbox / f".{name}").rename(inbox / name)


def payment(event_id, time, **extra):
    return {
        "event_id": event_id, "event_type": "CARD_PAYMENT", "timestamp": f"2024-05-02T{time}+00:00", "transaction_id": event_id,
        "account_id": "ACC-TH-10000001", "amount": 10.5, "channel": "POS", "merchant_category": "RETAIL", "status": "APPROVED",
        "city": "Bangkok", "is_international": False, "risk_score": 0.25, **extra,
    }


def run(start, spark, inbox, cfg):
    query = start(read_json_files(spark, str(inbox), 1), cfg)
    query.awaitTermination(120)
    assert query.exception() is None


def test_payload_parsing(spark):
    messages = spark.createDataFrame(
        [(json.dumps(payment("p1", "10:00:00.123456")),), ("garbage",), (json.dumps(payment("p2", "10:00:00", amount="a lot")),), (None,)], "value string"
    )
    parsed = drop_malformed(parse_payload(messages, PAYMENT_EVENT))
    got = {r.event_id: (r.amount, r.t, r.country) for r in parsed.withColumn("t", F.col("timestamp").cast("string")).collect()}
    assert got == {"p1": (10.5, "2024-05-02 10:00:00.123456", None), "p2": (None, "2024-05-02 10:00:00", None)}
    assert [r.message for r in rejected_messages(messages, PAYMENT_EVENT).collect()] == ["garbage", None]
    binary = messages.select(F.col("value").cast("binary").alias("value"))
    assert drop_malformed(parse_payload(binary, PAYMENT_EVENT)).count() == 2


def test_numbers_that_are_none(spark):
    texts = [json.dumps(payment(str(i), "10:00:00", amount=v)) for i, v in enumerate((float("nan"), "NaN", float("-inf"), "Infinity", -1.5))]
    parsed = drop_malformed(parse_payload(spark.createDataFrame([(t,) for t in texts], "value string"), PAYMENT_EVENT))
    assert {r.event_id: r.amount for r in parsed.collect()} == {"0": None, "1": None, "2": None, "3": None, "4": -1.5}


def test_payments_are_appended_once_across_restarts(spark, lake):
    inbox, cfg = lake
    drop(inbox, "a.json", [payment("1", "10:00:00"), "not json", payment("2", "23:59:59.999999", city="Phuket")])
    run(start_payments, spark, inbox, cfg)
    run(start_payments, spark, inbox, cfg)
    drop(inbox, "b.json", [payment("3", "10:00:00")])
    run(start_payments, spark, inbox, cfg)
    table = read_event_table(spark, cfg.root, "payment_transactions")
    assert table.count() == 3 and {(r.event_id, r.city, str(r.event_date)) for r in table.collect()} == {
        ("1", "Bangkok", "2024-05-02"), ("2", "Phuket", "2024-05-02"), ("3", "Bangkok", "2024-05-02"),
    }
    assert table.filter("ingested_at IS NULL").count() == 0


def test_a_stream_started_afresh_keeps_earlier_rows(spark, lake):
    inbox, cfg = lake
    drop(inbox, "a.json", [payment("1", "10:00:00")])
    run(start_payments, spark, inbox, cfg)
    fresh = StreamConfig(root=cfg.root, checkpoints=cfg.checkpoints + "2", available_now=True)
    run(start_payments, spark, inbox, fresh)
    assert read_event_table(spark, cfg.root, "payment_transactions").count() == 2
    with pytest.raises(ValueError):
        stream_of(spark.range(1))


def test_compaction_of_a_closed_day_between_batches(spark, lake):
    inbox, cfg = lake

    def files(day):
        return list((Path(cfg.root) / "payment_transactions" / f"event_date=2024-05-{day}").rglob("*.parquet"))

    for i in range(4):
        day = "2024-05-01T10:00:00+00:00"
        drop(inbox, f"{i}.json", [payment(f"a{i}", "10:00:00", timestamp=day), payment(f"b{i}", "10:00:00", city="7"), payment(f"c{i}", "10:00:00", timestamp=day, city=None)])
        run(start_payments, spark, inbox, cfg)
    table = read_event_table(spark, cfg.root, "payment_transactions")
    before = sorted(tuple(r) for r in table.selectExpr("event_id", "cast(event_date as string)", "coalesce(city, 'none')", "amount").collect())
    assert len(before) == 12 and len(files("01")) == 8 and len(files("02")) == 4
    compact_days(spark, cfg.root, "payment_transactions", [date(2024, 5, 1)])
    # Of each city one compacted file and one of the stream's newest batch, which may come again.
    assert len(files("01")) == 4 and len(files("02")) == 4
    spark.catalog.refreshByPath(cfg.root)
    table = read_event_table(spark, cfg.root, "payment_transactions")
    assert sorted(tuple(r) for r in table.selectExpr("event_id", "cast(event_date as string)", "coalesce(city, 'none')", "amount").collect()) == before
    drop(inbox, "z.json", [payment("z", "11:00:00")])
    run(start_payments, spark, inbox, cfg)
    assert read_event_table(spark, cfg.root, "payment_transactions").count() == 13


@pytest.mark.parametrize("stop", ["write", "ready", "delete", None])
def test_compaction_keeps_every_event_once(spark, tmp_path, monkeypatch, stop):
    """A late batch arrives, the newest one is replayed, and the run may stop at any step."""
    root, table, day = str(tmp_path), "customer_events", date(2024, 5, 1)
    columns = EVENT_LAYOUTS[table]

    def batch(n):
        values = {"event_id": F.lit(str(n)), "event_date": F.lit("2024-05-01")}
        rows = spark.range(1).select(*(values.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()))
        replace_batch(rows, root, table, "s", n)

    def events():
        return sorted(r.event_id for r in read_event_table(spark, root, table).collect())

    for n in range(4):
        batch(n)
    note = tables._note

    def noted(spark, home, name, state, day, batches):
        if state == "ready":
            batch(9)
            if stop == "write":
                raise RuntimeError(stop)
        note(spark, home, name, state, day, batches)
        if state == stop:
            raise RuntimeError(stop)

    def removed(spark, folder):
        raise RuntimeError("delete")

    with monkeypatch.context() as patched:
        patched.setattr(tables, "_note", noted)
        if stop == "delete":
            patched.setattr(tables, "remove_folder", removed)
        if stop is None:
            compact_days(spark, root, table, [day])
        else:
            with pytest.raises(RuntimeError):
                compact_days(spark, root, table, [day])
    assert events() == ["0", "1", "2", "3", "9"]
    batch(9)
    assert events() == ["0", "1", "2", "3", "9"]
    compact_days(spark, root, table, [day])
    assert events() == ["0", "1", "2", "3", "9"]
    assert list_folders(spark, f"{root}/{table}/{tables.NOTES}") == []


def test_compacted_days_are_looked_up_by_account(spark, tmp_path):
    """Of eight files of a day, a filter on one account can match the statistics of two at most."""
    root, table, day = str(tmp_path), "customer_events", date(2024, 5, 1)
    for n in range(3):
        number = F.xxhash64("id", F.lit(n)) % 2000
        values = {"event_id": F.concat_ws("-", F.lit(n), "id"), "event_date": F.lit("2024-05-01"), "account_id": F.format_string("ACC-TH-%08d", number + 3000)}
        rows = spark.range(8000).select(*(values.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in EVENT_LAYOUTS[table].items()))
        replace_batch(rows, root, table, "s", n)
    before = read_event_table(spark, root, table).groupBy("account_id").count().collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        compact_days(spark, root, table, [day])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(read_event_table(spark, root, table).groupBy("account_id").count().collect()) == sorted(before)
    ranges = []
    for file in (Path(root) / table).rglob(f"*{tables.COMPACTED}*/*.parquet"):
        footer = pq.ParquetFile(file).metadata
        at = footer.schema.names.index("account_id")
        of_groups = [footer.row_group(i).column(at).statistics for i in range(footer.num_row_groups)]
        ranges.append((min(s.min for s in of_groups), max(s.max for s in of_groups)))
    assert len(ranges) == 8
    for account in (before[0].account_id, before[len(before) // 2].account_id):
        assert 1 <= sum(low <= account <= high for low, high in ranges) <= 2


def test_windows_with_late_events(spark, lake):
    """A window is written once the watermark passes its end; later events for it are dropped."""
    inbox, cfg = lake

    def emitted():
        windows = read_event_table(spark, cfg.root, "payment_agg")
        return {str(r.s): r.txn_count for r in windows.select(F.date_format("window_start", "HH:mm").alias("s"), "txn_count").collect()}

    drop(inbox, "a.json", [payment("1", "00:01:00"), payment("2", "00:04:59"), payment("3", "00:05:00")])
    run(start_aggregates, spark, inbox, cfg)
    assert emitted() == {}
    drop(inbox, "b.json", [payment("4", "00:12:00")])
    run(start_aggregates, spark, inbox, cfg)
    assert emitted() == {"00:00": 2, "00:05": 1}
    drop(inbox, "c.json", [payment("5", "00:02:00"), payment("6", "00:11:00")])
    run(start_aggregates, spark, inbox, cfg)
    assert emitted() == {"00:00": 2, "00:05": 1}
    drop(inbox, "d.json", [payment("7", "00:30:00")])
    run(start_aggregates, spark, inbox, cfg)
    assert emitted() == {"00:00": 2, "00:05": 1, "00:10": 2}
    row = read_event_table(spark, cfg.root, "payment_agg").filter("txn_count = 2").orderBy("window_start").first()
    assert (row.total_amount, row.avg_amount, row.max_amount, row.approved_count, row.declined_count, row.avg_risk_score) == (21.0, 10.5, 10.5, 2, 0, 0.25)


def signals():
    base = {"timestamp": "2024-05-02T10:00:00+00:00", "account_id": "ACC-TH-10000001"}
    return [
        {**base, "event_id": "f", "event_type": "FRAUD_SIGNAL", "fraud_type": "IDENTITY_THEFT", "ml_score": 0.9, "rule_triggers": ["R1", "R2"], "action": "FLAG_REVIEW", "case_id": "C"},
        {**base, "event_id": "m", "event_type": "AML_ALERT", "alert_type": "LAYERING", "risk_band": "HIGH", "sar_required": True, "total_amount_7d": 5.0},
        {**base, "event_id": "l", "event_type": "CUSTOMER_LOGIN", "channel": "WEB", "auth_method": "OTP", "login_success": False, "new_device": True},
        {**base, "event_id": "o", "event_type": "ACCOUNT_OPEN"},
        {**base, "event_id": "u", "event_type": "SOMETHING_ELSE"},
        "not json",
    ]


def stored(spark, cfg):
    return {table: {r.event_id for r in read_event_table(spark, cfg.root, table).collect()} for table in ROUTES}


WANTED = {"fraud_alerts": {"f"}, "aml_alerts": {"m"}, "customer_events": {"l", "o"}}


def test_signals_are_routed_by_type(spark, lake):
    inbox, cfg = lake
    drop(inbox, "a.json", signals())
    run(start_signals, spark, inbox, cfg)
    assert stored(spark, cfg) == WANTED
    fraud = read_event_table(spark, cfg.root, "fraud_alerts").first()
    assert (fraud.ml_score, fraud.fraud_type, str(fraud.event_date), fraud.rule_triggers) == (0.9, "IDENTITY_THEFT", "2024-05-02", ["R1", "R2"])
    left = {(r.stream, r.outcome, r.event_id, r.event_type, r.message) for r in read_event_table(spark, cfg.root, "rejected_events").collect()}
    unrouted = json.dumps(signals()[4])
    assert left == {("signals", "rejected", None, None, "not json"), ("signals", "unrouted", "u", "SOMETHING_ELSE", unrouted)}


def test_a_replayed_batch_does_not_count_twice(spark, lake):
    _, cfg = lake
    messages = spark.createDataFrame([(m if isinstance(m, str) else json.dumps(m),) for m in signals()], "value string")
    events = judged(with_arrival(parse_messages(messages, SIGNAL_EVENT)))
    write = batch_router(cfg.root, stream=lambda _: "s1")
    for batch_id in (0, 1, 1, 0):
        write(events, batch_id)
    for table, ids in WANTED.items():
        df = read_event_table(spark, cfg.root, table)
        assert df.count() == 2 * len(ids), table
    left = read_event_table(spark, cfg.root, "rejected_events")
    assert sorted((r.outcome, r.event_id) for r in left.collect()) == [("rejected", None)] * 2 + [("unrouted", "u")] * 2
    assert route(events, "customer_events").columns == list(ROUTES["customer_events"].columns)


def test_streams_run_together_and_report_progress(spark, lake):
    inbox, cfg = lake
    drop(inbox, "a.json", [payment("1", "10:00:00"), payment("2", "10:01:00")])
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        queries = start_streams(lambda topics: read_json_files(spark, str(inbox), 1), cfg)
        for query in queries.values():
            query.awaitTermination(120)
        stop_all(queries.values())
        assert not any(q.isActive for q in queries.values())
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    report = {r.query_name: r for r in progress_report(log.rows(spark)).collect()}
    assert set(report) == {"payment_transactions", "payment_agg", "signals"}
    assert report["payment_transactions"].rows_in == 2
    assert report["payment_transactions"].status == "STOPPED" and not report["payment_transactions"].starved
    noted = log.rows(spark).count()
    assert log.flush(spark, "stream_log.progress") == noted
    assert spark.table("stream_log.progress").count() == noted and log.flush(spark, "stream_log.progress") == 0


def test_a_stream_without_input_is_flagged(spark):
    rows = [("q1", "dry", i, f"2024-05-02 10:0{i}:00", 5 if i == 0 else 0, 0.0, 10, "RUNNING") for i in range(4)]
    rows += [("q2", "busy", i, f"2024-05-02 10:0{i}:00", 1 if i == 3 else 0, 0.0, 10, "RUNNING") for i in range(4)]
    rows += [("q3", "new", 0, "2024-05-02 10:00:00", 0, 0.0, 10, "RUNNING")]
    rows += [("q4", "gone", i, f"2024-05-02 10:0{i}:00", 0, 0.0, 10, "RUNNING") for i in range(3)] + [("q4", "gone", None, None, 0, 0.0, None, "FAILED")]
    log = ProgressLog._frame(spark, rows)
    got = {r.query_name: (r.status, r.starved, r.rows_in) for r in progress_report(log, 3).collect()}
    assert got == {"dry": ("RUNNING", True, 5), "busy": ("RUNNING", False, 1), "new": ("RUNNING", False, 0), "gone": ("FAILED", False, 0)}


def test_the_stream_job_writes_its_progress(spark, lake, monkeypatch):
    inbox, cfg = lake
    drop(inbox, "a.json", [payment("1", "10:00:00"), payment("2", "10:01:00")])
    monkeypatch.setattr(jobs, "topic_reader", lambda spark, cfg: lambda topics: read_json_files(spark, str(inbox), 1))
    monkeypatch.setattr(jobs.signal, "signal", lambda *_: None)
    spark.streams.resetTerminated()
    jobs.run_streams(spark, cfg, ["payments"], "stream_job.progress", 1)
    report = progress_report(spark.table("stream_job.progress")).collect()
    assert [(r.query_name, r.status, r.rows_in) for r in report] == [("payment_transactions", "STOPPED", 2)]


def test_the_newest_run_tells_the_state(spark):
    rows = [("q1", "again", 0, "2024-05-02 10:00:00", 9, 0.0, 10, "RUNNING"), ("q1", "again", None, "2024-05-02 10:01:00", 0, 0.0, None, "STOPPED")]
    rows += [("q1", "again", i, f"2024-05-02 11:0{i}:00", 0, 0.0, 10, "RUNNING") for i in range(4)]
    rows += [("q2", "failed", None, "2024-05-02 10:01:00", 0, 0.0, None, "STOPPED"), ("q2", "failed", None, "2024-05-02 10:02:00", 0, 0.0, None, "FAILED")]
    rows += [("q3", "stopped", None, "2024-05-02 10:01:00", 0, 0.0, None, "FAILED"), ("q3", "stopped", None, "2024-05-02 10:02:00", 0, 0.0, None, "STOPPED")]
    got = {r.query_name: (r.status, r.starved, r.triggers) for r in progress_report(ProgressLog._frame(spark, rows), 3).collect()}
    assert got == {"again": ("RUNNING", True, 5), "failed": ("FAILED", False, 0), "stopped": ("STOPPED", False, 0)}


def test_a_failing_stream_raises(spark, lake):
    inbox, cfg = lake
    drop(inbox, "a.json", signals())

    def broken(batch, batch_id):
        raise RuntimeError("table is gone")

    query = read_json_files(spark, str(inbox)).writeStream.foreachBatch(broken).option("checkpointLocation", f"{cfg.checkpoints}/x").trigger(availableNow=True).start()
    with pytest.raises(Exception, match="table is gone"):
        query.awaitTermination(120)


def progress_of(spark, start, inbox, cfg):
    """Progress of one stream run to its end."""
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        run(start, spark, inbox, cfg)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    return log.rows(spark)


def account(progress):
    return [(r.query_name, r.rows_read, r.rows_kept, r.rows_rejected, r.rows_unrouted, r.rows_late, r.unaccounted) for r in intake_report(progress).collect()]


def test_every_message_read_is_accounted_for(spark, lake):
    inbox, cfg = lake
    drop(inbox, "a.json", signals())
    drop(inbox, "b.json", [*signals()[:2], "{}", "null", '{"event_type": "FRAUD_SIGNAL"}', '{"event_id": "n"}'])
    progress = progress_of(spark, start_signals, inbox, cfg)
    assert account(progress) == [("signals", 12, 6, 4, 2, 0, 0)]
    assert sorted((r.rows_in, r.rows_read, r.rows_kept) for r in progress.filter("rows_in > 0").collect()) == [(6, 6, 2), (6, 6, 4)]
    left = read_event_table(spark, cfg.root, "rejected_events")
    assert left.count() == 6 and sum(read_event_table(spark, cfg.root, t).count() for t in ROUTES) == 6
    assert {r.message for r in left.filter("outcome = 'rejected'").collect()} == {"not json", "{}", "null", '{"event_type": "FRAUD_SIGNAL"}'}


def test_payments_keep_what_they_reject(spark, lake):
    inbox, cfg = lake
    drop(inbox, "a.json", [payment("1", "10:00:00"), "broken {", payment("2", "10:00:00", event_type=None), '{"amount": 3}'])
    assert account(progress_of(spark, start_payments, inbox, cfg)) == [("payment_transactions", 4, 2, 2, 0, 0, 0)]
    left = read_event_table(spark, cfg.root, "rejected_events").collect()
    assert {(r.stream, r.outcome, r.message) for r in left} == {("payment_transactions", "rejected", m) for m in ("broken {", '{"amount": 3}')}
    assert all(r.ingested_at is not None and r.event_date == r.ingested_at.date() for r in left)


def test_late_rows_are_counted(spark, lake):
    inbox, cfg = lake
    drop(inbox, "a.json", [payment("1", "00:01:00"), payment("2", "00:06:00")])
    drop(inbox, "b.json", [payment("3", "00:30:00"), "broken"])
    drop(inbox, "c.json", [payment("4", "00:31:00")])  # closes the windows that b.json has moved the watermark past
    drop(inbox, "d.json", [payment("5", "00:02:00"), payment("6", "00:07:00"), payment("7", "00:31:00")])
    for i, name in enumerate("abcd"):  # files are read in the order of their times
        os.utime(inbox / f"{name}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    progress = progress_of(spark, start_aggregates, inbox, cfg)
    assert account(progress) == [("payment_agg", 8, 7, 1, 0, 2, 0)]
    assert progress.agg(F.max("state_rows")).first()[0] >= 2


def test_an_older_progress_table_is_widened(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS stream_old")
    old = list(PROGRESS)[:8]
    spark.sql("CREATE TABLE stream_old.progress USING parquet AS SELECT " + ", ".join(f"CAST(NULL AS {PROGRESS[c]}) AS {c}" for c in old))
    log = ProgressLog()
    log._note("q", "n", 0, "2024-05-02 10:00:00", 5, 1.0, 10, "RUNNING", 5, 3, 1, 1, 2, 9)
    log.flush(spark, "stream_old.progress")
    assert account(spark.table("stream_old.progress")) == [("n", 5, 3, 1, 1, 2, 0)]


def test_a_trigger_that_ran_twice_counts_once(spark):
    rows = [("q", "n", 0, f"2024-05-02 10:00:0{i}", 5, 0.0, 10, "RUNNING", 5, 3, 1, 0, None, None) for i in range(2)]
    rows += [("q", "n", None, "2024-05-02 11:00:00", 0, 0.0, None, "STOPPED"), ("p", "old", 0, "2024-05-02 10:00:00", 5, 0.0, 10, "RUNNING")]
    assert account(ProgressLog._frame(spark, rows)) == [("n", 5, 3, 1, 0, 0, 1)]
