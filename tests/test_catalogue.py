from __future__ import annotations

from datetime import datetime

import pytest

from ledgerlens import __main__ as cli
from ledgerlens.operators.question_rules import ACTIVITY_RULES, CUSTOMER_RULES
from ledgerlens.plans import catalogue
from ledgerlens.plans.activity import payments_daily
from ledgerlens.plans.ingestion import log_frame
from ledgerlens.schemas import RUN_LOG
from ledgerlens.sources.driver_tables import DriverTables
from ledgerlens.sources.events import read_topics
from ledgerlens.streaming.jobs import StreamConfig, topic_reader
from tests.frames import AS_OF, alerts, customers, logins, payments, rows
from tests.test_textrules import ACTIVITY_EXAMPLES, CUSTOMER_EXAMPLES

ACC1 = "ACC-TH-10000001"


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "customers": customers(spark, [(1, "PLATINUM", "HIGH", True, "POS")]),
        "payment_transactions": payments(spark, [("p", ACC1, "02 11:58:00", 5.0, "POS", "APPROVED")]),
        "fraud_alerts": alerts(spark, [("f", ACC1, "02 11:59:00", "X", 0.9, "BLOCK_AND_ALERT")]),
        "customer_events": logins(spark, [("l", ACC1, "02 11:59:00", "WEB", "OTP", False, True)]),
        "aml_alerts": alerts(spark, [("m", ACC1, "02 11:59:00", "X", 0.9, "F")]).selectExpr(
            "event_id", "timestamp", "account_id", "event_date", "'LAYERING' alert_type", "'HIGH' risk_band", "true sar_required", "5.0D total_amount_7d"
        ),
        "dim_customer": customers(spark, [(1, "PLATINUM", "HIGH", True, "POS")]),
        "dim_account": spark.createDataFrame(
            [(ACC1, "file", "b1", "a.csv", AS_OF)], "account_id string, source_system string, batch_id string, source_file string, ingested_at timestamp"
        ),
        "fact_payment_daily": payments_daily(payments(spark, [("p", ACC1, "02 11:58:00", 5.0, "POS", "APPROVED")])),
        "ingestion_audit": log_frame(spark, [{**dict.fromkeys(RUN_LOG.columns), "batch_id": "b1", "source": "accounts", "status": "OK"}]),
    }


def test_every_rule_has_a_report():
    assert {r.name for r in (*ACTIVITY_RULES, *CUSTOMER_RULES)} <= set(catalogue.REPORTS)


@pytest.mark.parametrize("name", sorted(catalogue.REPORTS))
def test_reports_run_by_name(tables, name):
    result = catalogue.run_report(name, tables, as_of=AS_OF, hours=24, account=ACC1, limit=5)
    # Row counts other than one.
    expected = {
        "failed_logins": 0, "unmatched_accounts": 0, "unmatched_events": 3, "match_rate_accounts": 3, "join_match_rate": 4,
        "freshness": 4, "idempotency_check": 3, "distribution_check": 6, "quality_report": 5,
    }
    assert result.count() == expected.get(name, 1)


@pytest.mark.parametrize("question,rules", [(q, ACTIVITY_RULES) for q in ACTIVITY_EXAMPLES] + [(q, CUSTOMER_RULES) for q in CUSTOMER_EXAMPLES])
def test_questions_are_answered(tables, question, rules):
    assert catalogue.ask(question, tables, rules, as_of=AS_OF).count() >= 1


def test_questions_without_an_answer(spark, tables):
    for question in ("tell me a joke", "drop table customers", ""):
        with pytest.raises(catalogue.UnsupportedQuestion):
            catalogue.ask(question, tables, as_of=AS_OF)
    with pytest.raises(catalogue.UnsupportedQuestion):
        catalogue.question_report(spark, "select city from customers", CUSTOMER_RULES)
    with pytest.raises(catalogue.UnsupportedQuestion):
        catalogue.run_report("nothing", tables, as_of=AS_OF)
    with pytest.raises(ValueError, match="limit"):
        catalogue.run_report("fraud_by_type", tables, as_of=AS_OF, limit=0)


def test_command_line_reports(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "build_session", lambda name: spark)
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / "lake" / name))
    out = str(tmp_path / "out")
    call = ["report", "risk_exposure_360", "--tables", str(tmp_path / "lake"), "--as-of", "2024-05-02T12:00", "--days", "1", "--output", out]
    assert cli.main(call) == 0
    assert spark.read.parquet(out).first().fraud_alert_count == 1
    asked = ["ask", "Show the Customer 360 profile for account ACC-TH-10000001.", "--customers", "--tables", str(tmp_path / "lake"), "--as-of", "2024-05-02T19:00+07:00", "--output", out + "2"]
    assert cli.main(asked) == 0
    assert spark.read.parquet(out + "2").first().payment_count == 1
    events = str(tmp_path / "events")
    tables["fraud_alerts"].write.partitionBy("event_date", "fraud_type").parquet(f"{events}/fraud_alerts")
    assert cli.main(["compact", "--root", events, "--table", "fraud_alerts", "--day", "2024-05-02"]) == 0
    assert cli.main(["report", "fraud_by_type", "--tables", events, "--as-of", "2024-05-02T12:00", "--output", out + "3"]) == 0
    assert rows(spark.read.parquet(out + "3")) == [("X", 1)]


def test_command_line_quality_gate(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "build_session", lambda name: spark)
    for name in ("customers", "payment_transactions", "fraud_alerts", "customer_events"):
        tables[name].write.parquet(str(tmp_path / name))
    call = ["report", "quality_report", "--tables", str(tmp_path), "--as-of", "2024-05-02T12:00", "--output", str(tmp_path / "out")]
    assert cli.main(call) == 1
    failed = spark.read.parquet(str(tmp_path / "out")).filter("status = 'FAIL'").collect()
    assert [(r.check_name, r.detail) for r in failed] == [("master size", "1 rows")]


def test_command_line_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "build_session", lambda name: spark)
    (tmp_path / "a.csv").write_text("account_id,customer_tier,city,country\nACC-TH-10000001,GOLD,Bangkok,TH\n")
    assert cli.main(["batch", "--schema", "cli_batch", "--source", "accounts", "--accounts-path", str(tmp_path)]) == 0
    assert cli.main(["batch", "--schema", "cli_batch", "--source", "accounts", "--accounts-path", str(tmp_path)]) == 0
    assert cli.main(["expire", "--table", "cli_batch.dim_account", "--keep-last", "1"]) == 0
    assert spark.table("cli_batch.dim_account").count() == 1
    assert cli.main(["batch", "--schema", "cli_batch", "--source", "payments_daily", "--payments-table", "no.such_table"]) == 1
    assert rows(spark.table("cli_batch.ingestion_audit").select("status").orderBy("status")) == [("FAILED",), ("OK",), ("OK",)]


def test_command_line_values(monkeypatch):
    monkeypatch.setenv("JDBC_USER", "reader")
    monkeypatch.setenv("JDBC_PASSWORD", "secret")
    args = cli.parser().parse_args(["batch", "--since", "2026-09-01T12:00:00+07:00", "--jdbc-url", "jdbc:x"])
    assert args.since == datetime(2026, 9, 1, 5)
    assert [s.name for s in cli.sources(args)] == ["customers", "accounts", "payments_daily"]
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["batch", "--since", "yesterday"])


class Recorder:
    """Stands in for the stream reader: no broker is at hand."""

    def __init__(self):
        self.options = {}

    readStream = property(lambda self: self)

    def format(self, name):
        self.options["format"] = name
        return self

    def option(self, key, value):
        self.options[key] = value
        return self

    def load(self):
        return self


def test_topic_options():
    read = Recorder()
    read_topics(read, "host:9092", ["a", "b"], "earliest", 700)
    assert read.options == {
        "format": "kafka", "kafka.bootstrap.servers": "host:9092", "subscribe": "a,b", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": 700, "failOnDataLoss": "false",
    }
    strict = StreamConfig("r", "c", "host:9092", fail_on_data_loss=True)
    assert topic_reader(Recorder(), strict)(("a",)).options["failOnDataLoss"] == "true"
    cfg = StreamConfig("r", "c", "host:9092", max_offsets=5000)
    assert topic_reader(Recorder(), cfg)(("a",)).options["maxOffsetsPerTrigger"] == 5000
    assert topic_reader(Recorder(), cfg)(("a", "b")).options["maxOffsetsPerTrigger"] == 2500
    assert topic_reader(Recorder(), StreamConfig("r", "c", max_offsets=600))(("a", "b")).options["maxOffsetsPerTrigger"] == 300
    assert (cfg.trigger(), cfg.trigger(2)) == ({"processingTime": "30 seconds"}, {"processingTime": "60 seconds"})


def test_bindings_leave_no_event_out(spark):
    t = DriverTables(spark, "/root/testdata/sf0.001")
    parts = (t.payments, t.fraud_alerts, t.aml_alerts, t.customer_events)
    assert sum(df.count() for df in parts) == t.raw("events").count()
    assert t.customers.count() == t.raw("customer").count()
