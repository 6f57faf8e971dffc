from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlens.plans import ingestion as ing
from ledgerlens.plans import quality
from ledgerlens.schemas import CUSTOMER_MASTER, DIM_ACCOUNT, DIM_CUSTOMER, FACT_PAYMENT_DAILY, Target
from ledgerlens.sources.relational import typed_customers
from ledgerlens.sources.tables import append, ensure_table
from tests.frames import payments


def config(schema, run, **extra):
    return ing.BatchConfig(schema=schema, batch_ts=datetime(2024, 5, run, 8), batch_id=f"b{run}", **extra)


def master(spark, data):
    """``(number, tier, updated day)`` as a JDBC read returns them."""
    plain = {c: F.lit(None).cast("string") for c in CUSTOMER_MASTER if c not in ("created_at", "updated_at")}
    df = spark.createDataFrame([(f"C{n}", f"ACC-TH-{10000000 + n}", t, datetime(2024, 4, d)) for n, t, d in data], "id string, acc string, tier string, upd timestamp")
    return df.select(
        *(plain[c].alias(c) for c in plain if c not in ("customer_id", "account_id", "customer_tier", "pep_flag", "annual_income")),
        F.col("id").alias("customer_id"),
        F.col("acc").alias("account_id"),
        F.col("tier").alias("customer_tier"),
        F.lit(1).cast("tinyint").alias("pep_flag"),
        F.lit(12.345).alias("annual_income"),
        F.col("upd").alias("src_created_at"),
        F.col("upd").alias("src_updated_at"),
    )


def customers_source(data):
    def read(spark, cfg, watermark):
        raw = master(spark, data)
        if watermark is not None:
            raw = raw.filter(F.col("src_updated_at") > F.lit(str(watermark)).cast("timestamp"))
        typed = typed_customers(raw, "test.customers")
        return typed.withColumns({c: F.col(c).cast(k) for c, k in DIM_CUSTOMER.layout.items() if c in typed.columns})

    return ing.Source("customers", DIM_CUSTOMER, read)


def counts(log):
    return (log["status"], log["rows_read"], log["rows_inserted"], log["rows_updated"])


def test_incremental_runs_of_a_dimension(spark):
    schema = "ing_dim"
    first = ing.ingest(spark, config(schema, 1), customers_source([(1, "GOLD", 1), (2, "GOLD", 2)]))
    assert counts(first) == ("OK", 2, 2, 0) and first["watermark"] is None
    again = ing.ingest(spark, config(schema, 2), customers_source([(1, "GOLD", 1), (2, "GOLD", 2)]))
    assert counts(again) == ("OK", 0, 0, 0) and again["watermark"] == datetime(2024, 4, 2)
    assert again["message"] == "the source had no new rows"
    third = ing.ingest(spark, config(schema, 3), customers_source([(1, "PLATINUM", 5), (2, "GOLD", 2), (3, "SILVER", 4)]))
    assert counts(third) == ("OK", 2, 1, 1)
    assert first["snapshot_id"] < third["snapshot_id"] and again["snapshot_id"] is None
    dim = spark.table(f"{schema}.dim_customer")
    assert {(r.customer_id, r.customer_tier, r.batch_id) for r in dim.collect()} == {("C1", "PLATINUM", "b3"), ("C2", "GOLD", "b1"), ("C3", "SILVER", "b3")}
    row = dim.filter("customer_id = 'C1'").first()
    assert row.pep_flag is True and str(row.annual_income) == "12.35" and row.source_system == "test.customers"


def test_full_run_is_idempotent_and_ignores_older_versions(spark):
    schema = "ing_full"
    data = [(1, "GOLD", 3), (2, "GOLD", 2)]
    ing.ingest(spark, config(schema, 1), customers_source(data))
    replay = ing.ingest(spark, config(schema, 2, mode="full"), customers_source(data))
    assert counts(replay) == ("OK", 2, 0, 2)
    stale = ing.ingest(spark, config(schema, 3, mode="full"), customers_source([(1, "STANDARD", 1)]))
    assert counts(stale) == ("OK", 1, 0, 0)
    dim = spark.table(f"{schema}.dim_customer")
    assert {(r.customer_id, r.customer_tier) for r in dim.collect()} == {("C1", "GOLD"), ("C2", "GOLD")}
    check = quality.idempotency_check({"dim_customer": (dim, ["customer_id"])}).first()
    assert (check.rows_total, check.duplicate_keys) == (2, 0)


def test_since_replaces_the_watermark(spark):
    schema = "ing_since"
    data = [(1, "GOLD", 1), (2, "GOLD", 9)]
    run = ing.ingest(spark, config(schema, 1, since=datetime(2024, 4, 5)), customers_source(data))
    assert counts(run) == ("OK", 1, 1, 0) and run["watermark"] == datetime(2024, 4, 5)
    with pytest.raises(ValueError):
        config(schema, 1, since=datetime(2024, 4, 5), mode="full")
    with pytest.raises(ValueError):
        config(schema, 1, mode="sometimes")
    with pytest.raises(ValueError):
        config(schema, 1, provider="delta")


def test_dry_run_writes_nothing(spark):
    run = ing.ingest(spark, config("ing_dry", 1, dry_run=True), customers_source([(1, "GOLD", 1)]))
    assert counts(run) == ("DRY_RUN", 1, 0, 0) and run["mode"] == "DRY_RUN"
    assert not spark.catalog.tableExists("ing_dry.dim_customer")


def test_rows_without_a_key_are_reported(spark):
    def read(spark, cfg, watermark):
        return spark.createDataFrame([(None, "GOLD"), ("ACC-TH-10000001", "GOLD")], "account_id string, customer_tier string")

    assert [r.customer_tier for r in ing.rejected(spark, config("ing_rej", 1), ing.Source("a", DIM_ACCOUNT, read)).collect()] == ["GOLD"]


def test_account_files(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "a.csv").write_text("account_id,customer_tier,city,country\nACC-TH-10000001,GOLD,Bangkok,TH\nACC-TH-10000002,GOLD,Phuket\n,GOLD,Bangkok,TH\n")
    (folder / "b.csv").write_text("account_id,customer_tier,city,country\nACC-TH-10000003,SILVER,Bangkok,TH\nx,y,z,w,extra\n")
    (folder / "c.txt").write_text("account_id,customer_tier,city,country\nACC-TH-10000009,GOLD,Bangkok,TH\n")
    source = ing.accounts_source(str(folder))
    first = ing.ingest(spark, config("ing_acc", 1), source)
    assert counts(first) == ("OK", 2, 2, 0)
    assert first["message"] == "3 line(s) rejected"
    left = {(r.source, r.source_file.rsplit("/", 1)[-1], r.reason, r.line) for r in spark.table("ing_acc.rejected_lines").filter("batch_id = 'b1'").collect()}
    assert left == {
        ("accounts", "a.csv", "malformed", "ACC-TH-10000002,GOLD,Phuket"), ("accounts", "b.csv", "malformed", "x,y,z,w,extra"),
        ("accounts", "a.csv", "no account", '{"customer_tier":"GOLD","city":"Bangkok","country":"TH"}'),
    }
    dry = ing.ingest(spark, config("ing_acc", 7, dry_run=True), source)
    assert dry["message"] == "rows were only counted; 3 line(s) rejected" and spark.table("ing_acc.rejected_lines").count() == 3
    second = ing.ingest(spark, config("ing_acc", 2, since=datetime(2024, 1, 1)), source)
    # A full snapshot: the override has no effect, and the log does not claim one.
    assert counts(second) == ("OK", 2, 0, 2) and second["watermark"] is None
    lineage = quality.lineage(spark.table("ing_acc.dim_account")).collect()
    assert {(r.source_file.rsplit("/", 1)[-1], r.batch_id, r.rows_from_file) for r in lineage} == {("a.csv", "b2", 1), ("b.csv", "b2", 1)}


def test_daily_rollup_recomputes_late_events_only_where_needed(spark):
    schema = "ing_fact"
    events = ensure_table(spark, f"{schema}.payment_transactions", dict(payments(spark, []).dtypes), ["event_date"])
    append(payments(spark, [("1", "A", "01 10:00:00", 10.0, "POS", "APPROVED"), ("2", "A", "02 10:00:00", 20.5, "POS", "DECLINED"), ("3", "B", "03 10:00:00", 1.0, "POS", "APPROVED")]), events)
    source = ing.payments_source(events)
    assert counts(ing.ingest(spark, config(schema, 4), source)) == ("OK", 3, 3, 0)
    # One late event inside the look-back, one beyond it, one on a new day.
    append(payments(spark, [("4", "A", "02 23:00:00", 4.5, "ATM", "APPROVED"), ("5", "A", "01 23:00:00", 99.0, "ATM", "APPROVED"), ("6", "B", "04 01:00:00", 2.0, "POS", "APPROVED")]), events)
    second = ing.ingest(spark, config(schema, 5), source)
    assert counts(second) == ("OK", 3, 1, 2)
    fact = {(str(r.event_date), r.account_id): (r.txn_count, r.total_amount, r.approved_count, r.declined_count, r.batch_id) for r in spark.table(f"{schema}.fact_payment_daily").collect()}
    assert fact == {
        ("2024-05-01", "A"): (1, 10.0, 1, 0, "b4"),
        ("2024-05-02", "A"): (2, 25.0, 1, 1, "b5"),
        ("2024-05-03", "B"): (1, 1.0, 1, 0, "b5"),
        ("2024-05-04", "B"): (1, 2.0, 1, 0, "b5"),
    }
    report = {str(r.event_date): r.diff_txn_count for r in quality.rollup_reconcile(spark.table(events), spark.table(f"{schema}.fact_payment_daily"), day=datetime(2024, 5, 4).date()).collect()}
    assert report == {"2024-05-04": 0, "2024-05-03": 0, "2024-05-02": 0, "2024-05-01": 1}


def test_a_failing_source_is_logged_and_the_others_run(spark):
    schema = "ing_run"

    def broken(spark, cfg, watermark):
        raise RuntimeError("no route to host " + "x" * 2000)

    sources = [customers_source([(1, "GOLD", 1)]), ing.Source("accounts", DIM_ACCOUNT, broken)]
    for run in (1, 2):
        log, failed = ing.run_batch(spark, config(schema, run), sources)
        assert failed == ["accounts"]
    stored = spark.table(f"{schema}.ingestion_audit")
    assert stored.count() == 4
    last = quality.last_batch(stored).collect()
    assert [(r.batch_id, r.source, r.status) for r in last] == [("b2", "customers", "OK"), ("b2", "accounts", "FAILED")]
    assert last[1].message == "RuntimeError: no route to host " + "x" * 2000
    history = {r.source: (r.runs, r.failures, r.rows_inserted_total) for r in quality.batch_history(stored).collect()}
    assert history == {"accounts": (2, 2, None), "customers": (2, 0, 1)}
    _, failed = ing.run_batch(spark, config("ing_run_dry", 1, dry_run=True), sources[:1])
    assert failed == [] and not spark.catalog.tableExists("ing_run_dry.ingestion_audit")


def test_a_failed_merge_leaves_the_old_version(spark, monkeypatch):
    schema = "ing_keep"
    ing.ingest(spark, config(schema, 1), customers_source([(1, "GOLD", 1)]))

    def broken(target, staged, keys, ordering, counts):
        return staged.withColumn("customer_tier", F.raise_error(F.lit("disk full")).cast("string")).select(*target.columns)

    monkeypatch.setattr(ing, "upsert", broken)
    log, failed = ing.run_batch(spark, config(schema, 2), [customers_source([(1, "SILVER", 9)])])
    assert failed == ["customers"]
    assert [r.customer_tier for r in spark.table(f"{schema}.dim_customer").collect()] == ["GOLD"]


def test_log_times_are_utc(spark):
    started = datetime(2024, 5, 1, 3, 4, 5)
    row = dict.fromkeys(ing.RUN_LOG.columns)
    row.update(started_at=started, duration_sec=1.5)
    shown = ing.log_frame(spark, [row]).select(F.col("started_at").cast("string").alias("s")).first().s
    assert shown == "2024-05-01 03:04:05"


def test_targets_check_their_columns():
    assert FACT_PAYMENT_DAILY.columns[:2] == ("event_date", "account_id")
    with pytest.raises(ValueError):
        Target("t", ("missing",), {"a": "int"})


def test_a_load_joins_target_and_batch_once(spark, monkeypatch):
    schema, plans = "ing_once", []
    ing.ingest(spark, config(schema, 1), customers_source([(1, "GOLD", 1)]))
    write = ing.publish

    def seen(spark, table, rows, partition_by=()):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return write(spark, table, rows, partition_by)

    monkeypatch.setattr(ing, "publish", seen)
    monkeypatch.setattr(ing, "classify_changes", lambda *_: pytest.fail("a second join"))
    assert counts(ing.ingest(spark, config(schema, 2), customers_source([(1, "SILVER", 2), (2, "GOLD", 2)]))) == ("OK", 2, 1, 1)
    assert [plan.count("Join ") for plan in plans] == [1]
