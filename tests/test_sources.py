from __future__ import annotations

import csv
from datetime import datetime, timedelta, timezone

import pytest

from ledgerlens.schemas import ACCOUNT_FILE, CUSTOMER_MASTER, EVENT_TABLES, PAYMENT_WINDOW
from ledgerlens.session import scratch_path, shared_dir
from ledgerlens.sources import files, relational
from ledgerlens.sources.tables import append, check_schema, ensure_table


def test_watermark_text_is_utc():
    plain = datetime(2024, 5, 1, 10, 0, 0, 123456)
    assert relational.timestamp_text(plain) == "2024-05-01 10:00:00.123"
    bangkok = plain.replace(tzinfo=timezone(timedelta(hours=7)))
    assert relational.timestamp_text(bangkok) == "2024-05-01 03:00:00.123"


def test_customer_statement_pushes_projection_and_predicate():
    full = relational.customer_sql("crm.customers")
    assert "WHERE" not in full and "created_at AS src_created_at, updated_at AS src_updated_at FROM crm.customers" in full
    assert all(c in full for c in CUSTOMER_MASTER)
    zoned = relational.customer_sql("crm.customers", datetime(2024, 5, 1), "CAST({column} AT TIME ZONE 'UTC' AS timestamp(6))")
    assert zoned.endswith("WHERE CAST(updated_at AT TIME ZONE 'UTC' AS timestamp(6)) > TIMESTAMP '2024-05-01 00:00:00.000'")


def test_serial_and_sharded_reads():
    serial = relational.jdbc_options({"url": "jdbc:x"}, "SELECT 1")
    assert serial == {"url": "jdbc:x", "query": "SELECT 1", "fetchsize": "5000"}
    sharded = relational.jdbc_options({"url": "jdbc:x", "fetchsize": "9"}, "SELECT 1", 4, "crc32(t.customer_id)")
    assert "query" not in sharded and sharded["fetchsize"] == "9"
    assert sharded["dbtable"] == "(SELECT t.*, MOD(crc32(t.customer_id), 4) AS _shard FROM (SELECT 1) t) shards"
    assert (sharded["partitionColumn"], sharded["lowerBound"], sharded["upperBound"], sharded["numPartitions"]) == ("_shard", "0", "4", "4")
    with pytest.raises(ValueError):
        relational.jdbc_options({}, "SELECT 1", 4)


def test_schema_contract(spark):
    frame = spark.createDataFrame([("x", 1), ("y", 2)], "a string, c int")
    fine = spark.createDataFrame([], "x string")
    got = {tuple(r) for r in check_schema({"t": frame, "fine": fine}, {"t": ("a", "b"), "fine": ("x",), "gone": ("x",)}).collect()}
    assert got == {("t", "b", "missing column", 2), ("t", "c", "unexpected column", 2), ("gone", None, "missing table", 0)}
    assert check_schema({"fine": fine}, {"fine": ("x",)}).count() == 0
    assert tuple(PAYMENT_WINDOW) == EVENT_TABLES["payment_agg"]


def test_tables_are_created_once_and_appended_by_name(spark):
    for _ in range(2):
        table = ensure_table(spark, "src.numbers", {"d": "date", "v": "int"}, ["d"])
    append(spark.sql("SELECT DATE'2024-01-01' AS d, 1 AS v"), table)
    append(spark.sql("SELECT 2 AS v, DATE'2024-01-01' AS d FROM range(1)"), table, files=1)
    assert sorted(r.v for r in spark.table(table).collect()) == [1, 2]


def write_master(path, records, columns=tuple(CUSTOMER_MASTER)):
    with open(path, "w", newline="") as handle:
        writer = csv.DictWriter(handle, columns, extrasaction="ignore")
        writer.writeheader()
        writer.writerows(records)


def record(n, tier, updated="2024-01-02 00:00:00", **extra):
    blank = dict.fromkeys(CUSTOMER_MASTER, "")
    return {
        **blank, "customer_id": f"C{n}", "account_id": f"ACC-TH-{n}", "customer_tier": tier, "pep_flag": "1", "marketing_consent": "0",
        "annual_income": "1234.5", "date_of_birth": "1990-02-03", "created_at": "2024-01-01 00:00:00", "updated_at": updated, **extra,
    }


def test_master_file_is_upserted(spark, tmp_path):
    table = ensure_table(spark, "src.customers", CUSTOMER_MASTER)
    first, second = str(tmp_path / "a.csv"), str(tmp_path / "b.csv")
    write_master(first, [record(1, "GOLD"), record(2, "GOLD", city='Bangkok, "old town"')], tuple(reversed(CUSTOMER_MASTER)))
    assert files.load_master(spark, first, table) == {"inserted": 2, "updated": 0}
    write_master(second, [record(2, "SILVER", "2024-02-01 00:00:00", created_at="2024-03-03 00:00:00"), record(3, "GOLD")])
    assert files.load_master(spark, second, table) == {"inserted": 1, "updated": 1}
    got = {r.customer_id: r for r in spark.table(table).collect()}
    assert {k: v.customer_tier for k, v in got.items()} == {"C1": "GOLD", "C2": "SILVER", "C3": "GOLD"}
    assert got["C1"].pep_flag is True and got["C1"].marketing_consent is False and got["C1"].full_name is None
    assert str(got["C1"].annual_income) == "1234.50" and str(got["C1"].date_of_birth) == "1990-02-03"
    created = spark.table(table).filter("customer_id = 'C2'").selectExpr("cast(created_at as string) c", "cast(updated_at as string) u").first()
    assert tuple(created) == ("2024-01-01 00:00:00", "2024-02-01 00:00:00")


def test_unusable_master_files(spark, tmp_path):
    path = str(tmp_path / "m.csv")
    write_master(path, [record(1, "GOLD")], tuple(c for c in CUSTOMER_MASTER if c != "account_id"))
    with pytest.raises(ValueError, match="account_id"):
        files.read_master_csv(spark, path)
    write_master(path, [])
    with pytest.raises(ValueError, match="no data rows"):
        files.read_master_csv(spark, path)


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_dir(spark) == configured.rstrip("/")
    assert scratch_path(spark, "x").startswith(shared_dir(spark) + "/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


class Unset:
    """A session without the setting, on some master."""

    def __init__(self, master):
        self.sparkContext, self.conf = self, self
        self.master, self.applicationId = master, f"app-{master}"

    def get(self, key, default):
        return default


def test_a_cluster_needs_the_shared_folder():
    assert shared_dir(Unset("local[2]")) == shared_dir(Unset("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Unset("spark://host:7077"))


def test_files_with_another_column_order_are_refused(spark, tmp_path):
    for folder, name, columns in (("accounts", "read_accounts", list(ACCOUNT_FILE)), ("master", "read_master_csv", list(CUSTOMER_MASTER))):
        home = tmp_path / folder
        home.mkdir()
        (home / "a.csv").write_text(",".join(columns) + "\n" + "1" + "," * (len(columns) - 1) + "\n")
        assert getattr(files, name)(spark, str(home)).count() == 1
        (home / "b.csv").write_text(",".join([columns[0], *reversed(columns[1:])]) + "\n" + "2" + "," * (len(columns) - 1) + "\n")
        with pytest.raises(Exception, match="header|Header"):
            getattr(files, name)(spark, str(home)).collect()
