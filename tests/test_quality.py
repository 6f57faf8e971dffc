from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.plans import quality as q
from tests.frames import alerts, customers, payments, rows

ACC1 = "ACC-TH-10000001"


def master(spark, n=1):
    return customers(spark, [(i + 1, "GOLD", "LOW", False, "POS") for i in range(n)])


def paid(spark, known, unknown):
    accounts = [ACC1] * known + ["ACC-TH-90000000"] * unknown
    return payments(spark, [(str(i), acc, "02 10:00:00", 1.0, "POS", "X") for i, acc in enumerate(accounts)])


def test_gate(spark):
    def status(*sources):
        return q.match_rate_gate({str(i): df for i, df in enumerate(sources)}, master(spark)).first()

    assert status(paid(spark, 95, 5)).status == "PASS"
    assert status(paid(spark, 94, 6)).status == "FAIL"
    worst = status(paid(spark, 100, 0), paid(spark, 9, 1))
    assert (worst.status, worst.detail) == ("FAIL", "worst source matches 90.00 %")
    assert status(paid(spark, 10, 0), paid(spark, 0, 0)).status == "PASS"
    none = status(paid(spark, 0, 0))
    assert (none.status, none.detail) == ("FAIL", "no events")


def test_summary(spark):
    events = {"payments": paid(spark, 99, 1)}
    got = {r.check_name: (r.status, r.detail) for r in q.quality_report(master(spark, 5), {"some": master(spark), "none": master(spark, 0)}, events, min_customers=5).collect()}
    assert got == {
        "master size": ("PASS", "5 rows"), "master key is unique": ("PASS", "0 duplicates"), "some": ("PASS", "1 rows joined"),
        "none": ("FAIL", "0 rows joined"), "event match rate": ("PASS", "worst source matches 99.00 %"),
    }
    small = {r.check_name: r.status for r in q.quality_report(master(spark, 5).unionByName(master(spark)), {}, events).collect()}
    assert small == {"master size": "FAIL", "master key is unique": "FAIL", "event match rate": "PASS"}
    assert {r.status for r in q.quality_report(None, {"some": master(spark)}, events).collect()} == {"SKIP"}


def test_duplicates_of_composite_keys_count_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), (None, None)], "a string, b int")
    got = {r.table_name: (r.rows_total, r.distinct_keys, r.duplicate_keys) for r in q.idempotency_check({"pair": (df, ["a", "b"]), "single": (df, ["a"])}).collect()}
    assert got == {"pair": (4, 3, 1), "single": (4, 1, 3)}


def test_missing_rows(spark):
    assert rows(q.source_vs_target(master(spark, 5), master(spark, 3))) == [(5, 3, 2)]


def test_topics(spark):
    login = alerts(spark, [("1", ACC1, "02 10:00:00", "X", 0.5, "F")])
    got = rows(q.known_unknown_by_topic({"payments.raw": [paid(spark, 3, 1)], "customer.events": [login, login]}, master(spark)))
    assert got == [("payments.raw", 4, 3, 1, 25.0), ("customer.events", 2, 2, 0, 0.0)]


def test_attributes(spark):
    home = master(spark).withColumn("country", F.lit("TH"))
    events = paid(spark, 4, 2).withColumns(
        {
            "city": F.when(F.col("event_id") == "0", "Phuket").otherwise("Bangkok"),
            "customer_tier": F.lit("GOLD"),
            "country": F.when(F.col("event_id").isin("1", "2"), "SG").otherwise("TH"),
            "is_international": F.col("event_id") == "2",
        }
    )
    assert q.attribute_agreement(events, home).first().asDict() == {
        "payments_compared": 4, "city_differs": 1, "customer_tier_differs": 0, "domestic_country_differs": 1,
    }


def test_masks(spark):
    df = spark.createDataFrame(
        [("CUST-DEMO-1", "X-XXXX-XXXXX-XX-3", "+66-XX-XXX-1234", "a.b1@example.invalid"), ("CUST-2", "1-2345-67890-12-3", "+66-81-234-1234", "a@bank.example"), ("CUST-DEMO-3", None, "+66-XX-XXX-12345", None)],
        "customer_id string, national_id_masked string, mobile_number_masked string, email string",
    )
    got = {r.column_name: (r.rows_unmasked, r.status) for r in q.masking_check(df).collect()}
    assert got == {"national_id_masked": (2, "FAIL"), "mobile_number_masked": (2, "FAIL"), "email": (2, "FAIL"), "customer_id": (1, "FAIL")}
    assert {r.status for r in q.masking_check(df.limit(1)).collect()} == {"PASS"}


def test_distribution(spark):
    df = spark.createDataFrame([("STANDARD",)] * 7 + [("GOLD",)] * 13, "customer_tier string")
    got = {r.category: (r.rows, r.share, r.status) for r in q.distribution_check(df).collect()}
    assert got == {"STANDARD": (7, 0.35, "PASS"), "PLATINUM": (0, 0.0, "FAIL")}
