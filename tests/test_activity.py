from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from ledgerlens.plans import activity as a
from tests.frames import AS_OF, DAY, alerts, at, customers, logins, payments, rows


def test_last_hour_is_one_hour_wide(spark):
    df = alerts(spark, [("1", "A", "02 11:00:00", "X", 0.9, "FLAG_REVIEW"), ("2", "A", "02 10:59:59", "X", 0.9, "FLAG_REVIEW")])
    assert rows(a.fraud_count_last_hour(df, as_of=AS_OF)) == [(1,)]
    assert rows(a.fraud_count_last_hour(df.filter("false"), as_of=AS_OF)) == [(0,)]


def test_outcomes_leave_out_other_actions(spark):
    df = alerts(
        spark,
        [("1", "A", "02 11:00:00", "X", 0.9, "FLAG_REVIEW"), ("2", "A", "02 11:00:00", "X", 0.9, "IGNORE"), ("3", "A", "02 11:00:00", "X", 0.9, "FLAG_REVIEW"), ("4", "A", "02 11:00:00", "X", 0.9, "BLOCK_AND_ALERT")],
    )
    assert rows(a.action_outcomes(df, as_of=AS_OF)) == [("FLAG_REVIEW", 2), ("BLOCK_AND_ALERT", 1)]
    assert len(rows(a.fraud_by_action(df, as_of=AS_OF))) == 3
    assert rows(a.fraud_by_action(df, as_of=AS_OF, limit=1)) == [("FLAG_REVIEW", 2)]


def test_missing_scores_rank_last(spark):
    df = alerts(
        spark,
        [("1", "A", "02 11:00:00", "X", None, "F"), ("2", "B", "02 11:00:00", "X", 0.2, "F"), ("3", "C", "02 11:00:00", "X", 0.9, "F"), ("4", "C", "02 11:00:00", "Y", None, "F")],
    )
    assert rows(a.top_accounts(df, as_of=AS_OF)) == [("C", 0.9, 2), ("B", 0.2, 1), ("A", None, 1)]
    assert rows(a.avg_score_by_type(df, as_of=AS_OF)) == [("X", 0.55, 3), ("Y", None, 1)]


def test_high_risk_includes_the_threshold_and_is_newest_first(spark):
    df = alerts(
        spark,
        [("1", "A", "02 10:00:00", "X", 0.85, "F"), ("2", "A", "02 11:00:00", "X", 0.95, "F"), ("3", "A", "02 11:30:00", "X", 0.84, "F"), ("4", "A", "02 11:00:00", "X", 0.99, "F")],
    )
    assert [r.event_id for r in a.latest_high_risk(df, as_of=AS_OF).collect()] == ["4", "2", "1"]
    assert [r.event_id for r in a.latest_high_risk(df, as_of=AS_OF, score=0.99).collect()] == ["4"]
    assert [r.event_id for r in a.recent_alerts(df, limit=2).collect()] == ["3", "4"]


def test_hourly_trend(spark):
    df = alerts(spark, [("1", "A", "02 10:00:00", "X", 0.8, "F"), ("2", "A", "02 10:59:59", "X", 0.6, "F"), ("3", "A", "02 11:00:00", "X", 0.9, "F")])
    trend = a.fraud_trend_by_hour(df, as_of=AS_OF)
    shown = trend.select(F.date_format("alert_hour", "HH:mm"), "alert_count", "avg_ml_score")
    assert rows(shown) == [("10:00", 2, 0.7), ("11:00", 1, 0.9)]
    plain = df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    assert dict(a.fraud_trend_by_hour(plain, as_of=AS_OF).dtypes)["alert_hour"] == "timestamp_ntz"


def test_shares_add_up(spark):
    df = alerts(spark, [(str(i), "A", "02 11:00:00", "X" if i < 2 else "Y", 0.9, "F") for i in range(3)])
    assert rows(a.fraud_type_share(df, as_of=AS_OF)) == [("X", 2, 66.7), ("Y", 1, 33.3)]


def test_login_reports_only_count_logins(spark):
    df = logins(
        spark,
        [("1", "A", "02 11:00:00", "WEB", "OTP", True, False), ("2", "A", "02 11:00:00", "WEB", "OTP", False, False), ("3", "A", "02 11:00:00", "WEB", "OTP", False, True)],
    )
    other = df.filter("event_id = '1'").withColumn("event_type", F.lit("PROFILE_CHANGE"))
    events = df.unionByName(other)
    assert rows(a.login_outcomes(events, as_of=AS_OF)) == [(False, 2), (True, 1)]
    assert rows(a.new_device_logins(events, as_of=AS_OF)) == [(False, 2), (True, 1)]


def test_repeated_failures(spark):
    df = logins(
        spark,
        [(str(i), "A", f"02 11:0{i}:00", "WEB", "OTP", False, False) for i in range(3)]
        + [(f"b{i}", "B", f"02 11:0{i}:00", "WEB", "OTP", i == 0, False) for i in range(3)],
    )
    got = a.failed_logins(df, as_of=AS_OF).collect()
    assert [(r.account_id, r.failed_logins, r.first_attempt.minute, r.last_attempt.minute) for r in got] == [("A", 3, 0, 2)]


def test_approval_rate_and_empty_windows(spark):
    df = payments(
        spark,
        [("1", "A", "02 11:56:00", 10.0, "POS", "APPROVED"), ("2", "A", "02 11:57:00", 20.0, "POS", "DECLINED"), ("3", "A", "02 11:58:00", 0.01, "POS", None), ("4", "A", "02 11:00:00", 1.0, "POS", "APPROVED")],
    )
    assert rows(a.approval_rate(df, as_of=AS_OF)) == [("POS", 3, 1, 33.33, 30.01, 0.1)]
    assert rows(a.approval_rate(df, as_of=datetime(2025, 1, 1))) == []


def test_categories_of_one_day(spark):
    df = payments(
        spark,
        [("1", "A", "02 00:00:00", 10.0, "POS", "APPROVED"), ("2", "A", "02 23:59:59", 0.01, "POS", "APPROVED"), ("3", "A", "02 12:00:00", 5.0, "POS", "DECLINED"), ("4", "A", "03 00:00:00", 7.0, "POS", "APPROVED")],
    )
    # 10.01 / 2 = 5.005 rounds up.
    assert rows(a.top_merchant_categories(df, day=DAY)) == [("RETAIL", 2, 10.01, 5.01)]
    assert rows(a.top_merchant_categories(df, day=date(2024, 1, 1))) == []


def test_cases_that_need_a_report(spark):
    df = spark.createDataFrame(
        [("1", "A", True, "HIGH", 5.0), ("2", "B", True, "HIGH", 9.0), ("3", "C", False, "HIGH", 99.0), ("4", "D", True, "MEDIUM", 99.0), ("5", "E", None, "HIGH", 99.0)],
        "event_id string, account_id string, sar_required boolean, risk_band string, total_amount_7d double",
    ).select("*", F.lit("LAYERING").alias("alert_type"), F.lit(at("02 10:00:00")).cast("timestamp").alias("timestamp"), F.lit(DAY).alias("event_date"))
    assert [r.account_id for r in a.sar_cases(df, day=DAY).collect()] == ["B", "A"]


def test_master_checks(spark):
    master = customers(spark, [(1, "GOLD", "LOW", False, "POS"), (2, "GOLD", "LOW", False, "POS"), (2, "GOLD", "HIGH", False, "POS")])
    assert rows(a.key_uniqueness(master)) == [(3, 2, 1)]
    assert rows(a.account_format_check(master)) == [("ACC-TH-10000001", "ACC-TH-10000002", 3)]
    assert rows(a.tier_risk_distribution(master)) == [("GOLD", "LOW", 2), ("GOLD", "HIGH", 1)]


def test_freshness_of_an_empty_table(spark):
    df = alerts(spark, [("1", "A", "02 10:00:00", "X", 0.8, "F")])
    got = {r.table_name: (r.row_count, r.newest_event is None) for r in a.freshness({"full": df, "empty": df.filter("false")}).collect()}
    assert got == {"full": (1, False), "empty": (0, True)}


def test_daily_rollup(spark):
    df = payments(
        spark,
        [("1", "A", "01 23:59:59", 1.1, "POS", "APPROVED"), ("2", "A", "02 00:00:00", 2.2, "POS", "DECLINED"), ("3", "A", "02 10:00:00", 3.3, "POS", "APPROVED"), ("4", "A", "02 11:00:00", None, "POS", "PENDING")],
    )
    got = {str(r.event_date): r for r in a.payments_daily(df).collect()}
    day = got["2024-05-02"]
    assert (day.txn_count, day.total_amount, day.avg_amount, day.max_amount, day.approved_count, day.declined_count, day.intl_count) == (3, 5.5, 2.75, 3.3, 1, 1, 0)
    assert (day.first_txn_at.hour, day.last_txn_at.hour) == (0, 11)
    assert got["2024-05-01"].total_amount == 1.1


def test_window_border_belongs_to_the_later_window(spark):
    df = payments(spark, [("1", "A", "02 00:04:59", 1.0, "POS", "APPROVED"), ("2", "A", "02 00:05:00", 2.0, "POS", "APPROVED")])
    got = a.payment_windows(df).select(F.date_format("window_start", "mm"), F.date_format("window_end", "mm"), "total_amount").orderBy("window_start")
    assert rows(got) == [("00", "05", 1.0), ("05", "10", 2.0)]
