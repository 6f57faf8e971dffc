from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import matching as m
from ledgerlens.plans import customer as c
from tests.frames import AS_OF, DAY, alerts, customers, logins, payments, rows

ACC1, ACC2, ACC3 = (f"ACC-TH-{10000000 + n}" for n in (1, 2, 3))


def base(spark):
    return customers(
        spark,
        [(1, "PLATINUM", "HIGH", False, "POS"), (2, "GOLD", "LOW", True, "ATM"), (3, "SILVER", "LOW", False, "POS")],
    )


def test_joins_do_not_fan_out(spark):
    """Five payments and eight alerts of one account stay five and eight."""
    paid = payments(spark, [(f"p{i}", ACC1, f"02 0{i}:00:00", 100.25, "POS", "APPROVED") for i in range(5)])
    raised = alerts(spark, [(f"f{i}", ACC1, f"02 0{i}:30:00", "X", 0.9, "BLOCK_AND_ALERT") for i in range(8)])
    one = c.risk_exposure(base(spark), paid, raised, as_of=AS_OF).collect()
    assert [(r.customer_id, r.payment_count, r.fraud_alert_count, r.total_payment_amount) for r in one] == [("CUST-DEMO-0000001", 5, 8, 501.25)]
    naive = base(spark).join(paid, "account_id").join(raised.select("account_id", "ml_score"), "account_id")
    assert naive.count() == 40 and naive.agg(F.sum("amount")).first()[0] == 40 * 100.25
    profile = c.customer_profile(base(spark), paid, raised, logins(spark, []), raised, account="acc th 10000001", as_of=AS_OF).first()
    assert (profile.payment_count, profile.fraud_alert_count, profile.aml_alert_count, profile.login_count) == (5, 8, 8, 0)


def test_exposure_keeps_one_sided_activity(spark):
    paid = payments(spark, [("p", ACC1, "02 10:00:00", 5.0, "POS", "APPROVED")])
    raised = alerts(spark, [("f", ACC2, "02 11:00:00", "X", 0.9, "FLAG_REVIEW"), ("g", ACC3, "02 11:00:00", "X", 0.9, "FLAG_REVIEW")])
    got = [(r.account_id, r.payment_count, r.total_payment_amount, r.fraud_alert_count, r.max_fraud_score, r.most_recent_event_at.hour) for r in c.risk_exposure(base(spark), paid, raised, as_of=AS_OF).collect()]
    # PEP with an alert first, HIGH with a payment second, the LOW customer not at all.
    assert got == [(ACC2, 0, 0.0, 1, 0.9, 11), (ACC1, 1, 5.0, 0, None, 10)]
    richer = c.risk_exposure_360(base(spark), paid, raised, day=DAY)
    assert [r.blocked_alert_count for r in richer.collect()] == [0, 0]


def test_ranking_by_payments(spark):
    paid = payments(
        spark,
        [("1", ACC1, "02 10:00:00", 1.0, "POS", "X"), ("2", ACC1, "02 11:00:00", 2.01, "POS", "X"), ("3", ACC2, "02 11:00:00", 9.0, "POS", "X"), ("4", "ACC-TH-90000000", "02 11:00:00", 99.0, "POS", "X"), ("5", ACC3, "02 11:00:00", None, "POS", "X")],
    )
    got = [(r.account_id, r.transaction_count, r.total_transaction_amount, r.average_transaction_amount) for r in c.top_customers(base(spark), paid, as_of=AS_OF).collect()]
    # 3.01 / 2 = 1.505 rounds up; a customer without amounts comes last.
    assert got == [(ACC2, 1, 9.0, 9.0), (ACC1, 2, 3.01, 1.51), (ACC3, 1, None, None)]
    assert c.top_customers(base(spark), paid, as_of=AS_OF, limit=1).count() == 1


@pytest.mark.parametrize("limit", [1, 3, 10])
def test_early_cut_of_a_hot_account_is_exact(spark, limit):
    rng = random.Random(limit)
    data = [(f"{i:03d}", ACC1 if i % 3 else ACC2, f"02 {rng.randint(0, 11):02d}:00:00", "X", rng.randint(0, 4) / 4, "F") for i in range(120)]
    data += [(f"u{i}", "ACC-TH-90000000", "02 11:00:00", "X", 1.0, "F") for i in range(40)]
    raised = alerts(spark, data).repartition(6)
    got = [r.case_id for r in c.customer_fraud_360(base(spark), raised, as_of=AS_OF, limit=limit).collect()]
    known = [d for d in data if d[1] in (ACC1, ACC2)]
    best = sorted(known, key=lambda d: (d[4], d[2], d[0]), reverse=True)[:limit]
    assert got == [f"CASE-{d[0]}" for d in best]


def test_filters_of_the_detail_reports(spark):
    raised = alerts(
        spark,
        [("1", ACC1, "02 10:00:00", "X", 0.9, "BLOCK_AND_ALERT"), ("2", ACC2, "02 10:00:00", "X", 0.85, "F"), ("3", ACC2, "02 10:00:00", "X", 0.84, "F"), ("4", ACC3, "02 10:00:00", "X", 0.99, "F")],
    )
    assert [r.case_id for r in c.high_risk_fraud(base(spark), raised, as_of=AS_OF).collect()] == ["CASE-1"]
    assert [r.case_id for r in c.pep_high_fraud(base(spark), raised, as_of=AS_OF).collect()] == ["CASE-2"]
    got = c.platinum_fraud(base(spark).withColumn("annual_income", F.lit(1)), raised, as_of=AS_OF).collect()
    assert [(r.account_id, r.annual_income, r.fraud_alert_count, r.blocked_count) for r in got] == [(ACC1, 1, 1, 1)]
    city = c.fraud_by_city(base(spark), raised, as_of=AS_OF).first()
    assert (city.customers_affected, city.fraud_alert_count, city.avg_ml_score, city.max_ml_score, city.blocked_count) == (3, 4, 0.895, 0.99, 1)


def test_most_used_channel_ties_go_to_the_alphabet(spark):
    paid = payments(
        spark,
        [("1", ACC1, "02 10:00:00", 1.0, "POS", "X"), ("2", ACC1, "02 10:00:00", 1.0, "ATM", "X"), ("3", ACC1, "02 10:00:00", 1.0, None, "X"), ("4", ACC2, "02 10:00:00", 1.0, "POS", "X"), ("5", ACC2, "02 10:00:00", 2.0, "POS", "X"), ("6", ACC2, "02 10:00:00", 4.0, "ATM", "X")],
    )
    got = {tuple(r) for r in c.channel_comparison(base(spark), paid, as_of=AS_OF).collect()}
    assert got == {("POS", "ATM", "POS -> ATM", 1, 3, 3.0), ("ATM", "POS", "ATM -> POS", 1, 3, 7.0)}


def test_channel_profile_labels(spark):
    paid = payments(spark, [("1", ACC1, "02 10:00:00", 1.0, "POS", "X"), ("2", ACC2, "02 10:00:00", 1.0, "POS", "X")])
    seen = logins(
        spark,
        [("1", ACC3, "02 10:00:00", "WEB", "OTP", True, False), ("2", ACC3, "02 10:00:00", "WEB", "BIOMETRIC", False, True), ("3", ACC3, "02 10:00:00", "APP", None, None, None), ("4", ACC3, "02 10:00:00", "WEB", "OTP", True, False)],
    )
    got = {r.account_id: r for r in c.channel_profile(base(spark), paid, seen, day=DAY).collect()}
    assert {k: v.channel_alignment for k, v in got.items()} == {ACC1: "MATCHES_PREFERENCE", ACC2: "DIFFERS_FROM_PREFERENCE", ACC3: "NO_PAYMENT_ACTIVITY"}
    r = got[ACC3]
    assert (r.actual_top_login_channel, r.login_attempts, r.successful_logins, r.failed_logins, r.new_device_logins, r.auth_methods_used) == ("WEB", 4, 2, 1, 1, "BIOMETRIC, OTP")
    device = c.new_device_customers(base(spark), seen, as_of=AS_OF).collect()
    assert [(r.account_id, r.new_device_logins, r.total_logins, r.failed_logins, r.auth_methods) for r in device] == [(ACC3, 1, 4, 1, "BIOMETRIC, OTP")]


def test_profile_needs_an_account(spark):
    assert c.account_from_text("Profile for account acc_th 10000001 please") == ACC1
    for text in ("", "profile", "acc-th-123"):
        with pytest.raises(ValueError):
            c.account_from_text(text)


def test_match_accounting_survives_duplicate_master_keys(spark):
    paid = payments(spark, [(str(i), ACC1, "02 11:30:00", 1.5, "POS", "X") for i in range(3)] + [("x", "ACC-TH-90000001", "02 11:30:00", 7.0, "POS", "X"), ("n", None, "02 11:30:00", 1.0, "POS", "X")])
    twice = base(spark).unionByName(base(spark))
    assert rows(m.match_rate_events({"p": paid, "empty": paid.filter("false")}, twice)) == [("p", 5, 3, 2, 60.0), ("empty", 0, 0, 0, None)]
    assert rows(m.match_rate_accounts({"p": paid}, twice)) == [("p", 3, 1, 2, 33.33)]
    alone = c.unmatched_accounts(twice, paid, as_of=AS_OF).collect()
    assert [(r.unmatched_account_id, r.event_count, r.total_amount) for r in alone] == [("ACC-TH-90000001", 1, 7.0), (None, 1, 1.0)]


def test_keys_in_both(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("d",)], "account_id string")
    right = spark.createDataFrame([("a",), ("a",), ("x",), ("d",)], "account_id string")
    assert rows(m.keys_in_both(left, right, "l", "r")) == [("l", "r", 4, 2, 0.5)]
    assert rows(m.keys_in_both(left.filter("false"), right, "l", "r")) == [("l", "r", 0, 0, 0.0)]
    assert m.keys_in_both(left, right, "l", "r", sample=2).first().distinct_left_accounts <= 2


def test_sampled_keys_meet_the_whole_other_side(spark):
    left = spark.range(1000).selectExpr("CAST(id AS string) AS account_id")
    right = spark.range(1000).selectExpr("CAST(999 - id AS string) AS account_id")
    assert rows(m.keys_in_both(left, right, "l", "r", sample=100)) == [("l", "r", 100, 100, 1.0)]
    half = right.filter("CAST(account_id AS int) >= 500")
    assert 30 <= m.keys_in_both(left, half, "l", "r", sample=100).first().matched_accounts <= 70
    assert rows(m.keys_in_both(left, half, "l", "r", sample=5000)) == [("l", "r", 1000, 500, 0.5)]


def test_weighted_and_plain_risk(spark):
    fact = spark.createDataFrame(
        [(DAY, ACC1, 1, 10.0, 0.1), (DAY, ACC2, 9, 90.0, 0.9), (DAY, ACC3, 5, 1.0, None)],
        "event_date date, account_id string, txn_count bigint, total_amount double, avg_risk_score double",
    )
    dim = base(spark).withColumns({"customer_tier": F.lit("GOLD"), "risk_rating": F.lit("LOW")})
    assert rows(c.tier_payment_summary(dim, fact, day=DAY)) == [("GOLD", "LOW", 3, 15, 101.0, 0.5, 0.82)]


@pytest.mark.parametrize("seed", range(3))
def test_exposure_against_brute_force(spark, seed):
    rng = random.Random(seed)
    accounts = [ACC1, ACC2, ACC3, "ACC-TH-90000000"]
    paid = [(f"p{i}", rng.choice(accounts), f"02 {rng.randint(0, 11):02d}:00:00", rng.randint(1, 9999) / 100, "POS", "X") for i in range(80)]
    raised = [(f"f{i}", rng.choice(accounts), f"02 {rng.randint(0, 11):02d}:00:00", "X", rng.randint(0, 100) / 100, "F") for i in range(60)]
    total, top, n_paid, n_raised = defaultdict(int), defaultdict(float), defaultdict(int), defaultdict(int)
    for _, acc, _, amount, *_ in paid:
        total[acc] += round(amount * 100)
        n_paid[acc] += 1
    for _, acc, _, _, score, _ in raised:
        top[acc] = max(top[acc], score)
        n_raised[acc] += 1
    got = {r.account_id: (r.payment_count, r.total_payment_amount, r.fraud_alert_count, r.max_fraud_score) for r in c.risk_exposure(base(spark), payments(spark, paid), alerts(spark, raised), as_of=AS_OF).collect()}
    assert got == {acc: (n_paid[acc], total[acc] / 100, n_raised[acc], top[acc]) for acc in (ACC1, ACC2)}
