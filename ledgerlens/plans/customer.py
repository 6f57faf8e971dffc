"""Analyses that join the customer master with event tables."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import (
    ACCOUNT_IN_TEXT,
    SCORE_SCALE,
    asc,
    desc,
    exact_total,
    money,
    rounded,
)
from ledgerlens.functions.params import DEFAULT_LIMIT, first_rows, moment_like, row_limit, score_threshold, since, since_date
from ledgerlens.operators.aggregates import (
    BLOCKED,
    alerts_by_account,
    count_by_account,
    login_channels,
    logins_by_account,
    payment_channels,
    payments_by_account,
)
from ledgerlens.operators.matching import unmatched_accounts as without_master

PROFILE_COLUMNS = ("customer_id", "account_id", "full_name")
EPOCH = datetime(1970, 1, 1)
#: Parts of an account's events that a shuffled join keeps apart.
SLICES = 16


def _or_zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).alias(column)


# Payments -----------------------------------------------------------------


def _ranked_by_payments(customers: DataFrame, payments: DataFrame, limit: object) -> DataFrame:
    """Payments are collapsed to one row per account before the join."""
    joined = customers.join(payments_by_account(payments), "account_id")
    ranked = joined.select(
        *PROFILE_COLUMNS,
        F.col("city").alias("customer_city"),
        "customer_tier",
        "risk_rating",
        "transaction_count",
        money(F.col("total_amount")).alias("total_transaction_amount"),
        rounded(F.try_divide(F.col("total_amount").cast("double"), F.col("amount_count")), 2).alias(
            "average_transaction_amount"
        ),
        F.col("latest_payment_at").alias("latest_transaction"),
    )
    return ranked.orderBy(*desc("total_transaction_amount"), *asc("customer_id")).transform(first_rows, limit, DEFAULT_LIMIT)


def top_customers(customers: DataFrame, payments: DataFrame, *, as_of: datetime, hours=None, limit=None) -> DataFrame:
    return _ranked_by_payments(customers, since(payments, as_of, hours), limit)


def customer_payment_360(customers: DataFrame, payments: DataFrame, *, day: date, days=7, limit=None) -> DataFrame:
    """As :func:`top_customers`, bounded by partition date."""
    return _ranked_by_payments(customers, since_date(payments, day, days), limit)


def join_sample(customers: DataFrame, payments: DataFrame, *, day: date, days=1, limit=5) -> DataFrame:
    """A few joined rows, the newest: the smallest proof that both sides share their key.

    Only an account's newest ``limit`` payments can be among the newest overall.
    """
    n = row_limit(limit, DEFAULT_LIMIT)
    recent = since_date(payments, day, days).select("account_id", "transaction_id", "amount", "timestamp")
    newest = _foremost_per_account(recent, desc("timestamp", "transaction_id"), n)
    joined = customers.select("account_id", "full_name", "customer_tier").join(newest, "account_id")
    return (
        joined.orderBy(*desc("timestamp", "transaction_id"))
        .limit(n)
        .select("account_id", "full_name", "customer_tier", "transaction_id", "amount", "timestamp")
    )


# Alerts -------------------------------------------------------------------


def _foremost_per_account(events: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` events of each account.

    All events of an account match the same customers, so no more than these can
    be among the first ``n`` of the joined result. The cut is exact, is made
    before the shuffle as well as after it, and keeps an account with very many
    events from weighing on the join.
    """
    window = Window.partitionBy("account_id").orderBy(*order)
    return events.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def _events_of(customers: DataFrame, events: DataFrame) -> DataFrame:
    """Events of these customers' accounts, so that only those are ranked.

    An account is joined slice by slice: where the join is shuffled, a busy account
    is spread over tasks, and each of them cuts its part before the ranking's shuffle.
    """
    slices = customers.select("account_id", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))).alias("_slice"))
    sliced = events.withColumn("_slice", F.pmod(F.xxhash64("event_id"), F.lit(SLICES)).cast("int"))
    return sliced.join(slices, ["account_id", "_slice"], "left_semi").drop("_slice")


def _alert_detail(
    customers: DataFrame, alerts: DataFrame, profile: Sequence[Column | str], limit: object, watched: bool = True
) -> DataFrame:
    """``watched``: the customers are a selection, so alerts of others are left out before the ranking."""
    n = row_limit(limit, DEFAULT_LIMIT)
    order = desc("ml_score", "alert_timestamp", "event_id")
    detail = alerts.select(
        "account_id", "event_id", F.col("timestamp").alias("alert_timestamp"), "fraud_type", "ml_score", "action", "case_id"
    )
    if watched:
        detail = _events_of(customers, detail)
    joined = customers.select(*profile).join(_foremost_per_account(detail, order, n), "account_id")
    # The tie-break on customer_id matters only for a master with repeated accounts.
    first = joined.orderBy(*order, *asc("customer_id")).limit(n)
    profile_names = customers.select(*profile).columns
    return first.select(*profile_names, "alert_timestamp", "fraud_type", "ml_score", "action", "case_id")


def high_risk_fraud(customers: DataFrame, alerts: DataFrame, *, as_of: datetime, hours=None, limit=None) -> DataFrame:
    risky = customers.filter(F.col("risk_rating") == "HIGH")
    profile = (*PROFILE_COLUMNS, "customer_tier", "city", "risk_rating", "kyc_status")
    return _alert_detail(risky, since(alerts, as_of, hours), profile, limit)


def customer_fraud_360(customers: DataFrame, alerts: DataFrame, *, as_of: datetime, hours=None, limit=None) -> DataFrame:
    """All ratings."""
    profile = (
        *PROFILE_COLUMNS,
        "customer_tier",
        "city",
        F.col("risk_rating").alias("customer_risk_rating"),
        "kyc_status",
        "pep_flag",
    )
    return _alert_detail(customers, since(alerts, as_of, hours), profile, limit, watched=False)


def pep_high_fraud(
    customers: DataFrame, alerts: DataFrame, *, as_of: datetime, hours=None, score=None, limit=None
) -> DataFrame:
    high = since(alerts, as_of, hours).filter(F.col("ml_score") >= score_threshold(score))
    profile = (*PROFILE_COLUMNS, "pep_flag", "sanctions_screening_status", "kyc_status", "customer_tier", "city")
    return _alert_detail(customers.filter("pep_flag"), high, profile, limit)


def platinum_fraud(customers: DataFrame, alerts: DataFrame, *, as_of: datetime, hours=None, limit=None) -> DataFrame:
    per_account = alerts_by_account(since(alerts, as_of, hours))
    joined = customers.filter(F.col("customer_tier") == "PLATINUM").join(per_account, "account_id")
    income = ["annual_income"] if "annual_income" in customers.columns else []
    chosen = joined.select(
        *PROFILE_COLUMNS,
        "customer_tier",
        "city",
        *income,
        "risk_rating",
        "fraud_alert_count",
        F.col("max_fraud_score").alias("max_ml_score"),
        "latest_alert_at",
        "blocked_count",
    )
    return chosen.orderBy(*desc("max_ml_score", "fraud_alert_count"), *asc("customer_id")).transform(first_rows, limit)


def fraud_by_city(customers: DataFrame, alerts: DataFrame, *, as_of: datetime, hours=None, limit=None) -> DataFrame:
    """By the customer's registered city. Alerts are collapsed per account first."""
    per_account = (
        since(alerts, as_of, hours)
        .groupBy("account_id")
        .agg(
            F.count("*").alias("n"),
            F.count("ml_score").alias("scored"),
            exact_total("ml_score", SCORE_SCALE).alias("score_total"),
            F.max("ml_score").alias("top_score"),
            F.count_if(F.col("action") == BLOCKED).alias("blocked"),
        )
    )
    joined = customers.select("account_id", "city", "province").join(per_account, "account_id")
    cities = joined.groupBy(F.col("city").alias("customer_city"), "province").agg(
        F.count_distinct("account_id").alias("customers_affected"),
        F.sum("n").alias("fraud_alert_count"),
        rounded(F.try_divide(F.sum("score_total").cast("double"), F.sum("scored")), 4).alias("avg_ml_score"),
        F.max("top_score").alias("max_ml_score"),
        F.sum("blocked").alias("blocked_count"),
    )
    return cities.orderBy(*desc("fraud_alert_count"), *asc("customer_city", "province")).transform(first_rows, limit)


# Channels and devices -----------------------------------------------------


def channel_comparison(customers: DataFrame, payments: DataFrame, *, as_of: datetime, hours=None, limit=None) -> DataFrame:
    """Stated against most used payment channel."""
    joined = customers.join(payment_channels(since(payments, as_of, hours)), "account_id")
    pairs = joined.groupBy(
        F.col("preferred_channel").alias("stated_preferred_channel"),
        F.col("top_payment_channel").alias("actual_top_payment_channel"),
    ).agg(
        F.count("*").alias("customers"),
        F.sum("payment_count").alias("payment_count"),
        money(F.sum("total_amount")).alias("total_amount"),
    )
    stated, actual = F.col("stated_preferred_channel"), F.col("actual_top_payment_channel")
    shown = pairs.select(
        stated,
        actual,
        F.concat(stated, F.lit(" -> "), actual).alias("comparison"),
        "customers",
        "payment_count",
        "total_amount",
    )
    return shown.orderBy(
        *desc("customers"), *asc("stated_preferred_channel", "actual_top_payment_channel")
    ).transform(first_rows, limit)


def channel_profile(
    customers: DataFrame, payments: DataFrame, events: DataFrame, *, day: date, days=7, limit=None
) -> DataFrame:
    """Stated channel beside observed payment and login behaviour."""
    paid = payment_channels(since_date(payments, day, days)).withColumn("_paid", F.lit(True))
    logged_in = login_channels(since_date(events, day, days)).withColumn("_logged_in", F.lit(True))
    joined = customers.join(paid, "account_id", "left").join(logged_in, "account_id", "left")
    active = joined.filter(F.col("_paid").isNotNull() | F.col("_logged_in").isNotNull())
    actual = F.col("top_payment_channel")
    alignment = (
        F.when(actual.isNull(), "NO_PAYMENT_ACTIVITY")
        .when(actual == F.col("preferred_channel"), "MATCHES_PREFERENCE")
        .otherwise("DIFFERS_FROM_PREFERENCE")
    )
    shown = active.select(
        *PROFILE_COLUMNS,
        "customer_tier",
        "city",
        F.col("preferred_channel").alias("stated_preferred_channel"),
        actual.alias("actual_top_payment_channel"),
        _or_zero("payment_count"),
        F.coalesce(money(F.col("total_amount")), F.lit(0.0)).alias("total_payment_amount"),
        F.col("top_login_channel").alias("actual_top_login_channel"),
        _or_zero("login_attempts"),
        _or_zero("successful_logins"),
        _or_zero("failed_logins"),
        _or_zero("new_device_logins"),
        "auth_methods_used",
        alignment.alias("channel_alignment"),
    )
    return shown.orderBy(*desc("payment_count", "login_attempts"), *asc("customer_id")).transform(first_rows, limit)


def new_device_customers(customers: DataFrame, events: DataFrame, *, as_of: datetime, hours=None, limit=None) -> DataFrame:
    devices = logins_by_account(since(events, as_of, hours)).filter(F.col("new_device_logins") > 0)
    shown = customers.join(devices, "account_id").select(
        *PROFILE_COLUMNS,
        "customer_tier",
        "city",
        "risk_rating",
        "preferred_channel",
        "new_device_logins",
        "total_logins",
        "failed_logins",
        "latest_login_at",
        "auth_methods",
    )
    return shown.orderBy(*desc("new_device_logins", "latest_login_at"), *asc("customer_id")).transform(first_rows, limit)


# Exposure -----------------------------------------------------------------


def _exposed(customers: DataFrame, payments: DataFrame, alerts: DataFrame) -> DataFrame:
    """HIGH or PEP customers with activity; each side is one row per account."""
    watched = customers.filter((F.col("risk_rating") == "HIGH") | F.col("pep_flag"))
    joined = watched.join(payments_by_account(payments), "account_id", "left").join(
        alerts_by_account(alerts), "account_id", "left"
    )
    active = joined.filter(F.col("payment_count").isNotNull() | F.col("fraud_alert_count").isNotNull())
    # A missing side counts as the epoch, so that one of the two always decides.
    latest = [
        F.coalesce(F.col(c), moment_like(active, c, EPOCH)) for c in ("latest_alert_at", "latest_payment_at")
    ]
    return active.withColumns(
        {
            "fraud_alert_count": _or_zero("fraud_alert_count"),
            "blocked_alert_count": F.coalesce("blocked_count", F.lit(0)),
            "payment_count": _or_zero("payment_count"),
            "total_payment_amount": F.coalesce(money(F.col("total_amount")), F.lit(0.0)),
            "international_payment_count": F.coalesce("international_count", F.lit(0)),
            "most_recent_event_at": F.greatest(*latest),
        }
    )


def _by_exposure(exposed: DataFrame, columns: Sequence[str], limit: object) -> DataFrame:
    order = (*desc("max_fraud_score", "total_payment_amount"), *asc("customer_id"))
    return exposed.select(*columns).orderBy(*order).transform(first_rows, limit, DEFAULT_LIMIT)


def risk_exposure(
    customers: DataFrame, payments: DataFrame, alerts: DataFrame, *, as_of: datetime, hours=None, limit=None
) -> DataFrame:
    exposed = _exposed(customers, since(payments, as_of, hours), since(alerts, as_of, hours))
    columns = (
        *PROFILE_COLUMNS, "customer_tier", "city", "risk_rating", "pep_flag", "kyc_status",
        "fraud_alert_count", "max_fraud_score", "payment_count", "total_payment_amount",
        "international_payment_count", "most_recent_event_at",
    )
    return _by_exposure(exposed, columns, limit)


def risk_exposure_360(
    customers: DataFrame, payments: DataFrame, alerts: DataFrame, *, day: date, days=7, limit=None
) -> DataFrame:
    """As :func:`risk_exposure`, bounded by partition date, with screening and blocked counts."""
    exposed = _exposed(customers, since_date(payments, day, days), since_date(alerts, day, days))
    columns = (
        *PROFILE_COLUMNS, "customer_tier", "city", "risk_rating", "kyc_status", "pep_flag",
        "sanctions_screening_status", "fraud_alert_count", "max_fraud_score", "blocked_alert_count",
        "payment_count", "total_payment_amount", "international_payment_count", "most_recent_event_at",
    )
    return _by_exposure(exposed, columns, limit)


# One customer -------------------------------------------------------------


def account_from_text(text: str) -> str:
    """The account a question is about, rebuilt from its eight digits."""
    found = re.search(ACCOUNT_IN_TEXT, text or "")
    if found is None:
        raise ValueError("expected an account number such as ACC-TH-10000001")
    return f"ACC-TH-{int(found.group(1)):08d}"


def customer_profile(
    customers: DataFrame,
    payments: DataFrame,
    alerts: DataFrame,
    events: DataFrame,
    aml: DataFrame,
    *,
    account: str,
    as_of: datetime,
    hours=None,
    limit=None,
) -> DataFrame:
    """Master row and activity of one account, found in any text that names it."""
    wanted = F.col("account_id") == account_from_text(account)

    def recent(df: DataFrame) -> DataFrame:
        return since(df, as_of, hours).filter(wanted)

    profile = [
        c
        for c in (
            *PROFILE_COLUMNS, "customer_tier", "city", "province", "risk_rating", "kyc_status", "pep_flag",
            "sanctions_screening_status", "preferred_channel", "account_open_date", "annual_income",
            "occupation", "age_group",
        )
        if c in customers.columns
    ]
    joined = (
        customers.filter(wanted)
        .join(payments_by_account(recent(payments)), "account_id", "left")
        .join(alerts_by_account(recent(alerts)), "account_id", "left")
        .join(logins_by_account(recent(events)), "account_id", "left")
        .join(count_by_account(recent(aml), "aml_alert_count"), "account_id", "left")
    )
    shown = joined.select(
        *profile,
        _or_zero("payment_count"),
        F.coalesce(money(F.col("total_amount")), F.lit(0.0)).alias("total_payment_amount"),
        "latest_payment_at",
        _or_zero("fraud_alert_count"),
        "max_fraud_score",
        F.coalesce("total_logins", F.lit(0)).alias("login_count"),
        _or_zero("new_device_logins"),
        _or_zero("aml_alert_count"),
    )
    return shown.orderBy(*asc("customer_id")).transform(first_rows, limit)


# Batch tables and exceptions ----------------------------------------------


def unmatched_accounts(customers: DataFrame, payments: DataFrame, *, as_of: datetime, hours=1, limit=None) -> DataFrame:
    """All accounts without a master row, the busiest first."""
    alone = without_master(since(payments, as_of, hours), customers)
    return alone.orderBy(*desc("event_count"), *asc("unmatched_account_id")).transform(first_rows, limit)


def tier_payment_summary(dim_customer: DataFrame, fact: DataFrame, *, day: date, days=7) -> DataFrame:
    """Batch-loaded dimension and daily fact by tier and risk.

    ``avg_risk_score`` is the mean of the daily means; ``weighted_risk_score``
    weighs each day by its payments.
    """
    weighted = since_date(fact, day, days).withColumn("_weighted", F.col("avg_risk_score") * F.col("txn_count"))
    per_account = weighted.groupBy("account_id").agg(
        F.sum("txn_count").alias("txns"),
        exact_total("total_amount").alias("amount"),
        exact_total("avg_risk_score", SCORE_SCALE).alias("risk"),
        F.count("avg_risk_score").alias("risk_days"),
        exact_total("_weighted", SCORE_SCALE).alias("weighted_risk"),
        F.sum(F.when(F.col("avg_risk_score").isNotNull(), F.col("txn_count"))).alias("risk_txns"),
    )
    joined = dim_customer.select("account_id", "customer_tier", "risk_rating").join(per_account, "account_id")
    summary = joined.groupBy("customer_tier", "risk_rating").agg(
        F.count_distinct("account_id").alias("accounts_with_payments"),
        F.sum("txns").alias("txn_count"),
        money(F.sum("amount")).alias("total_amount"),
        rounded(F.try_divide(F.sum("risk").cast("double"), F.sum("risk_days")), 3).alias("avg_risk_score"),
        rounded(F.try_divide(F.sum("weighted_risk").cast("double"), F.sum("risk_txns")), 3).alias("weighted_risk_score"),
    )
    return summary.orderBy(*desc("total_amount"), *asc("customer_tier", "risk_rating"))
