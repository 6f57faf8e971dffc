"""Analyses over a single event table or the customer master.

Each takes and returns a DataFrame. Sorted results end with a unique column, so
that a limit always cuts at the same row.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import (
    SCORE_SCALE,
    asc,
    desc,
    exact_mean,
    exact_sum,
    exact_total,
    is_account,
    money,
    percentage,
    rounded,
    start_of,
)
from ledgerlens.functions.params import DEFAULT_LIMIT, first_rows, on_day, score_threshold, since, since_minutes
from ledgerlens.operators.aggregates import logins
from ledgerlens.operators.matching import union_all
from ledgerlens.operators.tasks import dealt

# Outcomes and columns the reports show.
OUTCOMES = ("BLOCK_AND_ALERT", "FLAG_REVIEW", "STEP_UP_AUTH")
ALERT_COLUMNS = ("timestamp", "account_id", "fraud_type", "ml_score", "action", "case_id", "event_id")


def _counted_by(df: DataFrame, key: str, measure: str, limit: object) -> DataFrame:
    counted = df.groupBy(key).agg(F.count("*").alias(measure))
    return counted.orderBy(*desc(measure), *asc(key)).transform(first_rows, limit)


def fraud_count_last_hour(alerts: DataFrame, *, as_of: datetime) -> DataFrame:
    return since(alerts, as_of, 1).agg(F.count("*").alias("alert_count"))


def fraud_by_type(alerts: DataFrame, *, as_of: datetime, hours=None, limit=None) -> DataFrame:
    return _counted_by(since(alerts, as_of, hours), "fraud_type", "alert_count", limit)


def fraud_by_action(alerts: DataFrame, *, as_of: datetime, hours=None, limit=None) -> DataFrame:
    return _counted_by(since(alerts, as_of, hours), "action", "alert_count", limit)


def action_outcomes(alerts: DataFrame, *, as_of: datetime, hours=None, limit=None) -> DataFrame:
    known = since(alerts, as_of, hours).filter(F.col("action").isin(*OUTCOMES))
    return _counted_by(known, "action", "alert_count", limit)


def with_share(counts: DataFrame, measure: str, name: str = "share_pct") -> DataFrame:
    """Each group's share of the total over all groups, in percent.

    The total is a scalar subquery, so the groups never meet in one task.
    """
    total = counts.agg(F.sum(measure)).scalar()
    return counts.withColumn(name, percentage(F.col(measure), total, 1))


def fraud_type_share(alerts: DataFrame, *, as_of: datetime, hours=None, limit=None) -> DataFrame:
    counts = since(alerts, as_of, hours).groupBy("fraud_type").agg(F.count("*").alias("alert_count"))
    shares = with_share(counts, "alert_count")
    return shares.orderBy(*desc("alert_count"), *asc("fraud_type")).transform(first_rows, limit)


def top_accounts(alerts: DataFrame, *, as_of: datetime, hours=None, limit=None) -> DataFrame:
    peaks = (
        since(alerts, as_of, hours)
        .groupBy("account_id")
        .agg(F.max("ml_score").alias("max_ml_score"), F.count("*").alias("alert_count"))
    )
    return peaks.orderBy(*desc("max_ml_score", "alert_count"), *asc("account_id")).transform(first_rows, limit, 20)


def latest_high_risk(alerts: DataFrame, *, as_of: datetime, hours=None, score=None, limit=None) -> DataFrame:
    risky = since(alerts, as_of, hours).filter(F.col("ml_score") >= score_threshold(score))
    return risky.select(*ALERT_COLUMNS).orderBy(*desc("timestamp", "event_id")).transform(first_rows, limit, DEFAULT_LIMIT)


def avg_score_by_type(alerts: DataFrame, *, as_of: datetime, hours=None, limit=None) -> DataFrame:
    scores = (
        since(alerts, as_of, hours)
        .groupBy("fraud_type")
        .agg(exact_mean("ml_score", SCORE_SCALE).alias("avg_ml_score"), F.count("*").alias("alert_count"))
    )
    return scores.orderBy(*desc("avg_ml_score"), *asc("fraud_type")).transform(first_rows, limit)


def fraud_trend_by_hour(alerts: DataFrame, *, as_of: datetime, hours=None, limit=None) -> DataFrame:
    kind = alerts.schema["timestamp"].dataType.simpleString()
    hourly = (
        since(alerts, as_of, hours)
        .groupBy(start_of("hour", "timestamp", kind).alias("alert_hour"))
        .agg(F.count("*").alias("alert_count"), exact_mean("ml_score", SCORE_SCALE).alias("avg_ml_score"))
    )
    return hourly.orderBy(*asc("alert_hour")).transform(first_rows, limit)


def recent_alerts(alerts: DataFrame, *, limit=None) -> DataFrame:
    return alerts.select(*ALERT_COLUMNS).orderBy(*desc("timestamp", "event_id")).transform(first_rows, limit, 10)


def aml_by_risk_band(aml: DataFrame, *, as_of: datetime, hours=None, limit=None) -> DataFrame:
    bands = (
        since(aml, as_of, hours)
        .groupBy("risk_band")
        .agg(F.count("*").alias("alert_count"), exact_mean("total_amount_7d").alias("avg_amount_7d"))
    )
    return bands.orderBy(*desc("alert_count"), *asc("risk_band")).transform(first_rows, limit)


def login_outcomes(events: DataFrame, *, as_of: datetime, hours=None, limit=None) -> DataFrame:
    return _counted_by(logins(since(events, as_of, hours)), "login_success", "login_count", limit)


def new_device_logins(events: DataFrame, *, as_of: datetime, hours=None, limit=None) -> DataFrame:
    return _counted_by(logins(since(events, as_of, hours)), "new_device", "login_count", limit)


def approval_rate(payments: DataFrame, *, as_of: datetime, minutes: int = 5) -> DataFrame:
    """Approval per channel; a payment without a status counts as not approved."""
    approved = F.count_if(F.col("status") == "APPROVED")
    rates = (
        since_minutes(payments, as_of, minutes)
        .groupBy("channel")
        .agg(
            F.count("*").alias("total_txns"),
            approved.alias("approved"),
            percentage(approved, F.count("*")).alias("approval_rate_pct"),
            money(exact_total("amount")).alias("total_value"),
            rounded(exact_mean("risk_score", SCORE_SCALE), 4).alias("avg_risk"),
        )
    )
    return rates.orderBy(*desc("total_txns"), *asc("channel"))


def top_merchant_categories(payments: DataFrame, *, day: date) -> DataFrame:
    spend = (
        on_day(payments, day)
        .filter(F.col("status") == "APPROVED")
        .groupBy("merchant_category")
        .agg(
            F.count("*").alias("txn_count"),
            money(exact_total("amount")).alias("total_spend"),
            rounded(exact_mean("amount"), 2).alias("avg_txn_value"),
        )
    )
    return spend.orderBy(*desc("total_spend"), *asc("merchant_category"))


def fraud_by_type_action(alerts: DataFrame, *, as_of: datetime, hours=1) -> DataFrame:
    pairs = (
        since(alerts, as_of, hours)
        .groupBy("fraud_type", "action")
        .agg(F.count("*").alias("alert_count"), rounded(exact_mean("ml_score", SCORE_SCALE), 3).alias("avg_ml_score"))
    )
    return pairs.orderBy(*desc("alert_count"), *asc("fraud_type", "action"))


def sar_cases(aml: DataFrame, *, day: date) -> DataFrame:
    """HIGH cases of one day that need a suspicious-activity report."""
    cases = on_day(aml, day).filter(F.col("sar_required") & (F.col("risk_band") == "HIGH"))
    return cases.orderBy(*desc("total_amount_7d"), *asc("event_id")).select(
        "account_id", "alert_type", "risk_band", "total_amount_7d", "timestamp"
    )


def failed_logins(events: DataFrame, *, as_of: datetime, hours=1, at_least: int = 3) -> DataFrame:
    failures = (
        logins(since(events, as_of, hours))
        .filter(~F.col("login_success"))
        .groupBy("account_id")
        .agg(
            F.count("*").alias("failed_logins"),
            F.min("timestamp").alias("first_attempt"),
            F.max("timestamp").alias("last_attempt"),
        )
    )
    repeated = failures.filter(F.col("failed_logins") >= at_least)
    return repeated.orderBy(*desc("failed_logins"), *asc("account_id"))


def freshness(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and newest event per table."""
    return union_all(
        df.agg(
            F.lit(name).alias("table_name"), F.count("*").alias("row_count"), F.max("timestamp").alias("newest_event")
        )
        for name, df in tables.items()
    )


def key_uniqueness(master: DataFrame) -> DataFrame:
    counted = master.agg(F.count("*").alias("total_rows"), F.count_distinct("account_id").alias("distinct_accounts"))
    return counted.withColumn("duplicate_accounts", F.col("total_rows") - F.col("distinct_accounts"))


def account_format_check(master: DataFrame) -> DataFrame:
    return master.agg(
        F.min("account_id").alias("first_account"),
        F.max("account_id").alias("last_account"),
        F.count_if(is_account(F.col("account_id"))).alias("well_formed_accounts"),
    )


def tier_risk_distribution(master: DataFrame) -> DataFrame:
    counts = master.groupBy("customer_tier", "risk_rating").agg(F.count("*").alias("customers"))
    return counts.orderBy(*desc("customers"), *asc("customer_tier", "risk_rating"))


def daily_rollup_measures() -> list[Column]:
    """The measures shared by the daily roll-up and the five-minute windows."""
    return [
        F.count("*").alias("txn_count"),
        exact_sum("amount").alias("total_amount"),
        exact_mean("amount").alias("avg_amount"),
        F.max("amount").alias("max_amount"),
        F.count_if(F.col("status") == "APPROVED").alias("approved_count"),
        F.count_if(F.col("status") == "DECLINED").alias("declined_count"),
        F.count_if("is_international").alias("intl_count"),
        exact_mean("risk_score", SCORE_SCALE).alias("avg_risk_score"),
    ]


def payments_daily(payments: DataFrame, tasks: int | None = None) -> DataFrame:
    """One row per day and account.

    Payments are combined before the shuffle. Where an account has a payment or two a day,
    that saves nothing and holds every payment's group in memory: with ``tasks`` the
    payments are first dealt to so many tasks.
    """
    return dealt(payments, tasks, "event_date", "account_id").groupBy("event_date", "account_id").agg(
        *daily_rollup_measures(),
        F.min("timestamp").alias("first_txn_at"),
        F.max("timestamp").alias("last_txn_at"),
    )


def payment_windows(payments: DataFrame, watermark: str | None = None) -> DataFrame:
    """Five-minute tumbling windows by city, channel and merchant category.

    Runs on batch and streaming input; a stream needs the watermark, which bounds
    its state and decides which late events still count.
    """
    timed = payments.withWatermark("timestamp", watermark) if watermark else payments
    grouped = timed.groupBy(F.window("timestamp", "5 minutes").alias("span"), "city", "channel", "merchant_category")
    measured = grouped.agg(*daily_rollup_measures())
    return measured.select(
        F.col("span.start").alias("window_start"),
        F.col("span.end").alias("window_end"),
        *(c for c in measured.columns if c != "span"),
        F.to_date("span.start").alias("event_date"),
    )
