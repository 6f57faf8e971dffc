"""One row per account, from each event table.

Two event tables are never joined row to row: each is collapsed to one row per
account first, so that five payments and eight alerts stay five and eight. It
also means that a very busy account is reduced inside the map tasks, and joins
to the customer master see one row per account and side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import exact_total

# Category names the reports single out.
BLOCKED = "BLOCK_AND_ALERT"
LOGIN = "CUSTOMER_LOGIN"


def payments_by_account(payments: DataFrame) -> DataFrame:
    return payments.groupBy("account_id").agg(
        F.count("*").alias("payment_count"),
        F.count("transaction_id").alias("transaction_count"),
        F.count("amount").alias("amount_count"),
        exact_total("amount").alias("total_amount"),
        F.count_if("is_international").alias("international_count"),
        F.max("timestamp").alias("latest_payment_at"),
    )


def alerts_by_account(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("account_id").agg(
        F.count("*").alias("fraud_alert_count"),
        F.max("ml_score").alias("max_fraud_score"),
        F.count_if(F.col("action") == BLOCKED).alias("blocked_count"),
        F.max("timestamp").alias("latest_alert_at"),
    )


def logins(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == LOGIN)


def joined_names(values: Column) -> Column:
    """A set of names as one text, in alphabetical order."""
    return F.array_join(F.array_sort(values), ", ")


def logins_by_account(events: DataFrame) -> DataFrame:
    return (
        logins(events)
        .groupBy("account_id")
        .agg(
            F.count("*").alias("total_logins"),
            F.count_if("new_device").alias("new_device_logins"),
            F.count_if(~F.col("login_success")).alias("failed_logins"),
            F.max("timestamp").alias("latest_login_at"),
            joined_names(F.collect_set("auth_method")).alias("auth_methods"),
        )
    )


def count_by_account(events: DataFrame, name: str) -> DataFrame:
    return events.groupBy("account_id").agg(F.count("*").alias(name))


def most_common(value: str, uses: str = "uses") -> Column:
    """The value with the highest count among pre-counted rows; ties go to the first in the alphabet."""
    return F.min(F.struct(-F.col(uses), F.col(value).isNull(), F.col(value).alias("value"))).getField("value")


def payment_channels(payments: DataFrame) -> DataFrame:
    """Most used channel per account, with payment totals.

    Counted per account and channel first, so the second step sees a few rows
    per account.
    """
    uses = payments.groupBy("account_id", "channel").agg(
        F.count("*").alias("uses"), exact_total("amount").alias("total_amount")
    )
    return uses.groupBy("account_id").agg(
        most_common("channel").alias("top_payment_channel"),
        F.sum("uses").alias("payment_count"),
        F.sum("total_amount").alias("total_amount"),
    )


def login_channels(events: DataFrame) -> DataFrame:
    """Most used login channel per account, with login counts and methods."""
    uses = (
        logins(events)
        .groupBy("account_id", "channel")
        .agg(
            F.count("*").alias("uses"),
            F.count_if("login_success").alias("successes"),
            F.count_if(~F.col("login_success")).alias("failures"),
            F.count_if("new_device").alias("new_devices"),
            F.collect_set("auth_method").alias("methods"),
        )
    )
    return uses.groupBy("account_id").agg(
        most_common("channel").alias("top_login_channel"),
        F.sum("uses").alias("login_attempts"),
        F.sum("successes").alias("successful_logins"),
        F.sum("failures").alias("failed_logins"),
        F.sum("new_devices").alias("new_device_logins"),
        joined_names(F.array_distinct(F.flatten(F.collect_set("methods")))).alias("auth_methods_used"),
    )
