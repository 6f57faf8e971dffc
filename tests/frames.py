"""Small hand-made tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = datetime(2024, 5, 2, 12, 0)


def at(text: str) -> str:
    return f"2024-05-{text}"


def payments(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """``(id, account, time, amount, channel, status)``; times like ``02 11:00:00``."""
    df = spark.createDataFrame(
        [(i, a, at(t), m, c, s) for i, a, t, m, c, s in rows],
        "event_id string, account_id string, t string, amount double, channel string, status string",
    )
    return df.select(
        "event_id",
        F.col("event_id").alias("transaction_id"),
        "account_id",
        F.col("t").cast("timestamp").alias("timestamp"),
        "amount",
        "channel",
        F.lit("RETAIL").alias("merchant_category"),
        "status",
        F.lit("Bangkok").alias("city"),
        F.lit(False).alias("is_international"),
        F.lit(0.1).alias("risk_score"),
        F.to_date("t").alias("event_date"),
    )


def alerts(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """``(id, account, time, type, score, action)``."""
    df = spark.createDataFrame(
        [(i, a, at(t), f, s, x) for i, a, t, f, s, x in rows],
        "event_id string, account_id string, t string, fraud_type string, ml_score double, action string",
    )
    return df.select(
        "event_id",
        F.lit("FRAUD_SIGNAL").alias("event_type"),
        F.col("t").cast("timestamp").alias("timestamp"),
        "account_id",
        "fraud_type",
        "ml_score",
        "action",
        F.concat(F.lit("CASE-"), "event_id").alias("case_id"),
        F.to_date("t").alias("event_date"),
    )


def logins(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """``(id, account, time, channel, method, success, new device)``."""
    df = spark.createDataFrame(
        [(i, a, at(t), c, m, s, n) for i, a, t, c, m, s, n in rows],
        "event_id string, account_id string, t string, channel string, auth_method string, login_success boolean, new_device boolean",
    )
    return df.select(
        "event_id",
        F.lit("CUSTOMER_LOGIN").alias("event_type"),
        F.col("t").cast("timestamp").alias("timestamp"),
        "account_id",
        "channel",
        "auth_method",
        "login_success",
        "new_device",
        F.to_date("t").alias("event_date"),
    )


def customers(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """``(number, tier, risk, pep, preferred channel)``."""
    return spark.createDataFrame(
        [
            (f"CUST-DEMO-{n:07d}", f"ACC-TH-{10000000 + n}", f"Customer {n}", "Bangkok", "Bangkok", tier, risk, "VERIFIED", pep, "CLEAR", ch)
            for n, tier, risk, pep, ch in rows
        ],
        "customer_id string, account_id string, full_name string, city string, province string, customer_tier string,"
        " risk_rating string, kyc_status string, pep_flag boolean, sanctions_screening_status string, preferred_channel string",
    )


def rows(df: DataFrame) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


DAY = date(2024, 5, 2)
