"""Keyword rules that name the report a question asks for."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    """A question fits if every group of ``required`` has a term in it and no term of ``excludes`` occurs."""

    name: str
    required: tuple[tuple[str, ...], ...]
    boost: tuple[str, ...] = ()
    excludes: tuple[str, ...] = ()
    takes_account: bool = False


# The keywords of each question, in order of precedence.

ACTIVITY_RULES = (
    Rule(
        "fraud_count_last_hour",
        required=(("last hour", "past hour", "previous hour", "last 1 hour", "one hour", "60 minutes"),),
        boost=("how many", "count", "fraud", "alert"),
        excludes=("trend", "by hour", "hourly", "per hour", "average", "avg"),
    ),
    Rule(
        "avg_score_by_type",
        required=(("average", "avg", "mean"), ("score", "ml_score", "ml score")),
        boost=("fraud type", "fraud_type", "by type"),
        excludes=("aml", "login"),
    ),
    Rule(
        "top_accounts_by_score",
        required=(
            ("account", "accounts", "account_id", "customer"),
            ("highest", "top", "worst", "riskiest", "max", "maximum", "biggest", "largest"),
        ),
        boost=("fraud score", "ml_score", "score", "rank"),
        excludes=("aml", "login"),
    ),
    Rule(
        "latest_high_risk",
        required=(("high risk", "high-risk", "highrisk", "riskiest alerts", "severe"),),
        boost=("latest", "recent", "fraud", "alert", "show"),
        excludes=("aml", "login", "trend"),
    ),
    Rule(
        "fraud_trend_by_hour",
        required=(("trend", "trends", "over time", "by hour", "hourly", "per hour", "time series"),),
        boost=("fraud", "alert", "chart"),
        excludes=("last hour", "past hour", "aml", "login"),
    ),
    Rule(
        "action_outcome_counts",
        required=(
            ("blocked", "block", "flagged", "flag for review", "flag review", "step-up", "step up", "stepup"),
        ),
        boost=("how many", "alerts", "authentication", "review", "outcome"),
        excludes=("aml", "login", "trend"),
    ),
    Rule(
        "fraud_by_action",
        required=(("action", "actions", "disposition", "outcome"),),
        boost=("fraud", "alert", "by action", "group"),
        excludes=("blocked", "flagged", "step-up", "step up", "stepup", "aml", "login", "trend", "average"),
    ),
    Rule(
        "fraud_by_type",
        required=(("fraud type", "fraud_type", "by type", "type of fraud", "fraud types", "by category"),),
        boost=("fraud", "alert", "count", "breakdown", "group"),
        excludes=("average", "avg", "mean", "aml", "login", "trend"),
    ),
    Rule(
        "recent_fraud_alerts",
        required=(("recent", "latest", "newest", "last few", "most recent"),),
        boost=("fraud", "alert", "ten", "10", "show"),
        excludes=(
            "high risk", "high-risk", "highrisk", "last hour", "past hour", "trend",
            "by type", "by action", "average", "aml", "login",
        ),
    ),
    Rule(
        "aml_by_risk_band",
        required=(("aml", "anti-money", "money laundering", "sar"),),
        boost=("risk band", "risk_band", "band", "how many", "alerts"),
    ),
    Rule(
        "new_device_logins",
        required=(
            ("new device", "new_device", "unknown device", "unrecognised device", "unrecognized device", "device"),
        ),
        boost=("login", "logins", "customer", "how many"),
    ),
    Rule(
        "login_outcomes",
        required=(("login", "logins", "log in", "sign in", "signin", "log-in"),),
        boost=("successful", "success", "failed", "failure", "customer"),
        excludes=("device",),
    ),
)

CUSTOMER_RULES = (
    Rule(
        "top_customers_by_payment",
        required=(
            ("highest", "top", "largest", "most", "biggest"),
            ("payment", "payments", "spend", "amount", "transaction"),
        ),
        boost=("customers", "customer", "total", "value"),
        excludes=("fraud", "channel", "device", "unmatched", "city"),
    ),
    Rule(
        "high_risk_with_fraud",
        required=(("high risk", "high-risk", "risky"),),
        boost=("fraud", "alert", "alerts", "recent", "customers"),
        excludes=("pep", "platinum", "exposure", "channel", "device", "city"),
    ),
    Rule(
        "platinum_with_fraud",
        required=(("platinum",),),
        boost=("fraud", "alert", "alerts", "customers", "tier"),
    ),
    Rule(
        "pep_high_fraud",
        required=(("pep", "politically exposed", "politically-exposed"),),
        boost=("fraud", "score", "high", "customers", "sanctions"),
    ),
    Rule(
        "channel_comparison",
        required=(("channel", "channels"),),
        boost=("compare", "preferred", "actual", "payment", "profile"),
        excludes=("device",),
    ),
    Rule(
        "new_device_customers",
        required=(("new device", "new_device", "unknown device", "device"),),
        boost=("customers", "login", "logins", "using"),
    ),
    Rule(
        "fraud_by_customer_city",
        required=(("city", "cities", "province", "location", "region"),),
        boost=("fraud", "alerts", "most", "where"),
    ),
    Rule(
        "high_risk_exposure",
        required=(("exposure", "payment and fraud", "fraud and payment"),),
        boost=("high risk", "high-risk", "pep", "customers", "total"),
    ),
    Rule(
        "unmatched_events",
        required=(
            (
                "unmatched", "do not match", "dont match", "not match",
                "missing", "orphan", "no customer record", "data quality",
            ),
        ),
        boost=("events", "how many", "customer record", "banking"),
    ),
    Rule(
        "customer_profile_lookup",
        required=(("profile", "customer 360", "customer360", "account", "look up", "lookup"),),
        boost=("show", "for account", "acc-th"),
        excludes=("unmatched", "highest", "platinum", "pep"),
        takes_account=True,
    ),
)

REFUSED_TERMS = (
    "drop", "delete", "truncate", "insert", "update ", "alter", "grant", "revoke", "create ", "merge into",
)

SQL_STATEMENT = (
    r"(?i)^\s*(?:select|with|explain|describe|desc|values|insert|update|delete|merge)\b"
    r"|^\s*show\s+(?:catalogs|schemas|tables|columns|create|stats)\b"
)

GROUP_SCORE, BOOST_SCORE, ACCOUNT_SCORE = 10, 3, 12
