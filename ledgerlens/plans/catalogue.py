"""All reports by name, and by question."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from inspect import signature

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.params import MAX_HOURS, in_utc, since, since_date
from ledgerlens.operators.matching import keys_in_both, match_rate_accounts, match_rate_events, union_all
from ledgerlens.operators.question_rules import ACTIVITY_RULES, CUSTOMER_RULES, Rule
from ledgerlens.operators.textrules import classify_text
from ledgerlens.plans import activity, customer, quality

CUSTOMERS, PAYMENTS, ALERTS, LOGINS, AML = (
    "customers", "payment_transactions", "fraud_alerts", "customer_events", "aml_alerts",
)

DIM_CUSTOMER, DIM_ACCOUNT, FACT, RUN_LOG = "dim_customer", "dim_account", "fact_payment_daily", "ingestion_audit"
BATCH_TABLES = (DIM_CUSTOMER, DIM_ACCOUNT, FACT, RUN_LOG)


@dataclass(frozen=True)
class Report:
    """A report and the tables it reads, in the order of its parameters."""

    run: Callable[..., DataFrame]
    tables: tuple[str, ...]

    def __call__(self, tables: Mapping[str, DataFrame], **params: object) -> DataFrame:
        """Runs the report with those of ``params`` that it takes and that are given."""
        taken = signature(self.run).parameters
        given = {name: value for name, value in params.items() if name in taken and value is not None}
        return self.run(*(tables[name] for name in self.tables), **given)


def _match_rates(payments: DataFrame, alerts: DataFrame, events: DataFrame, customers: DataFrame, *, as_of, hours=None) -> DataFrame:
    sources = {PAYMENTS: payments, ALERTS: alerts, LOGINS: events}
    recent = {name: since(df, as_of, hours) for name, df in sources.items()}
    return match_rate_events(recent, customers).orderBy("event_source")


def _account_match_rates(payments, alerts, events, customers, *, day, days=1) -> DataFrame:
    sources = {PAYMENTS: payments, ALERTS: alerts, LOGINS: events}
    recent = {name: since_date(df, day, days) for name, df in sources.items()}
    return match_rate_accounts(recent, customers).orderBy("event_source")


def _shared_accounts(payments, alerts, events, aml) -> DataFrame:
    pairs = (
        (alerts, payments, ALERTS, PAYMENTS),
        (alerts, aml, ALERTS, AML),
        (alerts, events, ALERTS, LOGINS),
        (aml, events, AML, LOGINS),
    )
    return union_all(keys_in_both(*pair) for pair in pairs)


def _freshness(payments, alerts, events, aml) -> DataFrame:
    return activity.freshness({PAYMENTS: payments, ALERTS: alerts, LOGINS: events, AML: aml})


def _duplicates(customers, accounts, fact) -> DataFrame:
    return quality.idempotency_check(
        {
            DIM_CUSTOMER: (customers, ["customer_id"]),
            DIM_ACCOUNT: (accounts, ["account_id"]),
            FACT: (fact, ["event_date", "account_id"]),
        }
    )


def _quality(customers, payments, alerts, events, *, as_of, hours=1, min_customers=quality.MIN_CUSTOMERS) -> DataFrame:
    """The joins look back a day for each hour of the match rate."""
    wide = min(hours * 24, MAX_HOURS)
    analyses = {
        "customer payments": customer.top_customers(customers, payments, as_of=as_of, hours=wide, limit=10),
        "customer alerts": customer.high_risk_fraud(customers, alerts, as_of=as_of, hours=wide, limit=10),
    }
    sources = {PAYMENTS: payments, ALERTS: alerts, LOGINS: events}
    recent = {name: since(df, as_of, hours) for name, df in sources.items()}
    return quality.quality_report(customers, analyses, recent, min_customers)


# Keyed by the names of the question rules, then by report name.
REPORTS: dict[str, Report] = {
    "fraud_count_last_hour": Report(activity.fraud_count_last_hour, (ALERTS,)),
    "avg_score_by_type": Report(activity.avg_score_by_type, (ALERTS,)),
    "top_accounts_by_score": Report(activity.top_accounts, (ALERTS,)),
    "latest_high_risk": Report(activity.latest_high_risk, (ALERTS,)),
    "fraud_trend_by_hour": Report(activity.fraud_trend_by_hour, (ALERTS,)),
    "action_outcome_counts": Report(activity.action_outcomes, (ALERTS,)),
    "fraud_by_action": Report(activity.fraud_by_action, (ALERTS,)),
    "fraud_by_type": Report(activity.fraud_by_type, (ALERTS,)),
    "recent_fraud_alerts": Report(activity.recent_alerts, (ALERTS,)),
    "aml_by_risk_band": Report(activity.aml_by_risk_band, (AML,)),
    "new_device_logins": Report(activity.new_device_logins, (LOGINS,)),
    "login_outcomes": Report(activity.login_outcomes, (LOGINS,)),
    "top_customers_by_payment": Report(customer.top_customers, (CUSTOMERS, PAYMENTS)),
    "high_risk_with_fraud": Report(customer.high_risk_fraud, (CUSTOMERS, ALERTS)),
    "platinum_with_fraud": Report(customer.platinum_fraud, (CUSTOMERS, ALERTS)),
    "pep_high_fraud": Report(customer.pep_high_fraud, (CUSTOMERS, ALERTS)),
    "channel_comparison": Report(customer.channel_comparison, (CUSTOMERS, PAYMENTS)),
    "new_device_customers": Report(customer.new_device_customers, (CUSTOMERS, LOGINS)),
    "fraud_by_customer_city": Report(customer.fraud_by_city, (CUSTOMERS, ALERTS)),
    "high_risk_exposure": Report(customer.risk_exposure, (CUSTOMERS, PAYMENTS, ALERTS)),
    "unmatched_events": Report(_match_rates, (PAYMENTS, ALERTS, LOGINS, CUSTOMERS)),
    "customer_profile_lookup": Report(customer.customer_profile, (CUSTOMERS, PAYMENTS, ALERTS, LOGINS, AML)),
    # Reports without a question.
    "approval_rate": Report(activity.approval_rate, (PAYMENTS,)),
    "top_merchant_categories": Report(activity.top_merchant_categories, (PAYMENTS,)),
    "fraud_by_type_action": Report(activity.fraud_by_type_action, (ALERTS,)),
    "fraud_type_share": Report(activity.fraud_type_share, (ALERTS,)),
    "sar_cases": Report(activity.sar_cases, (AML,)),
    "failed_logins": Report(activity.failed_logins, (LOGINS,)),
    "customer_payment_360": Report(customer.customer_payment_360, (CUSTOMERS, PAYMENTS)),
    "customer_fraud_360": Report(customer.customer_fraud_360, (CUSTOMERS, ALERTS)),
    "risk_exposure_360": Report(customer.risk_exposure_360, (CUSTOMERS, PAYMENTS, ALERTS)),
    "channel_profile": Report(customer.channel_profile, (CUSTOMERS, PAYMENTS, LOGINS)),
    "unmatched_accounts": Report(customer.unmatched_accounts, (CUSTOMERS, PAYMENTS)),
    "key_uniqueness": Report(activity.key_uniqueness, (CUSTOMERS,)),
    "account_format_check": Report(activity.account_format_check, (CUSTOMERS,)),
    "tier_risk_distribution": Report(activity.tier_risk_distribution, (CUSTOMERS,)),
    "distribution_check": Report(quality.distribution_check, (CUSTOMERS,)),
    "masking_check": Report(quality.masking_check, (CUSTOMERS,)),
    "attribute_agreement": Report(quality.attribute_agreement, (PAYMENTS, CUSTOMERS)),
    "match_rate_accounts": Report(_account_match_rates, (PAYMENTS, ALERTS, LOGINS, CUSTOMERS)),
    "join_match_rate": Report(_shared_accounts, (PAYMENTS, ALERTS, LOGINS, AML)),
    "freshness": Report(_freshness, (PAYMENTS, ALERTS, LOGINS, AML)),
    "quality_report": Report(_quality, (CUSTOMERS, PAYMENTS, ALERTS, LOGINS)),
    # Reports over batch-loaded tables.
    "last_batch": Report(quality.last_batch, (RUN_LOG,)),
    "batch_history": Report(quality.batch_history, (RUN_LOG,)),
    "idempotency_check": Report(_duplicates, (DIM_CUSTOMER, DIM_ACCOUNT, FACT)),
    "source_vs_target": Report(quality.source_vs_target, (CUSTOMERS, DIM_CUSTOMER)),
    "rollup_reconcile": Report(quality.rollup_reconcile, (PAYMENTS, FACT)),
    "lineage": Report(quality.lineage, (DIM_ACCOUNT,)),
    "tier_payment_summary": Report(customer.tier_payment_summary, (DIM_CUSTOMER, FACT)),
}


class UnsupportedQuestion(ValueError):
    """A question no report answers, or one that asks for a change of data."""


def run_report(name: str, tables: Mapping[str, DataFrame], *, as_of: datetime, **params: object) -> DataFrame:
    """A report as of a moment; reports of one day take the day of that moment."""
    if name not in REPORTS:
        raise UnsupportedQuestion(f"no report {name!r}; there are: {', '.join(REPORTS)}")
    return REPORTS[name](tables, as_of=as_of, day=in_utc(as_of).date(), **params)


def question_report(spark: SparkSession, question: str, rules: Sequence[Rule] = ACTIVITY_RULES) -> str:
    """The report a question asks for."""
    asked = spark.range(1).select(F.lit(question).alias("question_text"))
    found = classify_text(asked, "question_text", rules, refuse_sql=rules is CUSTOMER_RULES).first()
    if found.outcome == "REFUSED":
        raise UnsupportedQuestion("reports only read; this question asks for a change of data or is SQL")
    if found.question is None:
        raise UnsupportedQuestion(f"no report answers {question!r}")
    return found.question


def ask(
    question: str,
    tables: Mapping[str, DataFrame],
    rules: Sequence[Rule] = ACTIVITY_RULES,
    *,
    as_of: datetime,
    **params: object,
) -> DataFrame:
    """The answer to a question in plain words."""
    spark = next(iter(tables.values())).sparkSession
    return run_report(question_report(spark, question, rules), tables, as_of=as_of, account=question, **params)
