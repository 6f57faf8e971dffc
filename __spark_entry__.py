
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import date, datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerlens.functions.expressions import canonical_account, rounded, shard_of  # noqa: E402
from ledgerlens.operators import history, matching, upsert  # noqa: E402
from ledgerlens.operators.question_rules import ACTIVITY_RULES, CUSTOMER_RULES  # noqa: E402
from ledgerlens.operators.textrules import classify_text  # noqa: E402
from ledgerlens.plans import activity, customer, quality  # noqa: E402
from ledgerlens.schemas import EVENT_TABLES, PAYMENT_EVENT, SIGNAL_EVENT  # noqa: E402
from ledgerlens.sources import events as event_source  # noqa: E402
from ledgerlens.sources.driver_tables import DriverTables  # noqa: E402
from ledgerlens.sources.relational import typed_customers  # noqa: E402
from ledgerlens.sources.tables import check_schema, partition_stats  # noqa: E402
from ledgerlens.streaming.progress import intake_report, progress_report  # noqa: E402
from ledgerlens.streaming.routing import PAYMENT_ROUTES, ROUTES, intake_counts, judged, rejected_rows, route  # noqa: E402

# The events end on 2024-01-30, so this look-back covers all of them.
AS_OF = datetime(2024, 1, 31)
HOURS = 744
DAY = date(2024, 1, 30)
ALL_DAYS = 30
LIMIT = 1000
CUT = datetime(1999, 1, 1)
KEY, ORDER, TIE = ["entity_key"], "changed_at", ["version_id"]

Query = Callable[[SparkSession, str], DataFrame]


def _as_plain_time(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: rounded(F.col(c), n) for c, n in digits.items()})


def _daily(df: DataFrame) -> DataFrame:
    return _rounded(df, total_amount=2, avg_amount=6, avg_risk_score=6)


def _wire_fields(names: list[str]) -> list[Column]:
    """Identifiers and times travel as text."""
    return [F.col(c).cast("string").alias(c) if c in ("event_id", "timestamp") else F.col(c) for c in names]


def _payment_messages(t: DriverTables) -> DataFrame:
    """All events as messages: payments as JSON, anything else as a payload without the key."""
    fields = [c for c in PAYMENT_EVENT if c in t.payments.columns]
    body = F.to_json(F.struct(*_wire_fields(fields)))
    other = t.events.filter(~F.expr("event_type IN ('purchase', 'click')")).select(F.col("props").alias("value"))
    return t.payments.select(body.alias("value")).unionByName(other)


def _parse_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = DriverTables(spark, sf_dir)
    parsed = event_source.parse_payload(_payment_messages(t), PAYMENT_EVENT)
    kept = event_source.with_arrival(event_source.drop_malformed(parsed))
    shown = kept.select("event_id", "timestamp", "account_id", "amount", "channel", "status", "is_international", "event_date")
    return _as_plain_time(shown, "timestamp")


def _rejected_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = DriverTables(spark, sf_dir)
    rejected = event_source.rejected_messages(_payment_messages(t), PAYMENT_EVENT)
    return rejected.groupBy("message").agg(F.count("*").alias("n"))


def _routed(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = DriverTables(spark, sf_dir)
        messages = None
        for part in (t.fraud_alerts, t.aml_alerts, t.customer_events):
            fields = [c for c in part.columns if c in SIGNAL_EVENT]
            body = part.select(F.to_json(F.struct(*_wire_fields(fields))).alias("value"))
            messages = body if messages is None else messages.unionByName(body)
        parsed = event_source.with_event_date(event_source.parse_payload(messages, SIGNAL_EVENT))
        found = _as_plain_time(route(parsed, table), "timestamp")
        return found.withColumn("rule_triggers", F.array_join("rule_triggers", ",")) if "rule_triggers" in found.columns else found

    return query


def _signal_messages(t: DriverTables) -> DataFrame:
    """All routed signals as messages, purchases as events without a route, clicks as payloads without a key."""
    messages = t.events.filter("event_type = 'click'").select(F.col("props").alias("value"))
    other = t.events.filter("event_type = 'purchase'").select(F.to_json(F.struct(F.col("event_id").cast("string").alias("event_id"), "event_type")).alias("value"))
    messages = messages.unionByName(other)
    for part in (t.fraud_alerts, t.aml_alerts, t.customer_events):
        fields = [c for c in part.columns if c in SIGNAL_EVENT]
        messages = messages.unionByName(part.select(F.to_json(F.struct(*_wire_fields(fields))).alias("value")))
    return messages


def _judged(messages: DataFrame, layout: dict[str, str], routes: dict) -> DataFrame:
    return judged(event_source.with_arrival(event_source.parse_messages(messages, layout)), routes)


def _intake_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = DriverTables(spark, sf_dir)
    payments = _judged(_payment_messages(t), PAYMENT_EVENT, PAYMENT_ROUTES).agg(*intake_counts())
    signals = _judged(_signal_messages(t), SIGNAL_EVENT, ROUTES).agg(*intake_counts())
    return payments.withColumn("stream", F.lit("payment_transactions")).unionByName(signals.withColumn("stream", F.lit("signals")))


def _rejected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _judged(_signal_messages(DriverTables(spark, sf_dir)), SIGNAL_EVENT, ROUTES)
    return rejected_rows(events, "signals").drop("ingested_at", "event_date")


def _intake_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as triggers of one stream per user; errors lose what they do not route, sign-ups are no triggers."""
    events = DriverTables(spark, sf_dir).events
    k = F.col("k").cast("bigint")
    triggers = events.select(
        F.concat(F.lit("q"), F.col("user_id")).alias("query_id"),
        F.concat(F.lit("stream "), F.col("user_id")).alias("query_name"),
        F.when(F.col("event_type") != "signup", F.col("event_id")).alias("batch_id"),
        F.col("ts").alias("trigger_at"),
        k.alias("rows_in"),
        k.alias("rows_read"),
        (k - k % 3 - k % 2).alias("rows_kept"),
        (k % 3).alias("rows_rejected"),
        F.when(F.col("event_type") == "error", F.lit(0)).otherwise(k % 2).cast("bigint").alias("rows_unrouted"),
        (k % 5).alias("rows_late"),
        k.alias("state_rows"),
    )
    stale = triggers.withColumns({"trigger_at": F.col("trigger_at") - F.expr("INTERVAL 1 SECOND"), "rows_read": F.lit(7).cast("bigint")})
    return intake_report(triggers.unionByName(stale))  # every trigger ran twice


def _progress_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as triggers of one stream per user; sign-ups end their stream."""
    triggers = DriverTables(spark, sf_dir).events.select(
        F.concat(F.lit("q"), F.col("user_id")).alias("query_id"),
        F.concat(F.lit("stream "), F.col("user_id")).alias("query_name"),
        F.col("event_id").alias("batch_id"),
        F.col("ts").alias("trigger_at"),
        F.when(F.col("k") >= 40, F.col("k").cast("bigint")).otherwise(F.lit(0)).alias("rows_in"),
        F.col("value").alias("rows_per_second"),
        F.col("k").cast("bigint").alias("trigger_ms"),
        F.when((F.col("event_type") == "signup") & (F.col("k") > 97), "FAILED").otherwise("RUNNING").alias("status"),
    )
    return progress_report(triggers, 3)


def _read_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master as a relational source would return it: numeric flags, floating-point money, change times."""
    t = DriverTables(spark, sf_dir)
    changed = t.changelog.groupBy("entity_key").agg(F.max("changed_at").alias("src_updated_at"))
    source = t.raw("customer")
    raw = source.join(changed, source.c_custkey == changed.entity_key, "left").select(
        F.concat(F.lit("CUST-DEMO-"), F.lpad(F.col("c_custkey").cast("string"), 7, "0")).alias("customer_id"),
        F.col("c_name").alias("full_name"),
        (F.col("c_custkey") % 10 == 0).cast("tinyint").alias("pep_flag"),
        (F.col("c_custkey") % 3 == 0).cast("tinyint").alias("marketing_consent"),
        (F.col("c_acctbal") * 10).alias("annual_income"),
        "src_updated_at",
    )
    return typed_customers(upsert.incremental(raw, "src_updated_at", CUT), "crm.customers")


def _split(t: DriverTables) -> tuple[DataFrame, DataFrame]:
    """The change log as a target (versions before the cut) and a staged batch (the rest)."""
    log = t.changelog
    before = log.filter(F.col("changed_at") < F.lit(str(CUT)).cast("timestamp_ntz"))
    after = log.filter(F.col("changed_at") >= F.lit(str(CUT)).cast("timestamp_ntz"))
    return upsert.stage(before, KEY, ORDER, tie_break=TIE), upsert.stage(after, KEY, ORDER, tie_break=TIE)


def _extended_intervals(t: DriverTables) -> DataFrame:
    """Intervals of every other version, extended by the rest: changes that come late, in between and after."""
    odd = F.col("version_id") % 2 == 1
    known = history.intervals(t.changelog.filter(odd), KEY, tie_break=TIE)
    return history.extend_intervals(known, t.changelog.filter(~odd), KEY, tie_break=TIE)


def _upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, staged = _split(DriverTables(spark, sf_dir))
    return upsert.upsert(target, staged, KEY, ORDER)


def _upsert_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other way round: every matching row is stale and must lose."""
    older, newer = _split(DriverTables(spark, sf_dir))
    return upsert.upsert(newer, older, KEY, ORDER)


def _upsert_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A match refreshes the amount alone, whatever its age."""
    target, staged = _split(DriverTables(spark, sf_dir))
    return upsert.upsert(target, staged, KEY, update_columns=["amount"])


def _gappy(t: DriverTables) -> DataFrame:
    """The change log, without a key for pending orders."""
    return t.changelog.withColumn("entity_key", F.when(F.col("status") != "P", F.col("entity_key")))


def _upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, staged = _split(DriverTables(spark, sf_dir))
    return upsert.classify_changes(target, staged, KEY, ORDER)


def _schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = DriverTables(spark, sf_dir)
    bound = {
        "payment_transactions": t.payments,
        "fraud_alerts": t.fraud_alerts,
        "aml_alerts": t.aml_alerts,
        "customer_events": t.customer_events,
    }
    return check_schema(bound, EVENT_TABLES)


def _partition_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and files per day; bytes depend on the writer, so they are left to the tests."""
    events = DriverTables(spark, sf_dir).raw("events")
    return partition_stats(events.withColumn("event_date", F.to_date("ts")), ["event_date"]).drop("total_bytes")


def _stale_fact(t: DriverTables) -> DataFrame:
    """A roll-up that has not seen the last day yet."""
    return activity.payments_daily(t.payments.filter(F.col("event_date") < F.lit(DAY)))


def _lineage_source(t: DriverTables) -> DataFrame:
    return t.raw("orders").select(
        F.lit("file://landing/orders").alias("source_system"),
        F.concat(F.lit("B"), F.date_format("o_orderdate", "yyyyMM")).alias("batch_id"),
        F.concat(F.lit("orders-"), F.col("o_orderstatus"), F.lit(".csv")).alias("source_file"),
        F.col("o_orderdate").alias("ingested_at"),
    )


def _mentions(t: DriverTables) -> DataFrame:
    mention = F.expr(
        "concat(event_type, CASE k % 4 WHEN 0 THEN ' acc th ' WHEN 1 THEN ' ACC_TH-' WHEN 2 THEN ' Acc-Th' ELSE ' ref ' END,"
        " CAST(10000000 + user_id AS STRING), ' ', props)"
    )
    return t.events.select("event_id", mention.alias("text"))


def _classified(rules, refuse_sql: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        asked = DriverTables(spark, sf_dir).raw("conversations").select("conv_id", "turn", "text")
        return classify_text(asked, "text", rules, refuse_sql).drop("text")

    return query


def _question_templates(rules, refuse_sql: bool) -> Query:
    """Questions that do match: one per event, worded by the event's own columns."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = DriverTables(spark, sf_dir)
        text = F.expr(_QUESTION)
        asked = t.events.select("event_id", text.alias("text"))
        return classify_text(asked, "text", rules, refuse_sql).drop("text")

    return query


_QUESTION = (
    "concat(CASE k % 12 WHEN 0 THEN 'How many fraud alerts in the LAST HOUR' WHEN 1 THEN 'average ml_score by type'"
    " WHEN 2 THEN 'Which accounts have the highest fraud scores?' WHEN 3 THEN 'latest high-risk alerts, please'"
    " WHEN 4 THEN 'Show trends over time' WHEN 5 THEN 'blocked, flagged or step-up?' WHEN 6 THEN 'Customer 360 profile'"
    " WHEN 7 THEN 'highest payment of all customers' WHEN 8 THEN 'Platinum customers; fraud'"
    " WHEN 9 THEN 'compare preferred channels with actual' WHEN 10 THEN 'SELECT 1 from logins'"
    " ELSE 'which cities? new device logins' END,"
    " CASE WHEN k % 7 = 0 THEN ' for ACC-TH-' WHEN k % 7 = 1 THEN ' then drop table ' ELSE ' ' END,"
    " CAST(10000000 + user_id AS STRING))"
)


def _with_contacts(t: DriverTables) -> DataFrame:
    """Contact columns built from the customer's name; customers with a negative balance have unmasked ones."""
    plain = F.col("risk_rating") == "HIGH"
    number = F.regexp_extract("full_name", "([0-9]+)$", 1)
    return t.customers.select(
        "customer_id",
        F.concat(F.when(plain, "1234-56789-").otherwise("X-XXXX-XXXXX-XX-"), F.right(number, F.lit(1))).alias("national_id_masked"),
        F.concat(F.when(plain, "+66-81-234-").otherwise("+66-XX-XXX-"), F.right(number, F.lit(4))).alias("mobile_number_masked"),
        F.concat(F.lit("c"), number, F.when(plain, "@example.org").otherwise("@example.invalid")).alias("email"),
    )


def _join_match_rate(t: DriverTables) -> DataFrame:
    tables = {**t.event_sources, "aml_alerts": t.aml_alerts}
    pairs = (
        ("fraud_alerts", "payment_transactions"),
        ("fraud_alerts", "aml_alerts"),
        ("fraud_alerts", "customer_events"),
        ("aml_alerts", "customer_events"),
    )
    return matching.union_all(
        _rounded(matching.keys_in_both(tables[a], tables[b], a, b), match_rate=6) for a, b in pairs
    )


def entry(spark: SparkSession) -> DataFrame:
    t = DriverTables(spark, "/root/testdata/sf0.001")
    return customer.risk_exposure(t.customers, t.payments, t.fraud_alerts, as_of=AS_OF, hours=HOURS)


def _over(build: Callable[[DriverTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(DriverTables(spark, sf_dir))


def library_queries() -> dict[str, Query]:
    recent = {"as_of": AS_OF, "hours": HOURS}
    full = {**recent, "limit": LIMIT}
    by_day = {"day": DAY, "days": ALL_DAYS, "limit": LIMIT}
    every = 2**31 - 1  # the whole ranking
    return {
        # sources
        "parse_json_props": _parse_json_props,
        "rejected_messages": _rejected_messages,
        "read_customers": _read_customers,
        "schema_report": _schema_report,
        "partition_stats": _partition_stats,
        # batch upserts
        "watermark": _over(lambda t: upsert.read_watermark(t.changelog, "changed_at")),
        "stage_dedupe": _over(lambda t: upsert.stage(t.changelog, KEY, ORDER, tie_break=TIE)),
        "upsert": _upsert,
        "upsert_replay": _upsert_replay,
        "upsert_refresh": _upsert_refresh,
        "upsert_counts": _upsert_counts,
        "quarantine": _over(lambda t: upsert.quarantine(_gappy(t), KEY)),
        "stage_without_order": _over(lambda t: upsert.stage(_gappy(t), KEY, None, tie_break=["version_id"])),
        "incremental_filter": _over(lambda t: upsert.incremental(t.changelog, "changed_at", CUT)),
        "rollup_lookback": _over(
            lambda t: _daily(activity.payments_daily(upsert.lookback(t.payments_bulk, datetime(1999, 1, 1), 1), t.bulk_tasks))
        ),
        "payments_daily": _over(lambda t: _daily(activity.payments_daily(t.payments_bulk, t.bulk_tasks))),
        "shard_counts": _over(
            lambda t: t.customers.groupBy(shard_of(F.col("customer_id"), 16).alias("shard")).agg(F.count("*").alias("customers"))
        ),
        # streaming transformations on batch input
        "payment_windows": _over(lambda t: _daily(activity.payment_windows(t.payments))),
        "progress_report": _progress_report,
        "intake_account": _intake_account,
        "rejected_events": _rejected_events,
        "intake_report": _intake_report,
        "route_fraud": _routed("fraud_alerts"),
        "route_aml": _routed("aml_alerts"),
        "route_customer": _routed("customer_events"),
        # single-table analyses
        "fraud_count_last_hour": _over(lambda t: activity.fraud_count_last_hour(t.fraud_alerts, as_of=AS_OF)),
        "fraud_by_type": _over(lambda t: activity.fraud_by_type(t.fraud_alerts, **recent)),
        "fraud_by_action": _over(lambda t: activity.fraud_by_action(t.fraud_alerts, **recent)),
        "action_outcomes": _over(lambda t: activity.action_outcomes(t.fraud_alerts, **recent)),
        "fraud_type_share": _over(lambda t: activity.fraud_type_share(t.fraud_alerts, **recent)),
        "top_accounts": _over(lambda t: activity.top_accounts(t.fraud_alerts, **recent)),
        "latest_high_risk": _over(lambda t: activity.latest_high_risk(t.fraud_alerts, **recent)),
        "avg_score_by_type": _over(lambda t: _rounded(activity.avg_score_by_type(t.fraud_alerts, **recent), avg_ml_score=6)),
        "fraud_trend_by_hour": _over(lambda t: _rounded(activity.fraud_trend_by_hour(t.fraud_alerts, **recent), avg_ml_score=6)),
        "recent_alerts": _over(lambda t: activity.recent_alerts(t.fraud_alerts)),
        "aml_by_risk_band": _over(lambda t: _rounded(activity.aml_by_risk_band(t.aml_alerts, **recent), avg_amount_7d=4)),
        "login_outcomes": _over(lambda t: activity.login_outcomes(t.customer_events, **recent)),
        "new_device_logins": _over(lambda t: activity.new_device_logins(t.customer_events, **recent)),
        "approval_rate": _over(lambda t: activity.approval_rate(t.payments, as_of=AS_OF, minutes=HOURS * 60)),
        "top_merchant_categories": _over(lambda t: activity.top_merchant_categories(t.payments, day=DAY)),
        "fraud_by_type_action": _over(lambda t: activity.fraud_by_type_action(t.fraud_alerts, **recent)),
        "sar_cases": _over(lambda t: activity.sar_cases(t.aml_alerts, day=DAY)),
        "failed_logins": _over(lambda t: activity.failed_logins(t.customer_events, **recent, at_least=3)),
        "freshness": _over(lambda t: activity.freshness({**t.event_sources, "aml_alerts": t.aml_alerts})),
        "key_uniqueness": _over(lambda t: activity.key_uniqueness(t.customers)),
        "account_format_check": _over(lambda t: activity.account_format_check(t.customers)),
        "tier_risk_distribution": _over(lambda t: activity.tier_risk_distribution(t.customers)),
        "canonical_accounts": _over(
            lambda t: _mentions(t).select("event_id", canonical_account(F.col("text")).alias("mentioned_account"))
        ),
        # analyses across sources
        "top_customers": _over(lambda t: customer.top_customers(t.customers, t.payments, **full)),
        "top_customers_bulk": _over(
            lambda t: customer.top_customers(t.customers, t.payments_bulk, as_of=datetime(1999, 1, 1), hours=8760, limit=LIMIT)
        ),
        "top_customers_all": _over(lambda t: customer.top_customers(t.customers, t.payments, **recent, limit=every)),
        "customer_payment_360_all": _over(
            lambda t: customer.customer_payment_360(t.customers, t.payments, day=DAY, days=ALL_DAYS, limit=every)
        ),
        "customer_payment_360": _over(lambda t: customer.customer_payment_360(t.customers, t.payments, **by_day)),
        "join_sample": _over(lambda t: customer.join_sample(t.customers, t.payments, day=DAY)),
        "high_risk_fraud": _over(lambda t: customer.high_risk_fraud(t.customers, t.fraud_alerts, **full)),
        "customer_fraud_360": _over(lambda t: customer.customer_fraud_360(t.customers, t.fraud_alerts, **full)),
        "platinum_fraud": _over(lambda t: customer.platinum_fraud(t.customers, t.fraud_alerts, **recent)),
        "pep_high_fraud": _over(lambda t: customer.pep_high_fraud(t.customers, t.fraud_alerts, **full)),
        "channel_comparison": _over(lambda t: customer.channel_comparison(t.customers, t.payments, **recent)),
        "new_device_customers": _over(lambda t: customer.new_device_customers(t.customers, t.customer_events, **recent)),
        "fraud_by_city": _over(lambda t: customer.fraud_by_city(t.customers, t.fraud_alerts, **recent)),
        "risk_exposure": _over(lambda t: customer.risk_exposure(t.customers, t.payments, t.fraud_alerts, **full)),
        "risk_exposure_360": _over(lambda t: customer.risk_exposure_360(t.customers, t.payments, t.fraud_alerts, **by_day)),
        "channel_profile": _over(lambda t: customer.channel_profile(t.customers, t.payments, t.customer_events, day=DAY, days=ALL_DAYS)),
        "customer_profile": _over(
            lambda t: customer.customer_profile(
                t.customers, t.payments, t.fraud_alerts, t.customer_events, t.aml_alerts,
                account="profile of acc th 10000003, please", **recent,
            )
        ),
        "unmatched_accounts": _over(lambda t: customer.unmatched_accounts(t.customers, t.payments, **recent)),
        "tier_payment_summary": _over(
            lambda t: customer.tier_payment_summary(t.customers, activity.payments_daily(t.payments), day=DAY, days=ALL_DAYS)
        ),
        "match_rate_events": _over(lambda t: matching.match_rate_events(t.event_sources, t.customers)),
        "match_rate_accounts": _over(lambda t: matching.match_rate_accounts(t.event_sources, t.customers)),
        "join_match_rate": _over(_join_match_rate),
        # data quality and run reports
        "last_batch": _over(lambda t: quality.last_batch(t.run_log)),
        "idempotency_check": _over(
            lambda t: quality.idempotency_check(
                {
                    "dim_customer": (t.customers, ["customer_id"]),
                    "changelog": (t.changelog, ["entity_key"]),
                    "fact_payment_daily": (activity.payments_daily(t.payments_bulk, t.bulk_tasks), ["event_date", "account_id"]),
                }
            )
        ),
        "source_vs_target": _over(
            lambda t: quality.source_vs_target(
                t.customers, history.state_as_of(t.changelog, KEY, datetime(1995, 6, 1), tie_break=TIE)
            )
        ),
        "rollup_reconcile": _over(lambda t: quality.rollup_reconcile(t.payments, _stale_fact(t), day=DAY, days=ALL_DAYS)),
        "batch_history": _over(lambda t: quality.batch_history(t.run_log)),
        "lineage": _over(lambda t: quality.lineage(_lineage_source(t))),
        "match_rate_gate": _over(lambda t: quality.match_rate_gate(t.event_sources, t.customers)),
        "quality_report": _over(
            lambda t: quality.quality_report(
                t.customers,
                {
                    "customer payments": customer.top_customers(t.customers, t.payments, **recent),
                    "customer alerts": customer.high_risk_fraud(t.customers, t.fraud_alerts, **recent),
                },
                t.event_sources,
            )
        ),
        "known_unknown_by_topic": _over(
            lambda t: quality.known_unknown_by_topic(
                {
                    "payments.raw": [t.payments],
                    "fraud.signals": [t.fraud_alerts],
                    "customer.events": [t.customer_events, t.aml_alerts],
                },
                t.customers,
            )
        ),
        "attribute_agreement": _over(lambda t: quality.attribute_agreement(t.payments, t.customers)),
        "masking_check": _over(lambda t: quality.masking_check(_with_contacts(t))),
        "distribution_check": _over(lambda t: quality.distribution_check(t.customers)),
        "category_shares": _over(
            lambda t: quality.category_shares(t.customers, ["customer_tier", "risk_rating", "kyc_status", "city", "pep_flag"])
        ),
        # change log
        "state_as_of": _over(lambda t: history.state_as_of(t.changelog, KEY, CUT, tie_break=TIE)),
        "interval_history": _over(lambda t: history.intervals(t.changelog, KEY, tie_break=TIE)),
        "state_in_intervals": _over(lambda t: history.state_in_intervals(history.intervals(t.changelog, KEY, tie_break=TIE), CUT)),
        "extend_intervals": _over(_extended_intervals),
        "commit_history": _over(lambda t: history.commit_history(t.changelog, KEY)),
        "prune_changelog": _over(
            lambda t: history.prune_changelog(t.changelog, KEY, datetime(2001, 1, 1), 5, tie_break=TIE)
        ),
        # questions
        "classify_questions": _classified(ACTIVITY_RULES, False),
        "classify_customer_questions": _classified(CUSTOMER_RULES, True),
        "classify_event_questions": _question_templates(ACTIVITY_RULES, False),
        "classify_event_customer_questions": _question_templates(CUSTOMER_RULES, True),
    }


def _training_data() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the training-data operators, or nothing where their files are not installed."""
    try:
        import corpus_pipeline
        from ledgerlens.llm import queries as operators
    except ModuleNotFoundError as missing:
        if not (missing.name or "").startswith(("corpus_pipeline", "ledgerlens.llm")):
            raise
        return {}, {}
    sql = operators.oracle_sql() | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return operators.queries() | {"pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Query]:
    return library_queries() | _training_data()[0]


def library_oracle_sql() -> dict[str, str]:
    from oracle_queries import ORACLE

    return dict(ORACLE)


def oracle_sql() -> dict[str, str]:
    return library_oracle_sql() | _training_data()[1]
