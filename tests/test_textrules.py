from __future__ import annotations

from ledgerlens.operators.question_rules import ACTIVITY_RULES, CUSTOMER_RULES
from ledgerlens.operators.textrules import classify_text

# Supported questions and the reports they ask for.
ACTIVITY_EXAMPLES = {
    "How many fraud alerts occurred in the last hour?": "fraud_count_last_hour",
    "Show fraud alerts by fraud type.": "fraud_by_type",
    "Show fraud alerts by action.": "fraud_by_action",
    "Which accounts have the highest fraud scores?": "top_accounts_by_score",
    "Show the latest high-risk fraud alerts.": "latest_high_risk",
    "What is the average fraud score by fraud type?": "avg_score_by_type",
    "How many alerts were blocked, flagged for review, or required step-up authentication?": "action_outcome_counts",
    "Show fraud trends by hour.": "fraud_trend_by_hour",
    "Show the ten most recent fraud alerts.": "recent_fraud_alerts",
    "How many AML alerts exist by risk band?": "aml_by_risk_band",
    "Show successful and failed customer logins.": "login_outcomes",
    "How many customer logins used a new device?": "new_device_logins",
}

CUSTOMER_EXAMPLES = {
    "Who are the customers with the highest payment amount?": "top_customers_by_payment",
    "Show high-risk customers with recent fraud alerts.": "high_risk_with_fraud",
    "Which Platinum customers have fraud alerts?": "platinum_with_fraud",
    "Show PEP customers with high fraud scores.": "pep_high_fraud",
    "Compare customer preferred channels with actual payment channels.": "channel_comparison",
    "Show customers using a new device.": "new_device_customers",
    "Which cities have the most fraud alerts?": "fraud_by_customer_city",
    "Show payment and fraud exposure for high-risk customers.": "high_risk_exposure",
    "How many banking events do not match a customer record?": "unmatched_events",
    "Show the Customer 360 profile for account ACC-TH-10000001.": "customer_profile_lookup",
}


def classified(spark, texts, rules, refuse_sql=False):
    df = spark.createDataFrame([(t,) for t in texts], "q string")
    return {r.q: (r.outcome, r.question, r.score) for r in classify_text(df, "q", rules, refuse_sql).collect()}


def test_examples(spark):
    for examples, rules in ((ACTIVITY_EXAMPLES, ACTIVITY_RULES), (CUSTOMER_EXAMPLES, CUSTOMER_RULES)):
        got = classified(spark, examples, rules, rules is CUSTOMER_RULES)
        assert {q: name for q, (_, name, _) in got.items()} == examples


def test_scores(spark):
    got = classified(spark, ["Show fraud alerts by action."], ACTIVITY_RULES)
    # One group, and "fraud" and "by action"; "alert" is no word of "alerts".
    assert got["Show fraud alerts by action."] == ("MATCHED", "fraud_by_action", 16)
    account = "profile of ACC-TH-10000001"
    assert classified(spark, [account], CUSTOMER_RULES)[account] == ("MATCHED", "customer_profile_lookup", 25)


def test_refusals(spark):
    refused = [
        "drop table customers", "DELETE FROM customers", "truncate crm.customers", "insert into customers values (1)",
        "grant all on customers to public", "update customers set pep_flag = 0", "please update", "who dropped the alerts by type",
    ]
    for rules in (ACTIVITY_RULES, CUSTOMER_RULES):
        assert {o for o, *_ in classified(spark, refused, rules).values()} == {"REFUSED"}
    assert classified(spark, ["show the latest updates"], ACTIVITY_RULES)["show the latest updates"][0] == "MATCHED"


def test_sql_is_refused_where_asked(spark):
    texts = ["SELECT * FROM customers", "  with x as (select 1) select city", "show tables", "Show customers by city"]
    got = classified(spark, texts, CUSTOMER_RULES, refuse_sql=True)
    assert [got[t][0] for t in texts] == ["REFUSED", "REFUSED", "REFUSED", "MATCHED"]


def test_unsupported_and_empty(spark):
    got = classified(spark, ["", "  ?! ", None, "what is the weather", "tell me a joke"], CUSTOMER_RULES, True)
    assert [got[t][0] for t in ("", "  ?! ", None, "what is the weather", "tell me a joke")] == ["EMPTY"] * 3 + ["UNSUPPORTED"] * 2
    assert got["tell me a joke"][1:] == (None, None)


def test_long_texts_are_read_to_the_end(spark):
    text = "lorem " * 20000 + "fraud alerts by action"
    assert classified(spark, [text], ACTIVITY_RULES)[text][1] == "fraud_by_action"
