"""The banking tables, bound to the generic star-schema Parquet files.

The files have no banking events, so each table is a projection of one of them:
``events`` rows become payments, alerts and customer events by type, ``customer``
becomes the master, ``lineitem`` a bulk payment table, ``orders`` a change log.
No row is left out. Category columns are spread by the number in ``props``; about
two in a hundred events carry an account outside the master, as live events do.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.operators.tasks import dealt, tasks_for
from ledgerlens.schemas import Layout, ddl

# Column names and types of the files.
FILES: dict[str, Layout] = {
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "customer": {
        "c_custkey": "bigint",
        "c_name": "string",
        "c_nationkey": "int",
        "c_acctbal": "double",
        "c_mktsegment": "string",
    },
    "orders": {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    },
    "lineitem": {
        "l_orderkey": "bigint",
        "l_partkey": "bigint",
        "l_suppkey": "bigint",
        "l_linenumber": "int",
        "l_quantity": "double",
        "l_extendedprice": "double",
        "l_discount": "double",
        "l_tax": "double",
        "l_returnflag": "string",
        "l_linestatus": "string",
        "l_shipdate": "timestamp_ntz",
    },
    "events": {
        "event_id": "bigint",
        "ts": "timestamp_ntz",
        "user_id": "bigint",
        "event_type": "string",
        "value": "double",
        "props": "string",
    },
    "conversations": {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"},
}

EVENT = (
    "*",
    "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k",
)

ACCOUNT = (
    "*",
    "concat('ACC-TH-', CAST(CASE WHEN k IN (42, 99) THEN 90000000 ELSE 10000000 END + user_id AS STRING)) AS account_id",
    "CAST(ts AS DATE) AS event_date",
)

CUSTOMER = (
    "concat('CUST-DEMO-', lpad(CAST(c_custkey AS STRING), 7, '0')) AS customer_id",
    "concat('ACC-TH-', CAST(10000000 + c_custkey AS STRING)) AS account_id",
    "c_name AS full_name",
    "n_name AS city",
    "r_name AS province",
    "CASE c_mktsegment WHEN 'BUILDING' THEN 'PLATINUM' WHEN 'MACHINERY' THEN 'GOLD'"
    " WHEN 'HOUSEHOLD' THEN 'SILVER' ELSE 'STANDARD' END AS customer_tier",
    "CASE WHEN c_acctbal < 0 THEN 'HIGH' WHEN c_acctbal < 5000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_rating",
    "CASE WHEN c_custkey % 20 < 17 THEN 'VERIFIED' WHEN c_custkey % 20 < 19 THEN 'PENDING' ELSE 'EXPIRED' END AS kyc_status",
    "CASE WHEN c_custkey % 100 = 0 THEN 'MATCH_REVIEW' WHEN c_custkey % 33 = 0 THEN 'PENDING_REVIEW' ELSE 'CLEAR' END"
    " AS sanctions_screening_status",
    "(c_custkey % 10 = 0) AS pep_flag",
    "CASE c_custkey % 5 WHEN 0 THEN 'POS' WHEN 1 THEN 'MOBILE_APP' WHEN 2 THEN 'ONLINE_BANKING'"
    " WHEN 3 THEN 'ATM' ELSE 'BRANCH' END AS preferred_channel",
)

PAYMENT = (
    "event_id",
    "event_id AS transaction_id",
    "account_id",
    "ts AS timestamp",
    "value AS amount",
    "CASE k % 5 WHEN 0 THEN 'POS' WHEN 1 THEN 'MOBILE_APP' WHEN 2 THEN 'ONLINE_BANKING'"
    " WHEN 3 THEN 'ATM' ELSE 'BRANCH' END AS channel",
    "CASE k % 8 WHEN 0 THEN 'RETAIL' WHEN 1 THEN 'FOOD_BEVERAGE' WHEN 2 THEN 'TRAVEL' WHEN 3 THEN 'HEALTHCARE'"
    " WHEN 4 THEN 'UTILITIES' WHEN 5 THEN 'ENTERTAINMENT' WHEN 6 THEN 'EDUCATION' ELSE 'FUEL' END AS merchant_category",
    "CASE WHEN k < 88 THEN 'APPROVED' WHEN k < 96 THEN 'DECLINED' ELSE 'PENDING' END AS status",
    "CASE WHEN user_id % 20 < 11 THEN 'Bangkok' WHEN user_id % 20 < 14 THEN 'Chiang Mai'"
    " WHEN user_id % 20 < 16 THEN 'Pattaya' WHEN user_id % 20 < 18 THEN 'Phuket' ELSE 'Khon Kaen' END AS city",
    "(k % 8 = 0) AS is_international",
    "CAST(k AS DOUBLE) / CAST(300 AS DOUBLE) AS risk_score",
    "event_date",
)

BULK_PAYMENT = (
    "concat('TXN-', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS transaction_id",
    "concat('ACC-TH-', CAST(10000000 + o_custkey AS STRING)) AS account_id",
    "l_shipdate AS timestamp",
    "l_extendedprice AS amount",
    "CASE l_returnflag WHEN 'A' THEN 'APPROVED' WHEN 'N' THEN 'PENDING' ELSE 'DECLINED' END AS status",
    "(l_suppkey % 8 = 0) AS is_international",
    "l_discount AS risk_score",
    "CAST(l_shipdate AS DATE) AS event_date",
)

FRAUD_ALERT = (
    "event_id",
    "'FRAUD_SIGNAL' AS event_type",
    "account_id",
    "ts AS timestamp",
    "CASE k % 4 WHEN 0 THEN 'CARD_NOT_PRESENT' WHEN 1 THEN 'ACCOUNT_TAKEOVER'"
    " WHEN 2 THEN 'IDENTITY_THEFT' ELSE 'SYNTHETIC_IDENTITY' END AS fraud_type",
    "CAST(70 + k % 31 AS DOUBLE) / CAST(100 AS DOUBLE) AS ml_score",
    "filter(array(concat('RULE-', CAST(k % 4 AS STRING)), CASE WHEN k % 3 = 0 THEN 'VELOCITY' END), x -> x IS NOT NULL) AS rule_triggers",
    "CASE k % 3 WHEN 0 THEN 'BLOCK_AND_ALERT' WHEN 1 THEN 'FLAG_REVIEW' ELSE 'STEP_UP_AUTH' END AS action",
    "concat('CASE-2024-', lpad(CAST(event_id AS STRING), 9, '0')) AS case_id",
    "event_date",
)

AML_ALERT = (
    "event_id",
    "'AML_ALERT' AS event_type",
    "account_id",
    "ts AS timestamp",
    "CASE k % 3 WHEN 0 THEN 'STRUCTURING' WHEN 1 THEN 'LAYERING' ELSE 'ROUND_TRIPPING' END AS alert_type",
    "CASE WHEN k % 4 < 2 THEN 'HIGH' ELSE 'MEDIUM' END AS risk_band",
    "(k % 5 < 2) AS sar_required",
    "value * 10000 AS total_amount_7d",
    "event_date",
)

CUSTOMER_EVENT = (
    "event_id",
    "CASE WHEN event_type = 'view' THEN 'CUSTOMER_LOGIN' WHEN k % 4 = 1 THEN 'PROFILE_CHANGE' ELSE 'ACCOUNT_OPEN' END"
    " AS event_type",
    "account_id",
    "ts AS timestamp",
    "CASE WHEN event_type = 'view' THEN CASE WHEN k % 2 = 0 THEN 'MOBILE_APP' ELSE 'WEB' END END AS channel",
    "CASE WHEN event_type = 'view' THEN CASE k % 3 WHEN 0 THEN 'BIOMETRIC' WHEN 1 THEN 'OTP' ELSE 'PASSWORD' END END"
    " AS auth_method",
    "CASE WHEN event_type = 'view' THEN k % 20 <> 0 END AS login_success",
    "CASE WHEN event_type = 'view' THEN k % 20 = 1 END AS new_device",
    "event_date",
)

# Which events feed which table; sign-ups are split by the number in ``props``.
IS_PAYMENT = "event_type IN ('purchase', 'click')"
IS_FRAUD_ALERT = "event_type = 'error'"
IS_AML_ALERT = "event_type = 'signup' AND k < 50"
IS_CUSTOMER_EVENT = "event_type = 'view' OR (event_type = 'signup' AND k >= 50)"

CHANGE = (
    "o_custkey AS entity_key",
    "o_orderkey AS version_id",
    "o_orderdate AS changed_at",
    "o_orderstatus AS status",
    "o_totalprice AS amount",
)

RUN_LOG = """
    SELECT concat('B', CAST(year(o_orderdate) * 100 + month(o_orderdate) AS STRING)) AS batch_id,
           o_orderpriority AS source,
           count(*) AS rows_read,
           count_if(o_orderstatus = 'O') AS rows_inserted,
           count_if(o_orderstatus = 'F') AS rows_updated,
           CASE WHEN count_if(o_orderstatus = 'P') % 7 = 0 THEN 'FAILED' ELSE 'OK' END AS status,
           min(o_orderdate) AS started_at,
           max(o_orderdate) AS finished_at
    FROM {orders}
    GROUP BY 1, 2
"""


class DriverTables:
    """Lazy DataFrames over one folder of Parquet files."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(ddl(FILES[name])).parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events").selectExpr(*EVENT).selectExpr(*ACCOUNT)

    @cached_property
    def customers(self) -> DataFrame:
        nation, region = self.raw("nation"), self.raw("region")
        nations = nation.join(region, nation.n_regionkey == region.r_regionkey)
        customer = self.raw("customer")
        return customer.join(nations, customer.c_nationkey == nations.n_nationkey).selectExpr(*CUSTOMER)

    @cached_property
    def payments(self) -> DataFrame:
        return self.events.filter(IS_PAYMENT).selectExpr(*PAYMENT)

    @cached_property
    def bulk_tasks(self) -> int | None:
        return tasks_for(self.raw("lineitem"))

    @cached_property
    def payments_bulk(self) -> DataFrame:
        lineitem = dealt(self.raw("lineitem"), self.bulk_tasks, "l_orderkey")
        orders = dealt(self.raw("orders"), self.bulk_tasks, "o_orderkey")
        return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).selectExpr(*BULK_PAYMENT)

    @cached_property
    def fraud_alerts(self) -> DataFrame:
        return self.events.filter(IS_FRAUD_ALERT).selectExpr(*FRAUD_ALERT)

    @cached_property
    def aml_alerts(self) -> DataFrame:
        return self.events.filter(IS_AML_ALERT).selectExpr(*AML_ALERT)

    @cached_property
    def customer_events(self) -> DataFrame:
        return self.events.filter(IS_CUSTOMER_EVENT).selectExpr(*CUSTOMER_EVENT)

    @cached_property
    def changelog(self) -> DataFrame:
        return self.raw("orders").selectExpr(*CHANGE)

    @cached_property
    def run_log(self) -> DataFrame:
        return self.spark.sql(RUN_LOG, orders=self.raw("orders"))

    @property
    def event_sources(self) -> dict[str, DataFrame]:
        return {
            "payment_transactions": self.payments,
            "fraud_alerts": self.fraud_alerts,
            "customer_events": self.customer_events,
        }
