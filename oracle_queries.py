"""SQL counterparts of the registered queries, for DuckDB over the same Parquet files.

Written independently of the DataFrame code: joins where the operators
pre-aggregate, and plain windows where they cut early. Only the fixed keyword
rules are shared. Sums are taken as DECIMAL and rounded on the decimal value,
with a unique last sort key under every limit.
"""

from __future__ import annotations

from ledgerlens.operators.question_rules import ACTIVITY_RULES, CUSTOMER_RULES, REFUSED_TERMS, SQL_STATEMENT, Rule

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
SINCE = f'"timestamp" >= {AS_OF} - INTERVAL 744 HOUR'
DAY = "DATE '2024-01-30'"
LAST_30 = f"event_date >= {DAY} - INTERVAL 30 DAY"
CUT = "TIMESTAMP '1999-01-01 00:00:00'"

VIEWS = {
    "ev": """
        SELECT *, CAST(ts AS DATE) AS event_date,
               concat('ACC-TH-', CAST(CASE WHEN k IN (42, 99) THEN 90000000 ELSE 10000000 END + user_id AS STRING)) AS account_id
        FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events)
    """,
    "customers": """
        SELECT concat('CUST-DEMO-', lpad(CAST(c_custkey AS STRING), 7, '0')) AS customer_id,
               concat('ACC-TH-', CAST(10000000 + c_custkey AS STRING)) AS account_id,
               c_name AS full_name, n_name AS city, r_name AS province,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'PLATINUM' WHEN 'MACHINERY' THEN 'GOLD'
                    WHEN 'HOUSEHOLD' THEN 'SILVER' ELSE 'STANDARD' END AS customer_tier,
               CASE WHEN c_acctbal < 0 THEN 'HIGH' WHEN c_acctbal < 5000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_rating,
               CASE WHEN c_custkey % 20 < 17 THEN 'VERIFIED' WHEN c_custkey % 20 < 19 THEN 'PENDING' ELSE 'EXPIRED' END AS kyc_status,
               CASE WHEN c_custkey % 100 = 0 THEN 'MATCH_REVIEW' WHEN c_custkey % 33 = 0 THEN 'PENDING_REVIEW' ELSE 'CLEAR' END
                   AS sanctions_screening_status,
               (c_custkey % 10 = 0) AS pep_flag,
               CASE c_custkey % 5 WHEN 0 THEN 'POS' WHEN 1 THEN 'MOBILE_APP' WHEN 2 THEN 'ONLINE_BANKING'
                    WHEN 3 THEN 'ATM' ELSE 'BRANCH' END AS preferred_channel
        FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
    """,
    "payments": """
        SELECT event_id, event_id AS transaction_id, account_id, ts AS "timestamp", value AS amount,
               CASE k % 5 WHEN 0 THEN 'POS' WHEN 1 THEN 'MOBILE_APP' WHEN 2 THEN 'ONLINE_BANKING'
                    WHEN 3 THEN 'ATM' ELSE 'BRANCH' END AS channel,
               CASE k % 8 WHEN 0 THEN 'RETAIL' WHEN 1 THEN 'FOOD_BEVERAGE' WHEN 2 THEN 'TRAVEL' WHEN 3 THEN 'HEALTHCARE'
                    WHEN 4 THEN 'UTILITIES' WHEN 5 THEN 'ENTERTAINMENT' WHEN 6 THEN 'EDUCATION' ELSE 'FUEL' END AS merchant_category,
               CASE WHEN k < 88 THEN 'APPROVED' WHEN k < 96 THEN 'DECLINED' ELSE 'PENDING' END AS status,
               CASE WHEN user_id % 20 < 11 THEN 'Bangkok' WHEN user_id % 20 < 14 THEN 'Chiang Mai' WHEN user_id % 20 < 16 THEN 'Pattaya'
                    WHEN user_id % 20 < 18 THEN 'Phuket' ELSE 'Khon Kaen' END AS city,
               (k % 8 = 0) AS is_international,
               CAST(k AS DOUBLE) / CAST(300 AS DOUBLE) AS risk_score, event_date
        FROM ev WHERE event_type IN ('purchase', 'click')
    """,
    "payments_bulk": """
        SELECT concat('TXN-', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS transaction_id,
               concat('ACC-TH-', CAST(10000000 + o_custkey AS STRING)) AS account_id,
               l_shipdate AS "timestamp", l_extendedprice AS amount,
               CASE l_returnflag WHEN 'A' THEN 'APPROVED' WHEN 'N' THEN 'PENDING' ELSE 'DECLINED' END AS status,
               (l_suppkey % 8 = 0) AS is_international, l_discount AS risk_score, CAST(l_shipdate AS DATE) AS event_date
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    """,
    "fraud_alerts": """
        SELECT event_id, 'FRAUD_SIGNAL' AS event_type, account_id, ts AS "timestamp",
               CASE k % 4 WHEN 0 THEN 'CARD_NOT_PRESENT' WHEN 1 THEN 'ACCOUNT_TAKEOVER'
                    WHEN 2 THEN 'IDENTITY_THEFT' ELSE 'SYNTHETIC_IDENTITY' END AS fraud_type,
               CAST(70 + k % 31 AS DOUBLE) / CAST(100 AS DOUBLE) AS ml_score,
               list_filter([concat('RULE-', CAST(k % 4 AS VARCHAR)), CASE WHEN k % 3 = 0 THEN 'VELOCITY' END], lambda x: x IS NOT NULL) AS rule_triggers,
               CASE k % 3 WHEN 0 THEN 'BLOCK_AND_ALERT' WHEN 1 THEN 'FLAG_REVIEW' ELSE 'STEP_UP_AUTH' END AS action,
               concat('CASE-2024-', lpad(CAST(event_id AS STRING), 9, '0')) AS case_id, event_date
        FROM ev WHERE event_type = 'error'
    """,
    "aml_alerts": """
        SELECT event_id, 'AML_ALERT' AS event_type, account_id, ts AS "timestamp",
               CASE k % 3 WHEN 0 THEN 'STRUCTURING' WHEN 1 THEN 'LAYERING' ELSE 'ROUND_TRIPPING' END AS alert_type,
               CASE WHEN k % 4 < 2 THEN 'HIGH' ELSE 'MEDIUM' END AS risk_band,
               (k % 5 < 2) AS sar_required, value * 10000 AS total_amount_7d, event_date
        FROM ev WHERE event_type = 'signup' AND k < 50
    """,
    "customer_events": """
        SELECT event_id,
               CASE WHEN event_type = 'view' THEN 'CUSTOMER_LOGIN' WHEN k % 4 = 1 THEN 'PROFILE_CHANGE' ELSE 'ACCOUNT_OPEN' END AS event_type,
               account_id, ts AS "timestamp",
               CASE WHEN event_type = 'view' THEN CASE WHEN k % 2 = 0 THEN 'MOBILE_APP' ELSE 'WEB' END END AS channel,
               CASE WHEN event_type = 'view' THEN CASE k % 3 WHEN 0 THEN 'BIOMETRIC' WHEN 1 THEN 'OTP' ELSE 'PASSWORD' END END AS auth_method,
               CASE WHEN event_type = 'view' THEN k % 20 <> 0 END AS login_success,
               CASE WHEN event_type = 'view' THEN k % 20 = 1 END AS new_device, event_date
        FROM ev WHERE event_type = 'view' OR (event_type = 'signup' AND k >= 50)
    """,
    "changelog": """
        SELECT o_custkey AS entity_key, o_orderkey AS version_id, o_orderdate AS changed_at,
               o_orderstatus AS status, o_totalprice AS amount
        FROM orders
    """,
    "run_log": """
        SELECT concat('B', CAST(year(o_orderdate) * 100 + month(o_orderdate) AS STRING)) AS batch_id,
               o_orderpriority AS source, count(*) AS rows_read,
               count(*) FILTER (WHERE o_orderstatus = 'O') AS rows_inserted, count(*) FILTER (WHERE o_orderstatus = 'F') AS rows_updated,
               CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'P') % 7 = 0 THEN 'FAILED' ELSE 'OK' END AS status,
               min(o_orderdate) AS started_at, max(o_orderdate) AS finished_at
        FROM orders GROUP BY 1, 2
    """,
    "newest_before": f"""
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY entity_key ORDER BY changed_at DESC, version_id DESC) AS rn
            FROM changelog WHERE changed_at < {CUT}) WHERE rn = 1
    """,
    "newest_after": f"""
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY entity_key ORDER BY changed_at DESC, version_id DESC) AS rn
            FROM changelog WHERE changed_at >= {CUT}) WHERE rn = 1
    """,
}

_NEEDS = {name: ["ev"] for name in ("payments", "fraud_alerts", "aml_alerts", "customer_events")}
_NEEDS.update({"newest_before": ["changelog"], "newest_after": ["changelog"]})


_INTERVALS = """SELECT *, changed_at AS valid_from, lead(changed_at) OVER (PARTITION BY entity_key ORDER BY changed_at, version_id) AS valid_to
                FROM changelog"""


def _q(views: str, body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` with the named views (and those they need) as common table expressions."""
    names: list[str] = []
    for view in views.split():
        names += [n for n in [*_NEEDS.get(view, []), view] if n not in names]
    ctes = [f"{n} AS ({VIEWS[n]})" for n in names] + [f"{n} AS ({sql})" for n, sql in (extra or {}).items()]
    return (f"WITH {', '.join(ctes)} " if ctes else "") + body


def _total(column: str, scale: int = 4) -> str:
    return f"sum(CAST({column} AS DECIMAL(28,{scale})))"


def _mean(column: str, scale: int = 4) -> str:
    return f"(CAST({_total(column, scale)} AS DOUBLE) / count({column}))"


def _round(value: str, digits: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def _money(total: str) -> str:
    return f"CAST(round({total}, 2) AS DOUBLE)"


def _pct(part: str, whole: str, digits: int = 2) -> str:
    return _round(f"(CAST(100 AS DOUBLE) * {part} / nullif({whole}, 0))", digits)


def _int(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


_MEASURES = f"""
    count(*) AS txn_count, {_money(_total('amount'))} AS total_amount, {_round(_mean('amount'), 6)} AS avg_amount,
    max(amount) AS max_amount, count(*) FILTER (WHERE status = 'APPROVED') AS approved_count, count(*) FILTER (WHERE status = 'DECLINED') AS declined_count,
    count(*) FILTER (WHERE is_international) AS intl_count, {_round(_mean('risk_score', 9), 6)} AS avg_risk_score
"""

_DAILY = """SELECT event_date, account_id, {measures}, min("timestamp") AS first_txn_at, max("timestamp") AS last_txn_at
            FROM {source} GROUP BY event_date, account_id"""


def _counted(table: str, key: str, measure: str, where: str = "TRUE") -> str:
    return f"""SELECT {key}, count(*) AS {measure} FROM {table} WHERE {SINCE} AND {where}
               GROUP BY {key} ORDER BY {measure} DESC, {key} NULLS LAST"""


_ALERT_COLUMNS = '"timestamp", account_id, fraud_type, ml_score, action, case_id, event_id'


def _alert_detail(profile: str, where: str) -> str:
    return f"""SELECT {profile}, f."timestamp" AS alert_timestamp, f.fraud_type, f.ml_score, f.action, f.case_id
               FROM customers c JOIN fraud_alerts f ON c.account_id = f.account_id
               WHERE f.{SINCE} AND {where}
               ORDER BY f.ml_score DESC, f."timestamp" DESC, f.event_id DESC LIMIT 1000"""


def _top_customers(source: str, where: str, last: str = "LIMIT 1000") -> str:
    return f"""SELECT c.customer_id, c.account_id, c.full_name, c.city AS customer_city, c.customer_tier, c.risk_rating,
                      count(p.transaction_id) AS transaction_count, {_money(_total('p.amount'))} AS total_transaction_amount,
                      {_round(_mean('p.amount'), 2)} AS average_transaction_amount, max(p."timestamp") AS latest_transaction
               FROM customers c JOIN {source} p ON c.account_id = p.account_id WHERE {where}
               GROUP BY 1, 2, 3, 4, 5, 6 ORDER BY total_transaction_amount DESC, customer_id {last}"""


def _exposure(where: str, columns: str) -> str:
    return f"""
        SELECT {columns} FROM (
            SELECT c.*, coalesce(f.n, 0) AS fraud_alert_count, f.top AS max_fraud_score, coalesce(f.blocked, 0) AS blocked_alert_count,
                   coalesce(p.n, 0) AS payment_count, coalesce(p.total, 0) AS total_payment_amount,
                   coalesce(p.intl, 0) AS international_payment_count,
                   greatest(coalesce(f.latest, TIMESTAMP '1970-01-01'), coalesce(p.latest, TIMESTAMP '1970-01-01')) AS most_recent_event_at
            FROM customers c
            LEFT JOIN (SELECT account_id, count(*) AS n, {_money(_total('amount'))} AS total, count(*) FILTER (WHERE is_international) AS intl,
                              max("timestamp") AS latest FROM payments WHERE {where} GROUP BY account_id) p ON p.account_id = c.account_id
            LEFT JOIN (SELECT account_id, count(*) AS n, max(ml_score) AS top, count(*) FILTER (WHERE action = 'BLOCK_AND_ALERT') AS blocked,
                              max("timestamp") AS latest FROM fraud_alerts WHERE {where} GROUP BY account_id) f ON f.account_id = c.account_id
            WHERE (c.risk_rating = 'HIGH' OR c.pep_flag) AND (p.account_id IS NOT NULL OR f.account_id IS NOT NULL))
        ORDER BY max_fraud_score DESC NULLS LAST, total_payment_amount DESC, customer_id LIMIT {{limit}}"""


_EXPOSURE_COLUMNS = """customer_id, account_id, full_name, customer_tier, city, risk_rating, pep_flag, kyc_status, fraud_alert_count,
    max_fraud_score, payment_count, total_payment_amount, international_payment_count, most_recent_event_at"""


def _mode(source: str, where: str, name: str) -> str:
    return f"""SELECT account_id, channel AS {name} FROM (
                   SELECT account_id, channel, row_number() OVER (PARTITION BY account_id ORDER BY count(*) DESC, channel NULLS LAST) AS rn
                   FROM {source} WHERE {where} GROUP BY account_id, channel) WHERE rn = 1"""


_LOGIN = "event_type = 'CUSTOMER_LOGIN'"

_SOURCES = (("payment_transactions", "payments"), ("fraud_alerts", "fraud_alerts"), ("customer_events", "customer_events"))


def _match_events(name: str, table: str) -> str:
    return f"""SELECT '{name}' AS event_source, count(*) AS total_events, count(*) FILTER (WHERE m.account_id IS NOT NULL) AS matched_events,
                      count(*) FILTER (WHERE m.account_id IS NULL) AS unmatched_events,
                      {_pct('count(*) FILTER (WHERE m.account_id IS NOT NULL)', 'count(*)')} AS match_percentage
               FROM {table} e LEFT JOIN customers m ON m.account_id = e.account_id"""


def _match_accounts(name: str, table: str) -> str:
    return f"""SELECT '{name}' AS event_source, count(*) AS total_accounts, count(*) FILTER (WHERE m.account_id IS NOT NULL) AS matched_accounts,
                      count(*) FILTER (WHERE m.account_id IS NULL) AS unmatched_accounts,
                      {_pct('count(*) FILTER (WHERE m.account_id IS NOT NULL)', 'count(*)')} AS match_percentage
               FROM (SELECT DISTINCT account_id FROM {table}) e LEFT JOIN customers m ON m.account_id = e.account_id"""


_ALL_MATCHES = " UNION ALL ".join(_match_events(n, t) for n, t in _SOURCES)
_GATE = f"""SELECT 'event match rate' AS check_name, CASE WHEN min(match_percentage) >= 95 THEN 'PASS' ELSE 'FAIL' END AS status,
                   CASE WHEN count(*) = 0 THEN 'no events'
                        ELSE concat('worst source matches ', CAST(CAST(min(match_percentage) AS DECIMAL(5,2)) AS STRING), ' %') END AS detail
            FROM ({_ALL_MATCHES}) WHERE total_events > 0"""


def _both(left: str, right: str, left_name: str, right_name: str) -> str:
    return f"""SELECT '{left_name}' AS left_table, '{right_name}' AS right_table, count(*) AS distinct_left_accounts,
                      count(r.account_id) AS matched_accounts, {_round('count(r.account_id) / greatest(count(*), 1)', 6)} AS match_rate
               FROM (SELECT DISTINCT account_id FROM {left}) l
               LEFT JOIN (SELECT DISTINCT account_id FROM {right}) r ON r.account_id = l.account_id"""


def _upserted(old: str, new: str) -> str:
    takes = "(o.entity_key IS NULL OR (n.entity_key IS NOT NULL AND n.changed_at >= o.changed_at))"
    columns = ", ".join(
        f"CASE WHEN {takes} THEN n.{c} ELSE o.{c} END AS {c}" for c in ("entity_key", "version_id", "changed_at", "status", "amount")
    )
    return f"SELECT {columns} FROM {new} n FULL OUTER JOIN {old} o ON n.entity_key = o.entity_key"


# Questions ------------------------------------------------------------------


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _hit(term: str) -> str:
    if any(mark in term for mark in " -_"):
        return f"contains(t, {_text(term)})"
    return f"list_contains(words, {_text(term)})"


def _any(terms) -> str:
    return "(" + " OR ".join(map(_hit, terms)) + ")" if terms else "FALSE"


def _classify(source: str, id_columns: str, rules: tuple[Rule, ...], refuse_sql: bool) -> str:
    """One row per fitting rule, then the best per text."""
    normal = f"""SELECT {id_columns}, raw, t, string_split(t, ' ') AS words FROM (
                     SELECT *, text AS raw, trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9_\\-]+', ' ', 'g')) AS t FROM ({source}))"""
    candidates = []
    for order, rule in enumerate(rules):
        boosts = " + ".join(["0"] + [f"CASE WHEN {_hit(b)} THEN 3 ELSE 0 END" for b in rule.boost])
        account = ""
        if rule.takes_account:
            account = r" + CASE WHEN regexp_matches(raw, '(?i)acc[-\s_]?th[-\s_]?(\d{8})') THEN 12 ELSE 0 END"
        required = " AND ".join(_any(group) for group in rule.required)
        candidates.append(
            f"SELECT {id_columns}, {_text(rule.name)} AS question, {10 * len(rule.required)} + {boosts}{account} AS score, "
            f"{len(rule.required)} AS n_groups, {order} AS precedence FROM normal WHERE {required} AND NOT {_any(rule.excludes)}"
        )
    on = " AND ".join(f"n.{c.strip()} = b.{c.strip()}" for c in id_columns.split(","))
    refused = " OR ".join(
        [f"contains(n.t, {_text(term)})" for term in REFUSED_TERMS]
        + [f"list_contains(n.words, {_text(term.strip())})" for term in REFUSED_TERMS]
    )
    if refuse_sql:
        refused += f" OR regexp_matches(coalesce(n.raw, ''), {_text(SQL_STATEMENT)})"
    ids = ", ".join(f"n.{c.strip()}" for c in id_columns.split(","))
    return f"""WITH normal AS ({normal}), candidates AS ({' UNION ALL '.join(candidates)}),
        best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {id_columns}
                 ORDER BY score DESC, n_groups DESC, precedence) AS rn FROM candidates) WHERE rn = 1),
        judged AS (SELECT {ids}, b.question, b.score,
                   CASE WHEN n.t = '' THEN 'EMPTY' WHEN {refused} THEN 'REFUSED'
                        WHEN b.question IS NULL THEN 'UNSUPPORTED' ELSE 'MATCHED' END AS outcome
                   FROM normal n LEFT JOIN best b ON {on})
        SELECT {id_columns}, outcome, CASE WHEN outcome = 'MATCHED' THEN question END AS question,
               CASE WHEN outcome = 'MATCHED' THEN CAST(score AS INT) END AS score FROM judged"""


_CONVERSATIONS = "SELECT conv_id, turn, text FROM conversations"
_EVENT_QUESTIONS = f"""
    SELECT event_id,
      concat(CASE k % 12 WHEN 0 THEN 'How many fraud alerts in the LAST HOUR' WHEN 1 THEN 'average ml_score by type'
             WHEN 2 THEN 'Which accounts have the highest fraud scores?' WHEN 3 THEN 'latest high-risk alerts, please'
             WHEN 4 THEN 'Show trends over time' WHEN 5 THEN 'blocked, flagged or step-up?' WHEN 6 THEN 'Customer 360 profile'
             WHEN 7 THEN 'highest payment of all customers' WHEN 8 THEN 'Platinum customers; fraud'
             WHEN 9 THEN 'compare preferred channels with actual' WHEN 10 THEN 'SELECT 1 from logins'
             ELSE 'which cities? new device logins' END,
             CASE WHEN k % 7 = 0 THEN ' for ACC-TH-' WHEN k % 7 = 1 THEN ' then drop table ' ELSE ' ' END,
             CAST(10000000 + user_id AS STRING)) AS text
    FROM ({VIEWS['ev']})
"""

_SHARES = " UNION ALL ".join(
    f"SELECT '{a}' AS attribute, CAST({a} AS STRING) AS category, count(*) AS rows, "
    f"{_round('CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM customers)', 6)} AS share FROM customers GROUP BY {a}"
    for a in ("customer_tier", "risk_rating", "kyc_status", "city", "pep_flag")
)

ORACLE: dict[str, str] = {
    # sources
    "parse_json_props": _q(
        "payments",
        'SELECT CAST(event_id AS STRING) AS event_id, "timestamp", account_id, amount, channel, status, is_international, event_date FROM payments',
    ),
    "rejected_messages": """SELECT props AS message, count(*) AS n FROM events
                            WHERE event_type NOT IN ('purchase', 'click') GROUP BY props""",
    "read_customers": f"""
        SELECT concat('CUST-DEMO-', lpad(CAST(c_custkey AS STRING), 7, '0')) AS customer_id, c_name AS full_name,
               c_custkey % 10 = 0 AS pep_flag, c_custkey % 3 = 0 AS marketing_consent,
               CAST(c_acctbal * 10 AS DECIMAL(14,2)) AS annual_income, src_updated_at, 'crm.customers' AS source_system
        FROM customer JOIN (SELECT o_custkey, max(o_orderdate) AS src_updated_at FROM orders GROUP BY 1) ON o_custkey = c_custkey
        WHERE src_updated_at > {CUT}""",
    "schema_report": _q(
        "payments",
        """SELECT table_name, column_name, problem, CASE WHEN column_name IS NULL THEN 0 ELSE (SELECT count(*) FROM payments) END AS rows_affected
           FROM (VALUES
            ('payment_transactions', 'event_type', 'missing column'), ('payment_transactions', 'currency', 'missing column'),
            ('payment_transactions', 'country', 'missing column'), ('payment_transactions', 'latitude', 'missing column'),
            ('payment_transactions', 'longitude', 'missing column'), ('payment_transactions', 'customer_tier', 'missing column'),
            ('payment_transactions', 'ingested_at', 'missing column'), ('payment_agg', NULL, 'missing table')
           ) AS t(table_name, column_name, problem)""",
    ),
    "partition_stats": """SELECT CAST(ts AS DATE) AS event_date, count(*) AS record_count, CAST(1 AS BIGINT) AS file_count
                          FROM events GROUP BY 1""",
    # batch upserts
    "watermark": _q("changelog", "SELECT max(changed_at) AS high_water_mark FROM changelog"),
    "stage_dedupe": _q(
        "changelog",
        """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entity_key
           ORDER BY changed_at DESC, version_id DESC) AS rn FROM changelog) WHERE rn = 1""",
    ),
    "upsert": _q("newest_before newest_after", _upserted("newest_before", "newest_after")),
    "upsert_replay": _q("newest_before newest_after", _upserted("newest_after", "newest_before")),
    "upsert_refresh": _q(
        "newest_before newest_after",
        """SELECT coalesce(o.entity_key, n.entity_key) AS entity_key, coalesce(o.version_id, n.version_id) AS version_id,
                  coalesce(o.changed_at, n.changed_at) AS changed_at, coalesce(o.status, n.status) AS status,
                  coalesce(n.amount, o.amount) AS amount
           FROM newest_before o FULL OUTER JOIN newest_after n ON n.entity_key = o.entity_key""",
    ),
    "quarantine": _q(
        "changelog", "SELECT CAST(NULL AS BIGINT) AS entity_key, * EXCLUDE (entity_key) FROM changelog WHERE status = 'P'"
    ),
    "stage_without_order": _q(
        "changelog",
        """SELECT c.* FROM changelog c JOIN (SELECT entity_key, max(version_id) AS top FROM changelog WHERE status <> 'P' GROUP BY 1) m
           ON c.entity_key = m.entity_key AND c.version_id = m.top""",
    ),
    "upsert_counts": _q(
        "newest_before newest_after",
        """SELECT count(*) FILTER (WHERE o.entity_key IS NULL) AS rows_inserted, count(*) FILTER (WHERE n.changed_at >= o.changed_at) AS rows_updated,
                  count(*) FILTER (WHERE n.changed_at < o.changed_at) AS rows_stale
           FROM newest_after n LEFT JOIN newest_before o ON n.entity_key = o.entity_key""",
    ),
    "incremental_filter": _q("changelog", f"SELECT * FROM changelog WHERE changed_at > {CUT}"),
    "rollup_lookback": _q(
        "payments_bulk",
        _DAILY.format(measures=_MEASURES, source="(SELECT * FROM payments_bulk WHERE event_date >= DATE '1998-12-31')"),
    ),
    "payments_daily": _q("payments_bulk", _DAILY.format(measures=_MEASURES, source="payments_bulk")),
    "shard_counts": _q(
        "customers",
        """SELECT CAST(('0x' || substr(md5(customer_id), 1, 8)) AS BIGINT) % 16 AS shard, count(*) AS customers
           FROM customers GROUP BY 1""",
    ),
    # streaming transformations on batch input
    "payment_windows": _q(
        "payments",
        f"""SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp") AS window_start,
                   time_bucket(INTERVAL 5 MINUTE, "timestamp") + INTERVAL 5 MINUTE AS window_end,
                   city, channel, merchant_category, {_MEASURES},
                   CAST(time_bucket(INTERVAL 5 MINUTE, "timestamp") AS DATE) AS event_date
            FROM payments GROUP BY ALL""",
    ),
    "progress_report": _q(
        "ev",
        """SELECT concat('q', user_id) AS query_id, concat('stream ', user_id) AS query_name, count(*) FILTER (NOT ends) AS triggers,
                  CAST(sum(CASE WHEN k >= 40 THEN k ELSE 0 END) AS BIGINT) AS rows_in, max(value) AS peak_rows_per_second,
                  CAST(max(k) AS BIGINT) AS slowest_trigger_ms, max(ts) FILTER (NOT ends) AS last_trigger_at,
                  CASE WHEN bool_or(ends AND latest = 1) THEN 'FAILED' ELSE 'RUNNING' END AS status,
                  NOT bool_or(ends AND latest = 1) AND count(*) FILTER (NOT ends) >= 3
                      AND coalesce(sum(k) FILTER (NOT ends AND newness <= 3 AND k >= 40), 0) = 0 AS starved
           FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ends ORDER BY ts DESC, event_id DESC) AS newness,
                        row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, ends DESC) AS latest
                 FROM (SELECT *, coalesce(event_type = 'signup' AND k > 97, false) AS ends FROM ev))
           GROUP BY user_id""",
    ),
    "route_fraud": _q(
        "fraud_alerts",
        """SELECT CAST(event_id AS STRING) AS event_id, event_type, "timestamp", account_id, fraud_type, ml_score,
                  array_to_string(rule_triggers, ',') AS rule_triggers, action, case_id, event_date FROM fraud_alerts""",
    ),
    "intake_account": _q(
        "ev fraud_alerts aml_alerts customer_events",
        """SELECT 'payment_transactions' AS stream, count(*) AS rows_read, count(*) FILTER (event_type IN ('purchase', 'click')) AS rows_kept,
                  count(*) FILTER (event_type NOT IN ('purchase', 'click')) AS rows_rejected, CAST(0 AS BIGINT) AS rows_unrouted FROM events
           UNION ALL
           SELECT 'signals', kept + bad + other, kept, bad, other FROM (
               SELECT (SELECT count(*) FROM fraud_alerts) + (SELECT count(*) FROM aml_alerts) + (SELECT count(*) FROM customer_events) AS kept,
                      count(*) FILTER (event_type = 'click') AS bad, count(*) FILTER (event_type = 'purchase') AS other FROM events)""",
    ),
    "rejected_events": """SELECT 'signals' AS stream, CASE event_type WHEN 'click' THEN 'rejected' ELSE 'unrouted' END AS outcome,
                                 CASE event_type WHEN 'purchase' THEN CAST(event_id AS VARCHAR) END AS event_id,
                                 CASE event_type WHEN 'purchase' THEN event_type END AS event_type,
                                 CASE event_type WHEN 'click' THEN props
                                      ELSE concat('{"event_id":"', event_id, '","event_type":"', event_type, '"}') END AS message
                          FROM events WHERE event_type IN ('click', 'purchase')""",
    "intake_report": _q(
        "ev",
        """SELECT concat('q', user_id) AS query_id, concat('stream ', user_id) AS query_name, CAST(sum(k) AS BIGINT) AS rows_read,
                  CAST(sum(k - k % 3 - k % 2) AS BIGINT) AS rows_kept, CAST(sum(k % 3) AS BIGINT) AS rows_rejected,
                  CAST(sum(CASE WHEN event_type = 'error' THEN 0 ELSE k % 2 END) AS BIGINT) AS rows_unrouted, CAST(sum(k % 5) AS BIGINT) AS rows_late,
                  CAST(max(k) AS BIGINT) AS peak_state_rows, CAST(sum(CASE WHEN event_type = 'error' THEN k % 2 ELSE 0 END) AS BIGINT) AS unaccounted
           FROM ev WHERE event_type != 'signup' GROUP BY user_id""",
    ),
    "route_aml": _q(
        "aml_alerts",
        """SELECT CAST(event_id AS STRING) AS event_id, event_type, "timestamp", account_id, alert_type, risk_band, sar_required,
                  total_amount_7d, event_date FROM aml_alerts""",
    ),
    "route_customer": _q(
        "customer_events",
        """SELECT CAST(event_id AS STRING) AS event_id, event_type, "timestamp", account_id, channel, auth_method, login_success,
                  new_device, event_date FROM customer_events""",
    ),
    # single-table analyses
    "fraud_count_last_hour": _q(
        "fraud_alerts", f'SELECT count(*) AS alert_count FROM fraud_alerts WHERE "timestamp" >= {AS_OF} - INTERVAL 1 HOUR'
    ),
    "fraud_by_type": _q("fraud_alerts", _counted("fraud_alerts", "fraud_type", "alert_count")),
    "fraud_by_action": _q("fraud_alerts", _counted("fraud_alerts", "action", "alert_count")),
    "action_outcomes": _q(
        "fraud_alerts",
        _counted("fraud_alerts", "action", "alert_count", "action IN ('BLOCK_AND_ALERT', 'FLAG_REVIEW', 'STEP_UP_AUTH')"),
    ),
    "fraud_type_share": _q(
        "fraud_alerts",
        f"""SELECT fraud_type, n AS alert_count, {_pct('n', 'sum(n) OVER ()', 1)} AS share_pct
            FROM (SELECT fraud_type, count(*) AS n FROM fraud_alerts WHERE {SINCE} GROUP BY 1)""",
    ),
    "top_accounts": _q(
        "fraud_alerts",
        f"""SELECT account_id, max(ml_score) AS max_ml_score, count(*) AS alert_count FROM fraud_alerts WHERE {SINCE}
            GROUP BY 1 ORDER BY max_ml_score DESC, alert_count DESC, account_id LIMIT 20""",
    ),
    "latest_high_risk": _q(
        "fraud_alerts",
        f"""SELECT {_ALERT_COLUMNS} FROM fraud_alerts WHERE {SINCE} AND ml_score >= 0.85
            ORDER BY "timestamp" DESC, event_id DESC LIMIT 100""",
    ),
    "avg_score_by_type": _q(
        "fraud_alerts",
        f"""SELECT fraud_type, {_round(_mean('ml_score', 9), 6)} AS avg_ml_score, count(*) AS alert_count
            FROM fraud_alerts WHERE {SINCE} GROUP BY 1""",
    ),
    "fraud_trend_by_hour": _q(
        "fraud_alerts",
        f"""SELECT date_trunc('hour', "timestamp") AS alert_hour, count(*) AS alert_count,
                   {_round(_mean('ml_score', 9), 6)} AS avg_ml_score
            FROM fraud_alerts WHERE {SINCE} GROUP BY 1 ORDER BY 1""",
    ),
    "recent_alerts": _q(
        "fraud_alerts", f'SELECT {_ALERT_COLUMNS} FROM fraud_alerts ORDER BY "timestamp" DESC, event_id DESC LIMIT 10'
    ),
    "aml_by_risk_band": _q(
        "aml_alerts",
        f"""SELECT risk_band, count(*) AS alert_count, {_round(_mean('total_amount_7d'), 4)} AS avg_amount_7d
            FROM aml_alerts WHERE {SINCE} GROUP BY 1""",
    ),
    "login_outcomes": _q("customer_events", _counted("customer_events", "login_success", "login_count", _LOGIN)),
    "new_device_logins": _q("customer_events", _counted("customer_events", "new_device", "login_count", _LOGIN)),
    "approval_rate": _q(
        "payments",
        f"""SELECT channel, count(*) AS total_txns, count(*) FILTER (WHERE status = 'APPROVED') AS approved,
                   {_pct("count(*) FILTER (WHERE status = 'APPROVED')", 'count(*)')} AS approval_rate_pct,
                   {_money(_total('amount'))} AS total_value, {_round(_mean('risk_score', 9), 4)} AS avg_risk
            FROM payments WHERE {SINCE} GROUP BY 1""",
    ),
    "top_merchant_categories": _q(
        "payments",
        f"""SELECT merchant_category, count(*) AS txn_count, {_money(_total('amount'))} AS total_spend,
                   {_round(_mean('amount'), 2)} AS avg_txn_value
            FROM payments WHERE event_date = {DAY} AND status = 'APPROVED' GROUP BY 1""",
    ),
    "fraud_by_type_action": _q(
        "fraud_alerts",
        f"""SELECT fraud_type, action, count(*) AS alert_count, {_round(_mean('ml_score', 9), 3)} AS avg_ml_score
            FROM fraud_alerts WHERE {SINCE} GROUP BY 1, 2""",
    ),
    "sar_cases": _q(
        "aml_alerts",
        f"""SELECT account_id, alert_type, risk_band, total_amount_7d, "timestamp" FROM aml_alerts
            WHERE event_date = {DAY} AND sar_required AND risk_band = 'HIGH'""",
    ),
    "failed_logins": _q(
        "customer_events",
        f"""SELECT account_id, count(*) AS failed_logins, min("timestamp") AS first_attempt, max("timestamp") AS last_attempt
            FROM customer_events WHERE {SINCE} AND {_LOGIN} AND NOT login_success GROUP BY 1 HAVING count(*) >= 3""",
    ),
    "freshness": _q(
        "payments fraud_alerts customer_events aml_alerts",
        " UNION ALL ".join(
            f"""SELECT '{n}' AS table_name, count(*) AS row_count, max("timestamp") AS newest_event FROM {t}"""
            for n, t in (*_SOURCES, ("aml_alerts", "aml_alerts"))
        ),
    ),
    "key_uniqueness": _q(
        "customers",
        """SELECT count(*) AS total_rows, count(DISTINCT account_id) AS distinct_accounts,
                  count(*) - count(DISTINCT account_id) AS duplicate_accounts FROM customers""",
    ),
    "account_format_check": _q(
        "customers",
        r"""SELECT min(account_id) AS first_account, max(account_id) AS last_account,
                   count(*) FILTER (WHERE regexp_matches(account_id, '^ACC-TH-\d{8}$')) AS well_formed_accounts FROM customers""",
    ),
    "tier_risk_distribution": _q(
        "customers", "SELECT customer_tier, risk_rating, count(*) AS customers FROM customers GROUP BY 1, 2"
    ),
    "canonical_accounts": _q(
        "ev",
        r"""SELECT event_id, CASE WHEN d <> '' THEN 'ACC-TH-' || d END AS mentioned_account FROM (
                SELECT event_id, regexp_extract(concat(event_type, CASE k % 4 WHEN 0 THEN ' acc th ' WHEN 1 THEN ' ACC_TH-'
                       WHEN 2 THEN ' Acc-Th' ELSE ' ref ' END, CAST(10000000 + user_id AS STRING), ' ', props),
                       '(?i)acc[-\s_]?th[-\s_]?(\d{8})', 1) AS d FROM ev)""",
    ),
    # analyses across sources
    "top_customers": _q("customers payments", _top_customers("payments", f"p.{SINCE}")),
    "top_customers_bulk": _q(
        "customers payments_bulk",
        _top_customers("payments_bulk", """p."timestamp" >= TIMESTAMP '1999-01-01 00:00:00' - INTERVAL 8760 HOUR"""),
    ),
    "top_customers_all": _q("customers payments", _top_customers("payments", f"p.{SINCE}", "")),
    "customer_payment_360_all": _q("customers payments", _top_customers("payments", f"p.{LAST_30}", "")),
    "customer_payment_360": _q("customers payments", _top_customers("payments", f"p.{LAST_30}")),
    "join_sample": _q(
        "customers payments",
        f"""SELECT c.account_id, c.full_name, c.customer_tier, p.transaction_id, p.amount, p."timestamp"
            FROM customers c JOIN payments p ON c.account_id = p.account_id WHERE p.event_date >= {DAY} - INTERVAL 1 DAY
            ORDER BY p."timestamp" DESC, p.transaction_id DESC LIMIT 5""",
    ),
    "high_risk_fraud": _q(
        "customers fraud_alerts",
        _alert_detail(
            "c.customer_id, c.account_id, c.full_name, c.customer_tier, c.city, c.risk_rating, c.kyc_status", "c.risk_rating = 'HIGH'"
        ),
    ),
    "customer_fraud_360": _q(
        "customers fraud_alerts",
        _alert_detail(
            """c.customer_id, c.account_id, c.full_name, c.customer_tier, c.city, c.risk_rating AS customer_risk_rating, c.kyc_status,
               c.pep_flag""",
            "TRUE",
        ),
    ),
    "platinum_fraud": _q(
        "customers fraud_alerts",
        f"""SELECT c.customer_id, c.account_id, c.full_name, c.customer_tier, c.city, c.risk_rating, count(*) AS fraud_alert_count,
                   max(f.ml_score) AS max_ml_score, max(f."timestamp") AS latest_alert_at,
                   count(*) FILTER (WHERE f.action = 'BLOCK_AND_ALERT') AS blocked_count
            FROM customers c JOIN fraud_alerts f ON f.account_id = c.account_id
            WHERE c.customer_tier = 'PLATINUM' AND f.{SINCE} GROUP BY 1, 2, 3, 4, 5, 6
            ORDER BY max_ml_score DESC, fraud_alert_count DESC, customer_id""",
    ),
    "pep_high_fraud": _q(
        "customers fraud_alerts",
        _alert_detail(
            """c.customer_id, c.account_id, c.full_name, c.pep_flag, c.sanctions_screening_status, c.kyc_status, c.customer_tier,
               c.city""",
            "c.pep_flag AND f.ml_score >= 0.85",
        ),
    ),
    "channel_comparison": _q(
        "customers payments",
        f"""SELECT c.preferred_channel AS stated_preferred_channel, m.top AS actual_top_payment_channel,
                   c.preferred_channel || ' -> ' || m.top AS comparison, count(DISTINCT c.customer_id) AS customers,
                   count(*) AS payment_count, {_money(_total('p.amount'))} AS total_amount
            FROM customers c JOIN modes m ON m.account_id = c.account_id
            JOIN (SELECT * FROM payments WHERE {SINCE}) p ON p.account_id = c.account_id GROUP BY 1, 2, 3""",
        {"modes": _mode("payments", SINCE, "top")},
    ),
    "new_device_customers": _q(
        "customers customer_events",
        f"""SELECT c.customer_id, c.account_id, c.full_name, c.customer_tier, c.city, c.risk_rating, c.preferred_channel,
                   count(*) FILTER (WHERE e.new_device) AS new_device_logins, count(*) AS total_logins, count(*) FILTER (WHERE NOT e.login_success) AS failed_logins,
                   max(e."timestamp") AS latest_login_at, string_agg(DISTINCT e.auth_method, ', ' ORDER BY e.auth_method) AS auth_methods
            FROM customers c JOIN customer_events e ON e.account_id = c.account_id WHERE e.{SINCE} AND e.{_LOGIN}
            GROUP BY 1, 2, 3, 4, 5, 6, 7 HAVING count(*) FILTER (WHERE e.new_device) > 0
            ORDER BY new_device_logins DESC, latest_login_at DESC, customer_id""",
    ),
    "fraud_by_city": _q(
        "customers fraud_alerts",
        f"""SELECT c.city AS customer_city, c.province, count(DISTINCT c.account_id) AS customers_affected, count(*) AS fraud_alert_count,
                   {_round(_mean('f.ml_score', 9), 4)} AS avg_ml_score, max(f.ml_score) AS max_ml_score,
                   count(*) FILTER (WHERE f.action = 'BLOCK_AND_ALERT') AS blocked_count
            FROM customers c JOIN fraud_alerts f ON f.account_id = c.account_id WHERE f.{SINCE} GROUP BY 1, 2""",
    ),
    "risk_exposure": _q("customers payments fraud_alerts", _exposure(SINCE, _EXPOSURE_COLUMNS).format(limit=1000)),
    "risk_exposure_360": _q(
        "customers payments fraud_alerts",
        _exposure(LAST_30, _EXPOSURE_COLUMNS + ", sanctions_screening_status, blocked_alert_count").format(limit=1000),
    ),
    "channel_profile": _q(
        "customers payments customer_events",
        f"""SELECT c.customer_id, c.account_id, c.full_name, c.customer_tier, c.city, c.preferred_channel AS stated_preferred_channel,
                   pm.top AS actual_top_payment_channel, coalesce(p.n, 0) AS payment_count, coalesce(p.total, 0) AS total_payment_amount,
                   lm.top AS actual_top_login_channel, coalesce(l.n, 0) AS login_attempts, coalesce(l.ok, 0) AS successful_logins,
                   coalesce(l.bad, 0) AS failed_logins, coalesce(l.fresh, 0) AS new_device_logins, l.methods AS auth_methods_used,
                   CASE WHEN pm.top IS NULL THEN 'NO_PAYMENT_ACTIVITY' WHEN pm.top = c.preferred_channel THEN 'MATCHES_PREFERENCE'
                        ELSE 'DIFFERS_FROM_PREFERENCE' END AS channel_alignment
            FROM customers c
            LEFT JOIN (SELECT account_id, count(*) AS n, {_money(_total('amount'))} AS total FROM payments WHERE {LAST_30} GROUP BY 1) p
                   ON p.account_id = c.account_id
            LEFT JOIN pmodes pm ON pm.account_id = c.account_id
            LEFT JOIN (SELECT account_id, count(*) AS n, count(*) FILTER (WHERE login_success) AS ok, count(*) FILTER (WHERE NOT login_success) AS bad,
                              count(*) FILTER (WHERE new_device) AS fresh, string_agg(DISTINCT auth_method, ', ' ORDER BY auth_method) AS methods
                       FROM customer_events WHERE {LAST_30} AND {_LOGIN} GROUP BY 1) l ON l.account_id = c.account_id
            LEFT JOIN lmodes lm ON lm.account_id = c.account_id
            WHERE p.account_id IS NOT NULL OR l.account_id IS NOT NULL
            ORDER BY payment_count DESC, login_attempts DESC, customer_id""",
        {"pmodes": _mode("payments", LAST_30, "top"), "lmodes": _mode("customer_events", f"{LAST_30} AND {_LOGIN}", "top")},
    ),
    "customer_profile": _q(
        "customers payments fraud_alerts customer_events aml_alerts",
        f"""SELECT c.customer_id, c.account_id, c.full_name, c.customer_tier, c.city, c.province, c.risk_rating, c.kyc_status, c.pep_flag,
                   c.sanctions_screening_status, c.preferred_channel,
                   (SELECT count(*) FROM payments p WHERE p.account_id = c.account_id AND {SINCE}) AS payment_count,
                   coalesce((SELECT {_money(_total('amount'))} FROM payments p WHERE p.account_id = c.account_id AND {SINCE}), 0)
                       AS total_payment_amount,
                   (SELECT max("timestamp") FROM payments p WHERE p.account_id = c.account_id AND {SINCE}) AS latest_payment_at,
                   (SELECT count(*) FROM fraud_alerts f WHERE f.account_id = c.account_id AND {SINCE}) AS fraud_alert_count,
                   (SELECT max(ml_score) FROM fraud_alerts f WHERE f.account_id = c.account_id AND {SINCE}) AS max_fraud_score,
                   (SELECT count(*) FROM customer_events e WHERE e.account_id = c.account_id AND {_LOGIN} AND {SINCE}) AS login_count,
                   (SELECT count(*) FILTER (WHERE new_device) FROM customer_events e WHERE e.account_id = c.account_id AND {_LOGIN} AND {SINCE})
                       AS new_device_logins,
                   (SELECT count(*) FROM aml_alerts a WHERE a.account_id = c.account_id AND {SINCE}) AS aml_alert_count
            FROM customers c WHERE c.account_id = 'ACC-TH-10000003'""",
    ),
    "unmatched_accounts": _q(
        "customers payments",
        f"""SELECT p.account_id AS unmatched_account_id, count(*) AS event_count, {_money(_total('p.amount'))} AS total_amount,
                   min(p."timestamp") AS first_seen, max(p."timestamp") AS last_seen
            FROM payments p LEFT JOIN customers c ON c.account_id = p.account_id WHERE c.account_id IS NULL AND p.{SINCE}
            GROUP BY 1 ORDER BY event_count DESC, unmatched_account_id""",
    ),
    "tier_payment_summary": _q(
        "customers payments",
        f"""SELECT c.customer_tier, c.risk_rating, count(DISTINCT f.account_id) AS accounts_with_payments,
                   {_int('sum(f.n)')} AS txn_count, {_money('sum(f.total)')} AS total_amount,
                   {_round(_mean('f.risk', 9), 3)} AS avg_risk_score,
                   {_round("CAST(sum(CAST(f.risk * f.n AS DECIMAL(28,9))) AS DOUBLE) / sum(f.n)", 3)} AS weighted_risk_score
            FROM (SELECT event_date, account_id, count(*) AS n, {_total('amount')} AS total, {_mean('risk_score', 9)} AS risk
                  FROM payments WHERE {LAST_30} GROUP BY 1, 2) f
            JOIN customers c ON c.account_id = f.account_id GROUP BY 1, 2""",
    ),
    "match_rate_events": _q("customers payments fraud_alerts customer_events", _ALL_MATCHES),
    "match_rate_accounts": _q(
        "customers payments fraud_alerts customer_events", " UNION ALL ".join(_match_accounts(n, t) for n, t in _SOURCES)
    ),
    "join_match_rate": _q(
        "payments fraud_alerts customer_events aml_alerts",
        " UNION ALL ".join(
            _both(l, r, ln, rn)
            for l, r, ln, rn in (
                ("fraud_alerts", "payments", "fraud_alerts", "payment_transactions"),
                ("fraud_alerts", "aml_alerts", "fraud_alerts", "aml_alerts"),
                ("fraud_alerts", "customer_events", "fraud_alerts", "customer_events"),
                ("aml_alerts", "customer_events", "aml_alerts", "customer_events"),
            )
        ),
    ),
    # data quality and run reports
    "last_batch": _q("run_log", "SELECT * FROM run_log WHERE batch_id = (SELECT max(batch_id) FROM run_log)"),
    "idempotency_check": _q(
        "customers changelog payments_bulk",
        """SELECT 'dim_customer' AS table_name, count(*) AS rows_total, count(DISTINCT customer_id) AS distinct_keys,
                  count(*) - count(DISTINCT customer_id) AS duplicate_keys FROM customers
           UNION ALL SELECT 'changelog', count(*), count(DISTINCT entity_key), count(*) - count(DISTINCT entity_key) FROM changelog
           UNION ALL SELECT 'fact_payment_daily', count(*), count(*), 0
                     FROM (SELECT DISTINCT event_date, account_id FROM payments_bulk)""",
    ),
    "source_vs_target": _q(
        "customers changelog",
        """SELECT s AS source_rows, t AS target_rows, s - t AS not_yet_ingested FROM (
               SELECT (SELECT count(*) FROM customers) AS s,
                      (SELECT count(DISTINCT entity_key) FROM changelog WHERE changed_at <= TIMESTAMP '1995-06-01') AS t)""",
    ),
    "rollup_reconcile": _q(
        "payments",
        f"""SELECT g.event_date, g.n AS events_txn_count, r.n AS rollup_txn_count, g.n - coalesce(r.n, 0) AS diff_txn_count,
                   {_money('g.total')} AS events_total, {_money('coalesce(r.total, 0)')} AS rollup_total,
                   {_money('g.total - coalesce(r.total, 0)')} AS diff_total
            FROM (SELECT event_date, count(*) AS n, {_total('amount')} AS total FROM payments WHERE {LAST_30} GROUP BY 1) g
            LEFT JOIN (SELECT event_date, count(*) AS n, {_total('amount')} AS total FROM payments
                       WHERE event_date < {DAY} AND {LAST_30} GROUP BY 1) r ON r.event_date = g.event_date""",
    ),
    "batch_history": _q(
        "run_log",
        f"""SELECT source, count(*) AS runs, {_int('sum(rows_read)')} AS rows_read_total, {_int('sum(rows_inserted)')} AS rows_inserted_total,
                   {_int('sum(rows_updated)')} AS rows_updated_total, count(*) FILTER (WHERE status = 'FAILED') AS failures, max(finished_at) AS last_run
            FROM run_log GROUP BY 1""",
    ),
    "lineage": """
        SELECT 'file://landing/orders' AS source_system, concat('B', strftime(o_orderdate, '%Y%m')) AS batch_id,
               concat('orders-', o_orderstatus, '.csv') AS source_file, count(*) AS rows_from_file, max(o_orderdate) AS ingested_at
        FROM orders GROUP BY 1, 2, 3 ORDER BY ingested_at DESC, batch_id, source_file""",
    "match_rate_gate": _q("customers payments fraud_alerts customer_events", _GATE),
    "quality_report": _q(
        "customers payments fraud_alerts customer_events",
        f"""SELECT 'master size' AS check_name, CASE WHEN count(*) >= 10000 THEN 'PASS' ELSE 'FAIL' END AS status,
                   concat(CAST(count(*) AS STRING), ' rows') AS detail FROM customers
            UNION ALL SELECT 'master key is unique', CASE WHEN count(*) = count(DISTINCT account_id) THEN 'PASS' ELSE 'FAIL' END,
                   concat(CAST(count(*) - count(DISTINCT account_id) AS STRING), ' duplicates') FROM customers
            UNION ALL SELECT 'customer payments', CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END,
                   concat(CAST(least(count(*), 100) AS STRING), ' rows joined')
                   FROM (SELECT DISTINCT c.customer_id FROM customers c JOIN payments p ON p.account_id = c.account_id WHERE p.{SINCE})
            UNION ALL SELECT 'customer alerts', CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END,
                   concat(CAST(least(count(*), 100) AS STRING), ' rows joined')
                   FROM customers c JOIN fraud_alerts f ON f.account_id = c.account_id WHERE c.risk_rating = 'HIGH' AND f.{SINCE}
            UNION ALL {_GATE}""",
    ),
    "known_unknown_by_topic": _q(
        "customers payments fraud_alerts customer_events aml_alerts",
        f"""SELECT topic, count(*) AS events, count(m.account_id) AS known_accounts, count(*) - count(m.account_id) AS unknown_accounts,
                   {_pct('(count(*) - count(m.account_id))', 'count(*)')} AS unknown_pct
            FROM (SELECT 'payments.raw' AS topic, account_id FROM payments UNION ALL SELECT 'fraud.signals', account_id FROM fraud_alerts
                  UNION ALL SELECT 'customer.events', account_id FROM customer_events
                  UNION ALL SELECT 'customer.events', account_id FROM aml_alerts) e
            LEFT JOIN customers m ON m.account_id = e.account_id GROUP BY 1""",
    ),
    "attribute_agreement": _q(
        "customers payments",
        """SELECT count(*) AS payments_compared, count(*) FILTER (WHERE p.city <> c.city) AS city_differs
           FROM payments p JOIN customers c ON c.account_id = p.account_id""",
    ),
    "masking_check": _q(
        "customers",
        "SELECT count(*) AS rows_total, 'customer_id' AS column_name, 0 AS rows_unmasked, 'PASS' AS status FROM customers "
        + " ".join(
            f"""UNION ALL SELECT count(*), '{c}', count(*) FILTER (WHERE risk_rating = 'HIGH'),
                CASE WHEN count(*) FILTER (WHERE risk_rating = 'HIGH') = 0 THEN 'PASS' ELSE 'FAIL' END FROM customers"""
            for c in ("national_id_masked", "mobile_number_masked", "email")
        ),
    ),
    "distribution_check": _q(
        "customers",
        """SELECT b.attribute, b.category, lowest, highest, coalesce(s.rows, 0) AS rows, coalesce(s.share, 0) AS share,
                  CASE WHEN coalesce(s.share, 0) BETWEEN lowest AND highest THEN 'PASS' ELSE 'FAIL' END AS status
           FROM bounds b LEFT JOIN shares s ON s.attribute = b.attribute AND s.category = b.category""",
        {
            "shares": _SHARES,
            "bounds": """SELECT attribute, category, CAST(lo AS DOUBLE) AS lowest, CAST(hi AS DOUBLE) AS highest FROM (VALUES
                ('customer_tier', 'STANDARD', 0.30, 0.40), ('customer_tier', 'PLATINUM', 0.02, 0.08), ('risk_rating', 'HIGH', 0.02, 0.09),
                ('kyc_status', 'VERIFIED', 0.80, 0.90), ('city', 'Bangkok', 0.50, 0.60), ('pep_flag', 'true', 0.01, 0.04)
                ) AS b(attribute, category, lo, hi)""",
        },
    ),
    "category_shares": _q("customers", _SHARES),
    # change log
    "state_as_of": _q(
        "changelog",
        f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entity_key ORDER BY changed_at DESC, version_id DESC) AS rn
            FROM changelog WHERE changed_at <= {CUT}) WHERE rn = 1""",
    ),
    "interval_history": _q("changelog", _INTERVALS),
    "extend_intervals": _q("changelog", _INTERVALS),
    "state_in_intervals": _q(
        "changelog",
        f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entity_key ORDER BY changed_at DESC, version_id DESC) AS rn
            FROM changelog WHERE changed_at <= {CUT}) WHERE rn = 1""",
    ),
    "commit_history": _q(
        "changelog",
        """SELECT changed_at, count(*) AS rows_committed, count(DISTINCT entity_key) AS keys_touched,
                  count(*) - count(DISTINCT entity_key) AS rows_superseded FROM changelog GROUP BY 1""",
    ),
    "prune_changelog": _q(
        "changelog",
        """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entity_key ORDER BY changed_at DESC, version_id DESC) AS rn
           FROM changelog) WHERE rn <= 5 OR changed_at >= TIMESTAMP '2001-01-01'""",
    ),
    # questions
    "classify_questions": _classify(_CONVERSATIONS, "conv_id, turn", ACTIVITY_RULES, False),
    "classify_customer_questions": _classify(_CONVERSATIONS, "conv_id, turn", CUSTOMER_RULES, True),
    "classify_event_questions": _classify(_EVENT_QUESTIONS, "event_id", ACTIVITY_RULES, False),
    "classify_event_customer_questions": _classify(_EVENT_QUESTIONS, "event_id", CUSTOMER_RULES, True),
}
