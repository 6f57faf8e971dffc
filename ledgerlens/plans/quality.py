"""Data-quality checks and reports over batch runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.expressions import (
    CUSTOMER_ID_PREFIX,
    EMAIL_MASK,
    NATIONAL_ID_MASK,
    PHONE_MASK,
    asc,
    desc,
    exact_mean,
    exact_total,
    money,
    percentage,
    rounded,
)
from ledgerlens.functions.params import first_rows, since_date
from ledgerlens.operators.matching import match_rate_events, union_all
from ledgerlens.plans.activity import key_uniqueness

# Thresholds of the quality gate.
MIN_CUSTOMERS = 10_000
MIN_MATCH_PCT = 95.0

# Fixed values: (attribute, category, lowest share, highest share) expected of a customer master.
EXPECTED_SHARES = (
    ("customer_tier", "STANDARD", 0.30, 0.40),
    ("customer_tier", "PLATINUM", 0.02, 0.08),
    ("risk_rating", "HIGH", 0.02, 0.09),
    ("kyc_status", "VERIFIED", 0.80, 0.90),
    ("city", "Bangkok", 0.50, 0.60),
    ("pep_flag", "true", 0.01, 0.04),
)


def last_batch(run_log: DataFrame) -> DataFrame:
    """The log rows of the newest batch, in the order the sources ran."""
    newest = run_log.agg(F.max("batch_id")).scalar()
    rows = run_log.filter(F.col("batch_id") == newest)
    if "duration_sec" in run_log.columns:
        rows = rows.withColumn("duration_sec", rounded(F.col("duration_sec"), 1))
    return rows.orderBy(*asc("started_at", "source"))


def idempotency_check(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows, distinct keys and duplicates per target; no replay may add a duplicate."""

    def one(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        # A composite key counts as a value even if a part is NULL; a single NULL key does not.
        filled = F.count(F.col(keys[0])) if len(keys) == 1 else F.count("*")
        per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
        counted = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_total"), filled.alias("distinct_keys"))
        return counted.select(
            F.lit(name).alias("table_name"), "*", (F.col("rows_total") - F.col("distinct_keys")).alias("duplicate_keys")
        )

    return union_all(one(name, df, keys) for name, (df, keys) in tables.items())


def source_vs_target(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: how many source rows the target still lacks."""
    counted = source.agg(F.count("*").alias("source_rows")).withColumn(
        "target_rows", target.agg(F.count("*")).scalar()
    )
    return counted.withColumn("not_yet_ingested", F.col("source_rows") - F.col("target_rows"))


def rollup_reconcile(payments: DataFrame, fact: DataFrame, *, day: date, days=3) -> DataFrame:
    """Event totals per day beside the roll-up's; the difference must be 0 for settled days."""
    truth = (
        since_date(payments, day, days)
        .groupBy("event_date")
        .agg(F.count("*").alias("events_txn_count"), exact_total("amount").alias("event_total"))
    )
    rolled = (
        since_date(fact, day, days)
        .groupBy("event_date")
        .agg(F.sum("txn_count").alias("rollup_txn_count"), exact_total("total_amount").alias("rolled_total"))
    )
    both = truth.join(rolled, "event_date", "left").withColumn("rolled_total", F.coalesce("rolled_total", F.lit(0)))
    report = both.select(
        "event_date",
        "events_txn_count",
        "rollup_txn_count",
        (F.col("events_txn_count") - F.coalesce("rollup_txn_count", F.lit(0))).alias("diff_txn_count"),
        money(F.col("event_total")).alias("events_total"),
        money(F.col("rolled_total")).alias("rollup_total"),
        money(F.col("event_total") - F.col("rolled_total")).alias("diff_total"),
    )
    return report.orderBy(*desc("event_date"))


def batch_history(run_log: DataFrame) -> DataFrame:
    measures = [
        F.count("*").alias("runs"),
        F.sum("rows_read").alias("rows_read_total"),
        F.sum("rows_inserted").alias("rows_inserted_total"),
        F.sum("rows_updated").alias("rows_updated_total"),
        F.count_if(F.col("status") == "FAILED").alias("failures"),
        F.max("finished_at").alias("last_run"),
    ]
    if "duration_sec" in run_log.columns:
        measures.append(rounded(exact_mean("duration_sec", 6), 1).alias("avg_duration_sec"))
    return run_log.groupBy("source").agg(*measures).orderBy(*asc("source"))


def lineage(dim: DataFrame, limit=None) -> DataFrame:
    """Rows per landing file and batch, newest first."""
    files = dim.groupBy("source_system", "batch_id", "source_file").agg(
        F.count("*").alias("rows_from_file"), F.max("ingested_at").alias("ingested_at")
    )
    order = (*desc("ingested_at"), *asc("source_system", "batch_id", "source_file"))
    return files.orderBy(*order).transform(first_rows, limit)


def _checks(frame: DataFrame, *checks: tuple[str, Column, Column]) -> DataFrame:
    """Checks ``(name, passed, detail)`` on one row of figures, unfolded so that the figures are computed once."""
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.when(F.coalesce(passed, F.lit(False)), "PASS").otherwise("FAIL").alias("status"),
            detail.alias("detail"),
        )
        for name, passed, detail in checks
    ]
    return frame.select(F.inline(F.array(*rows)))


def match_rate_gate(sources: Mapping[str, DataFrame], master: DataFrame, min_pct: float = MIN_MATCH_PCT) -> DataFrame:
    """PASS if the worst source with events reaches ``min_pct``; FAIL if none has any."""
    worst = match_rate_events(sources, master).filter(F.col("total_events") > 0).agg(
        F.min("match_percentage").alias("worst"), F.count("*").alias("sources")
    )
    detail = F.when(F.col("sources") == 0, "no events").otherwise(
        F.concat(F.lit("worst source matches "), F.col("worst").cast("decimal(5,2)").cast("string"), F.lit(" %"))
    )
    return _checks(worst, ("event match rate", F.col("worst") >= min_pct, detail))


def quality_report(
    master: DataFrame | None,
    analyses: Mapping[str, DataFrame],
    sources: Mapping[str, DataFrame],
    min_customers: int = MIN_CUSTOMERS,
    min_pct: float = MIN_MATCH_PCT,
) -> DataFrame:
    """``(check_name, status, detail)``: master size and keys, analyses that must return rows, match rate.

    Without a master the checks that need it are SKIP.
    """
    if master is None:
        spark = next(iter(sources.values())).sparkSession
        names = ("master size", "master key is unique", *analyses, "event match rate")
        return spark.createDataFrame(
            [(name, "SKIP", "no customer master") for name in names], "check_name string, status string, detail string"
        )
    keys = key_uniqueness(master)
    total, duplicates = F.col("total_rows"), F.col("duplicate_accounts")
    checks = [
        _checks(
            keys,
            ("master size", total >= min_customers, F.concat(total.cast("string"), F.lit(" rows"))),
            ("master key is unique", duplicates == 0, F.concat(duplicates.cast("string"), F.lit(" duplicates"))),
        )
    ]
    for name, rows in analyses.items():
        n = F.col("n")
        counted = rows.agg(F.count("*").alias("n"))
        checks.append(_checks(counted, (name, n > 0, F.concat(n.cast("string"), F.lit(" rows joined")))))
    checks.append(match_rate_gate(sources, master, min_pct))
    return union_all(checks)


def known_unknown_by_topic(topics: Mapping[str, Sequence[DataFrame]], master: DataFrame) -> DataFrame:
    """Known and unknown accounts per topic; a topic may feed several tables."""
    joined = {topic: union_all(df.select("account_id") for df in frames) for topic, frames in topics.items()}
    report = match_rate_events(joined, master)
    unknown_pct = percentage(F.col("unmatched_events"), F.col("total_events"))
    return report.select(
        F.col("event_source").alias("topic"),
        F.col("total_events").alias("events"),
        F.col("matched_events").alias("known_accounts"),
        F.col("unmatched_events").alias("unknown_accounts"),
        unknown_pct.alias("unknown_pct"),
    )


def attribute_agreement(payments: DataFrame, master: DataFrame, attributes: Sequence[str] = ("city", "customer_tier")) -> DataFrame:
    """Payments of known accounts whose attributes differ from the master's.

    Counted per account and attribute values before the join. A domestic payment
    must also carry the home country, where both sides have one.
    """
    shared = [a for a in attributes if a in payments.columns and a in master.columns]
    with_country = "country" in payments.columns and "country" in master.columns
    extra = ["country"] if with_country else []
    seen = payments.groupBy(
        "account_id", "is_international", *(F.col(a).alias(f"_{a}") for a in [*shared, *extra])
    ).agg(F.count("*").alias("n"))
    home = master.select("account_id", *shared, *extra)
    joined = seen.join(home, "account_id")

    def differing(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias(name)

    measures = [differing(F.col(f"_{a}") != F.col(a), f"{a}_differs") for a in shared]
    if with_country:
        abroad = ~F.col("is_international") & (F.col("_country") != F.col("country"))
        measures.append(differing(abroad, "domestic_country_differs"))
    return joined.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("payments_compared"), *measures)


def masking_check(master: DataFrame) -> DataFrame:
    """Per personal column: rows, and rows that do not look masked (a 13-digit id never does)."""
    rules: dict[str, Column] = {
        "national_id_masked": F.col("national_id_masked").rlike(NATIONAL_ID_MASK)
        & (F.length(F.regexp_replace("national_id_masked", r"\D", "")) < 13),
        "mobile_number_masked": F.col("mobile_number_masked").rlike(PHONE_MASK),
        "email": F.col("email").rlike(EMAIL_MASK),
        "customer_id": F.col("customer_id").startswith(CUSTOMER_ID_PREFIX),
    }
    rules = {c: ok for c, ok in rules.items() if c in master.columns}
    counted = master.agg(
        F.count("*").alias("rows_total"), *(F.count_if(~ok | ok.isNull()).alias(c) for c, ok in rules.items())
    )
    return counted.unpivot("rows_total", list(rules), "column_name", "rows_unmasked").withColumn(
        "status", F.when(F.col("rows_unmasked") == 0, "PASS").otherwise("FAIL")
    )


def category_shares(df: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """``(attribute, category, rows, share)`` for several columns in one pass.

    Each row becomes one row per attribute inside the map task; what is shuffled
    is one row per category and task.
    """
    as_text = df.select(*(F.col(a).cast("string").alias(a) for a in attributes))
    long = as_text.unpivot([], list(attributes), "attribute", "category")
    counts = long.groupBy("attribute", "category").agg(F.count("*").alias("rows"))
    totals = df.agg(F.count("*")).scalar()
    return counts.withColumn("share", rounded(F.try_divide(F.col("rows").cast("double"), totals), 6))


def distribution_check(
    df: DataFrame, bounds: Sequence[tuple[str, str, float, float]] = EXPECTED_SHARES
) -> DataFrame:
    """PASS for each bounded category whose share lies within its limits; an absent category has share 0."""
    present = [b for b in bounds if b[0] in df.columns]
    attributes = list(dict.fromkeys(b[0] for b in present))
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in ("attribute", "category")]
        + [T.StructField(c, T.DoubleType()) for c in ("lowest", "highest")]
    )
    expected = df.sparkSession.createDataFrame(present, schema)
    joined = expected.join(category_shares(df, attributes), ["attribute", "category"], "left")
    share = F.coalesce("share", F.lit(0.0))
    return joined.select(
        "attribute",
        "category",
        "lowest",
        "highest",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        share.alias("share"),
        F.when(share.between(F.col("lowest"), F.col("highest")), "PASS").otherwise("FAIL").alias("status"),
    )
