"""How well event accounts and the customer master fit together."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import exact_total, money, percentage


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def known_accounts(master: DataFrame) -> DataFrame:
    """Distinct master keys: duplicates in the master must not multiply counts."""
    return master.select("account_id").distinct().withColumn("known", F.lit(True))


def _with_known(per_account: DataFrame, master: DataFrame) -> DataFrame:
    return per_account.join(known_accounts(master), "account_id", "left").withColumn(
        "known", F.coalesce("known", F.lit(False))
    )


def match_events(sources: Mapping[str, DataFrame], master: DataFrame) -> DataFrame:
    """One row for each source: events with and without a master record.

    Events are counted per account before the join, so it carries one row per
    account however often the account occurs. All sources share one join, so that
    the master is read and its keys made distinct once; empty sources have a row too.
    """
    per_account = union_all(
        df.groupBy("account_id").agg(F.count("*").alias("n")).withColumn("source", F.lit(name)) for name, df in sources.items()
    )

    def events(name: str, known: bool) -> Column:
        counts = F.when((F.col("source") == name) & (F.col("known") == known), F.col("n"))
        return F.coalesce(F.sum(counts), F.lit(0))

    counted = _with_known(per_account, master).agg(
        *(events(name, known).alias(f"{known}_{i}") for i, name in enumerate(sources) for known in (True, False))
    )
    rows = []
    for i, name in enumerate(sources):
        matched, unmatched = F.col(f"True_{i}"), F.col(f"False_{i}")
        rows.append(
            F.struct(
                F.lit(name).alias("event_source"),
                (matched + unmatched).alias("total_events"),
                matched.alias("matched_events"),
                unmatched.alias("unmatched_events"),
                percentage(matched, matched + unmatched).alias("match_percentage"),
            )
        )
    return counted.select(F.inline(F.array(*rows)))


def match_accounts(events: DataFrame, master: DataFrame, source: str) -> DataFrame:
    """One row: distinct event accounts with and without a master record."""
    counted = _with_known(events.select("account_id").distinct(), master).agg(
        F.count("*").alias("total_accounts"),
        F.count_if("known").alias("matched_accounts"),
        F.count_if(~F.col("known")).alias("unmatched_accounts"),
    )
    return counted.select(
        F.lit(source).alias("event_source"),
        "*",
        percentage(F.col("matched_accounts"), F.col("total_accounts")).alias("match_percentage"),
    )


def match_rate_events(sources: Mapping[str, DataFrame], master: DataFrame) -> DataFrame:
    return match_events(sources, master)


def match_rate_accounts(sources: Mapping[str, DataFrame], master: DataFrame) -> DataFrame:
    return union_all(match_accounts(df, master, name) for name, df in sources.items())


def keys_in_both(left: DataFrame, right: DataFrame, left_name: str, right_name: str, sample: int | None = None) -> DataFrame:
    """One row: how many distinct accounts of ``left`` occur in ``right`` too.

    Counts all accounts; ``sample`` estimates the rate from so many accounts of ``left``, those
    of least hash, each held against all of ``right``. Reruns pick the same accounts.
    """
    left_keys, right_keys = left.select("account_id").distinct(), right.select("account_id").distinct()
    if sample is not None:
        left_keys = left_keys.orderBy(F.xxhash64("account_id"), "account_id").limit(sample)
    flagged = left_keys.join(right_keys.withColumn("found", F.lit(True)), "account_id", "left")
    counted = flagged.agg(F.count("*").alias("distinct_left_accounts"), F.count("found").alias("matched_accounts"))
    rate = F.col("matched_accounts") / F.greatest("distinct_left_accounts", F.lit(1))
    return counted.select(
        F.lit(left_name).alias("left_table"), F.lit(right_name).alias("right_table"), "*", rate.alias("match_rate")
    )


def unmatched_accounts(payments: DataFrame, master: DataFrame) -> DataFrame:
    """Accounts with payments but no master record, with totals; aggregated before the anti join."""
    per_account = payments.groupBy("account_id").agg(
        F.count("*").alias("event_count"),
        exact_total("amount").alias("total"),
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
    )
    alone = per_account.join(master.select("account_id").distinct(), "account_id", "left_anti")
    return alone.select(
        F.col("account_id").alias("unmatched_account_id"),
        "event_count",
        money(F.col("total")).alias("total_amount"),
        "first_seen",
        "last_seen",
    )
