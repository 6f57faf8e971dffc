"""Question classification over a whole text column, in built-in expressions only.

The rules travel as one constant, and higher-order functions walk them. Spelling
out a condition per keyword would generate a method too large for the JVM to
compile, and planning would take longer than a small query.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import ACCOUNT_IN_TEXT
from ledgerlens.operators.question_rules import (
    ACCOUNT_SCORE,
    BOOST_SCORE,
    GROUP_SCORE,
    REFUSED_TERMS,
    SQL_STATEMENT,
    Rule,
)

_TERMS = "struct<words:array<string>,phrases:array<string>>"
_RULES = (
    f"array<struct<name:string,precedence:int,groups:array<{_TERMS}>,boost:{_TERMS},excludes:{_TERMS},takes_account:boolean>>"
)


def normalised(text: Column) -> Column:
    """Lower case, with everything but letters, digits, ``_`` and ``-`` read as one blank."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9_\-]+", " "))


def _is_phrase(term: str) -> bool:
    return any(mark in term for mark in " -_")


def _terms(terms: Iterable[str]) -> dict[str, list[str]]:
    kinds: dict[str, list[str]] = {"words": [], "phrases": []}
    for term in terms:
        kinds["phrases" if _is_phrase(term) else "words"].append(term)
    return kinds


def _constant(rules: Sequence[Rule]) -> Column:
    rows = [
        {
            "name": rule.name,
            "precedence": -place,
            "groups": [_terms(group) for group in rule.required],
            "boost": _terms(rule.boost),
            "excludes": _terms(rule.excludes),
            "takes_account": rule.takes_account,
        }
        for place, rule in enumerate(rules)
    ]
    return F.from_json(F.lit(json.dumps(rows)), _RULES)


def _known_words(rules: Sequence[Rule]) -> Column:
    """The words of a text that occur in any rule.

    The text is split once and each word looked up by hash, so a long text is not
    searched again for every keyword.
    """
    words = {term.strip() for term in REFUSED_TERMS}
    for rule in rules:
        words.update(rule.boost, rule.excludes, *rule.required)
    known = sorted(word for word in words if not _is_phrase(word))
    return F.filter(F.split("_text", " "), lambda word: word.isin(known))


def _occurs(terms: Column) -> Column:
    """Whether any term occurs: single words as whole words, phrases anywhere in the text."""
    return F.arrays_overlap(F.col("_known"), terms["words"]) | F.exists(
        terms["phrases"], lambda phrase: F.contains(F.col("_text"), phrase)
    )


def _occurring(terms: Column) -> Column:
    """How many terms occur."""
    words = F.filter(terms["words"], lambda word: F.array_contains(F.col("_known"), word))
    phrases = F.filter(terms["phrases"], lambda phrase: F.contains(F.col("_text"), phrase))
    return F.size(words) + F.size(phrases)


def _ranked(rule: Column) -> Column:
    """Compared field by field: score, then number of groups, then precedence."""
    groups = F.size(rule["groups"])
    account = F.when(rule["takes_account"] & F.col("_has_account"), ACCOUNT_SCORE).otherwise(0)
    score = groups * GROUP_SCORE + _occurring(rule["boost"]) * BOOST_SCORE + account
    return F.struct(
        score.alias("score"), groups.alias("groups"), rule["precedence"].alias("precedence"), rule["name"].alias("name")
    )


def _best(rules: Sequence[Rule]) -> Column:
    """The highest ranked rule that fits. Most texts lack a required term, so those are looked for first."""
    fitting = F.filter(_constant(rules), lambda rule: F.forall(rule["groups"], _occurs) & ~_occurs(rule["excludes"]))
    return F.array_max(F.transform(fitting, _ranked))


def _refused() -> Column:
    """Requests that would change data: the terms anywhere, those that end in a blank also as last word."""
    endings = F.array(*(F.lit(term.strip()) for term in REFUSED_TERMS if term != term.strip()))
    anywhere = F.array(*map(F.lit, REFUSED_TERMS))
    return F.arrays_overlap(F.col("_known"), endings) | F.exists(
        anywhere, lambda term: F.contains(F.col("_text"), term)
    )


def classify_text(df: DataFrame, text_col: str, rules: Sequence[Rule], refuse_sql: bool = False) -> DataFrame:
    """Adds ``outcome``, ``question`` and ``score``.

    Of the rules that fit, the one with the highest score wins, then the one with
    more required groups, then the earlier one. Texts that ask for a change of
    data (or are SQL, with ``refuse_sql``) are REFUSED, texts without a fitting
    rule UNSUPPORTED, texts without a word EMPTY.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    prepared = df.withColumns({"_text": normalised(text), "_has_account": text.rlike(ACCOUNT_IN_TEXT)})
    prepared = prepared.withColumn("_known", _known_words(rules))
    refused = _refused() | text.rlike(SQL_STATEMENT) if refuse_sql else _refused()
    scored = prepared.withColumns({"_best": _best(rules), "_refused": refused})
    outcome = (
        F.when(F.col("_text") == "", "EMPTY")
        .when(F.col("_refused"), "REFUSED")
        .when(F.col("_best").isNull(), "UNSUPPORTED")
        .otherwise("MATCHED")
    )
    matched = F.col("outcome") == "MATCHED"
    return (
        scored.withColumn("outcome", outcome)
        .withColumns({"question": F.when(matched, F.col("_best.name")), "score": F.when(matched, F.col("_best.score"))})
        .drop("_text", "_known", "_has_account", "_best", "_refused")
    )
