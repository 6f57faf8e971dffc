"""Quality rules: a table of thresholds compiled into column expressions of one projection.

Every measure is a built-in function of the one text, so nothing is shuffled and no
user function runs. A null, empty or blank text has no words and fails the least
length; repeated rows are judged alike, each for itself; other columns pass through.
Texts longer than 2^31 characters are beyond what a column can hold.

No rule asks for a language: function words are listed ones, or short words that the text
itself repeats, whichever are more; words in capitals are shouted whatever follows them, and
scripts without capitals have none. Text of a script written without spaces is few, long
words and fails the least length or the bound on word length.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.words import SEPARATOR_CLASS, WORD_CLASS


class Rule(NamedTuple):
    """Holds while low * whole <= 100 * part <= high * whole; None: no bound. All are integers."""

    name: str
    part: str
    whole: str
    low: int | None
    high: int | None


# The base rules.
BASE_RULES = [
    Rule("length", "n_words", "one", 5000, None),
    Rule("repeated words", "n_repeat_words", "n_words", None, 50),
]

# Bounds of this rule set, in percent of the whole.
RULES = [
    Rule("word length", "word_chars", "n_words", 150, 1500),
    Rule("symbols", "n_symbols", "n_words", None, 25),
    Rule("function words", "n_function_words", "n_words", 4, None),
    Rule("repeated lines", "n_dup_lines", "n_lines", None, 40),
    Rule("shouted words", "n_shouted", "n_words", None, 40),
]

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = [
    "the", "of", "and", "to", "a", "in", "is", "that", "for", "it", "was", "on", "with", "be", "as", "are", "this",
    "der", "die", "und", "den", "von", "zu", "das", "sich", "mit", "auf", "des", "für", "ist", "nicht", "im", "dem", "ein", "eine",
    "de", "la", "le", "et", "les", "en", "un", "du", "une", "que", "pour", "est", "qui", "dans", "par", "pas", "au", "sur",
    "el", "y", "los", "se", "del", "las", "por", "no", "con", "su", "una", "es", "para", "al", "lo",
]

# A short word: one to four letters and their marks. A shouted word: a capital and no small letter.
SHORT_WORD = r"^[\p{L}\p{M}]{1,4}$"
CAPITAL, SMALL = r"\p{Lu}", r"\p{Ll}"

# Characters of markup and tables that count as symbols.
SYMBOLS = "#*$%&|<>"
_SEPARATORS = " \t\n\x0b\x0c\r"
WINDOW = 3


def words_of(text: Column) -> Column:
    """The words of a text, unchanged; none of a null or blank one."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SEPARATORS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SEPARATOR_CLASS + "+"))


def _marks(ordered: str, differs: str, same: str) -> str:
    """For each place of the ordered windows but the first: 0 unlike the one before, 1 like it, 2 alike in the key only."""
    return (
        f"transform({ordered}, (x, j) -> CASE WHEN j = 0 THEN 0 WHEN {differs} THEN 0 WHEN {same} THEN 1 ELSE 2 END)"
    )


def _covered(ordered: str, place: str, marks: str) -> str:
    """Words in the windows that a neighbour in the order equals."""
    places = (
        f"sort_array(transform(filter(transform({ordered}, (x, j) -> IF({marks}[j] = 1 OR coalesce(get({marks}, j + 1), 0) = 1,"
        f" {place}, -1)), p -> p >= 0), p -> CAST(p AS INT)))"
    )
    return (
        f"aggregate({places}, named_struct('e', 0, 'n', 0L), (a, p) ->"
        f" named_struct('e', p + {WINDOW}, 'n', a.n + p + {WINDOW} - greatest(p, a.e)), a -> a.n)"
    )


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one struct column ``measures`` of all counts that rules can name.

    Repeated windows are found by sorting 64-bit keys that hold a hash of three words
    above and the window's place below; equal hashes are compared word by word, and a
    text in which unequal windows share a hash is sorted by the words themselves.
    """
    at = "x & ~_mask"
    before = "get(_keys, j - 1) & ~_mask"
    same_here = " AND ".join(f"_w[CAST({at} AS INT) + {k}] = _w[CAST({before} AS INT) + {k}]" for k in range(WINDOW))
    window = ", ".join(f"_w[i + {k}]" for k in range(WINDOW))
    gram = ", ".join(f"'w{k}', _w[i + {k}]" for k in range(WINDOW))
    same_words = " AND ".join(f"x.w{k} = get(_grams, j - 1).w{k}" for k in range(WINDOW))
    enough = f"size(_w) >= {WINDOW}"
    places = f"sequence(0, size(_w) - {WINDOW})"
    stop_words = ", ".join(f"'{w}'" for w in STOP_WORDS)
    source = F.coalesce(docs[text].cast("string"), F.lit(""))
    row = F.struct(*(docs[c] for c in docs.columns if c != "measures"))
    wide = docs.select(row.alias("_row"), source.alias("_t"), words_of(source).alias("_w"))
    wide = wide.withColumn("_mask", F.expr("shiftleft(-1L, length(bin(size(_w))))"))
    wide = wide.withColumn(
        "_keys", F.expr(f"IF({enough}, sort_array(transform({places}, i -> (xxhash64({window}) & _mask) | i)), array())")
    )
    wide = wide.withColumn(
        "_marks", F.expr(_marks("_keys", "(x & _mask) != (get(_keys, j - 1) & _mask)", same_here))
    )
    wide = wide.withColumn(
        "_grams",
        F.expr(
            f"IF(array_contains(_marks, 2), sort_array(transform({places}, i -> named_struct({gram}, 'i', i))), NULL)"
        ),
    )
    wide = wide.withColumn("_exact", F.expr(_marks("_grams", "false", same_words).replace("ELSE 2", "ELSE 0")))
    wide = wide.withColumn("_short", F.filter("_w", lambda w: w.rlike(SHORT_WORD)))
    wide = wide.withColumn("_lines", F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD_CLASS)))
    counts = {
        "one": F.lit(1).cast("bigint"),
        "n_words": F.size("_w").cast("bigint"),
        "word_chars": F.length(F.array_join("_w", "")).cast("bigint"),
        "n_symbols": (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("bigint"),
        "n_lines": F.size("_lines").cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "n_repeat_words": F.expr(
            f"CASE WHEN _grams IS NOT NULL THEN {_covered('_grams', 'x.i', '_exact')}"
            f" WHEN array_contains(_marks, 1) THEN {_covered('_keys', at, '_marks')} ELSE 0L END"
        ),
        "n_function_words": F.greatest(
            F.expr(f"size(filter(_w, w -> lower(w) IN ({stop_words})))"), F.size("_short") - F.size(F.array_distinct("_short"))
        ).cast("bigint"),
        "n_shouted": F.size(F.filter("_w", lambda w: w.rlike(CAPITAL) & ~w.rlike(SMALL) & (F.length(w) > 1))).cast("bigint"),
    }
    # A generator, so that a filter on a measure stays above it and measures nothing twice.
    measured = F.explode(F.array(F.struct(*(c.alias(n) for n, c in counts.items()))))
    return wide.select("_row", measured.alias("measures")).select("_row.*", "measures")


def holds(rule: Rule) -> Column:
    part, whole = F.col(f"measures.{rule.part}"), F.col(f"measures.{rule.whole}")
    checks = [rule.low * whole <= 100 * part] if rule.low is not None else []
    checks += [100 * part <= rule.high * whole] if rule.high is not None else []
    out = checks[0]
    for check in checks[1:]:
        out = out & check
    return out


def judged(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """``docs`` with ``measures``, ``base_failed``, ``kept`` and ``failed_rules`` (names, in the table's order)."""
    everything = [*BASE_RULES, *rules]
    base_failed = ~(holds(BASE_RULES[0]) & holds(BASE_RULES[1]))
    failed = F.filter(F.array(*(F.when(~holds(r), F.lit(r.name)) for r in everything)), lambda x: x.isNotNull())
    return (
        measures(docs, text)
        .withColumn("base_failed", base_failed)
        .withColumn("failed_rules", failed)
        .withColumn("kept", F.size("failed_rules") == 0)
    )
