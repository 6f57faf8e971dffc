"""Column expressions used by more than one operator.

Money and scores arrive as DOUBLE. A sum of doubles depends on the order in which
partitions arrive, so a retried task may change the last digits, and with them a
rounded result. Sums are therefore taken in fixed point: each value becomes a
whole number of small units, and the units are added as two BIGINT halves. Both
halves stay in generated code and the total cannot overflow in practice.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_SCALE = 4  # no ISO 4217 currency has more decimals
SCORE_SCALE = 9

_HALF_BITS = 20

# Account number format and masks of personal data.
ACCOUNT_PATTERN = r"^ACC-TH-\d{8}$"
ACCOUNT_IN_TEXT = r"(?i)acc[-\s_]?th[-\s_]?(\d{8})"
NATIONAL_ID_MASK = r"^X-XXXX-XXXXX-XX-\d$"
PHONE_MASK = r"^\+66-XX-XXX-\d{4}$"
EMAIL_MASK = r"@example\.invalid$"
CUSTOMER_ID_PREFIX = "CUST-DEMO-"


# Digits kept below a column's own scale, and the largest number of units that fits the exact sums.
_FINE_DIGITS = 9
_MOST_UNITS = float(1 << 62)


def _parts(column: str, scale: int) -> tuple[Column, Column, Column, Column]:
    """Sums that add up to the total: upper and lower halves in units of ``10**-scale``, what is finer, what does not fit.

    Values beyond the range of the units, and NaN or infinite ones, are added as doubles,
    so that no value stops a job. Digits below a unit count unless they are mere noise of
    the binary representation.
    """
    scaled = F.col(column) * F.lit(float(10**scale))
    fits = (F.abs(scaled) < _MOST_UNITS) & ~F.isnan(scaled)
    whole = F.rint(F.when(fits, scaled))
    units = whole.cast("bigint")
    rest = F.when(fits, scaled) - whole
    noise = F.abs(whole) * 1e-14 + 1e-6
    fine = F.when(F.abs(rest) > noise, F.rint(rest * float(10**_FINE_DIGITS)).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    lower = units.bitwiseAND(F.lit((1 << _HALF_BITS) - 1).cast("bigint"))
    return F.sum(F.shiftright(units, _HALF_BITS)), F.sum(lower), F.sum(fine), F.sum(F.when(~fits, F.col(column)))


def exact_total(column: str, scale: int = MONEY_SCALE) -> Column:
    """Order-independent sum of a DOUBLE column, as DECIMAL; can be summed further without loss.

    Values that do not fit the units are added as doubles; NULL if a decimal cannot hold them.
    """
    upper, lower, fine, large = _parts(column, scale)
    units = F.coalesce(upper.cast("decimal(19,0)") * F.lit(1 << _HALF_BITS) + lower.cast("decimal(19,0)"), F.lit(Decimal(0)))
    total = units * F.lit(Decimal(1).scaleb(-scale)) + F.coalesce(fine, F.lit(0)).cast("decimal(19,0)") * F.lit(
        Decimal(1).scaleb(-scale - _FINE_DIGITS)
    )
    with_large = F.when(large.isNull(), total).otherwise(total + large.try_cast("decimal(38,4)"))
    return F.when(F.count(F.col(column)) > 0, with_large)


def exact_sum(column: str, scale: int = MONEY_SCALE) -> Column:
    """Order-independent sum as DOUBLE, without a decimal per group.

    The nearest double of the exact total as long as that has fewer than 2**53
    units, and within two rounding steps of it beyond.
    """
    upper, lower, fine, large = _parts(column, scale)
    units = (upper.cast("double") * F.lit(float(1 << _HALF_BITS)) + lower.cast("double")) / F.lit(float(10**scale))
    small = F.coalesce(fine, F.lit(0)).cast("double") / F.lit(float(10 ** (scale + _FINE_DIGITS)))
    total = F.coalesce(units, F.lit(0.0)) + small + F.coalesce(large, F.lit(0.0))
    return F.when(F.count(F.col(column)) > 0, total)


def exact_mean(column: str, scale: int = MONEY_SCALE) -> Column:
    """Order-independent mean; NULL where there is no value."""
    return F.try_divide(exact_sum(column, scale), F.count(F.col(column)))


def rounded(value: Column, digits: int) -> Column:
    """Half-up rounding on the decimal value, so that ties fall the same way everywhere."""
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def money(total: Column) -> Column:
    return F.round(total, 2).cast("double")


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole; NULL for an empty whole."""
    return rounded(F.try_divide(F.lit(100.0) * part, whole), digits)


def is_account(column: Column) -> Column:
    return column.rlike(ACCOUNT_PATTERN)


def canonical_account(text: Column) -> Column:
    """The first account number mentioned in a text, rebuilt from its digits, or NULL."""
    digits = F.regexp_extract(text, ACCOUNT_IN_TEXT, 1)
    return F.when(digits != "", F.concat(F.lit("ACC-TH-"), digits))


def shard_of(key: Column, shards: int) -> Column:
    """A stable shard number in ``0..shards-1``, the same in every SQL engine with MD5."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), F.lit(shards))


def start_of(unit: str, column: str, kind: str) -> Column:
    """``date_trunc`` that keeps the column's own timestamp type."""
    return F.date_trunc(unit, F.col(column)).cast(kind)


def desc(*columns: str) -> list[Column]:
    """Descending sort keys, NULLs last."""
    return [F.col(c).desc_nulls_last() for c in columns]


def asc(*columns: str) -> list[Column]:
    """Ascending sort keys, NULLs last (Spark's own default is first)."""
    return [F.col(c).asc_nulls_last() for c in columns]
