"""Money: parsing, order-independent totals, exact ratios.

A plain ``sum`` over doubles depends on the order in which partial sums meet,
so two runs of one job can differ in the last digits. Amounts are therefore
summed as whole cents in decimals: every partial sum is exact at any size, and
only the result becomes a double again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_money(raw: Column | str) -> Column:
    """Parse as double, two decimals half up; what is no finite number gives NULL.

    A value that already is the double of a two-decimal number is its own
    rounding, and skips the far slower general case.
    """
    column = F.col(raw) if isinstance(raw, str) else raw
    value = column.try_cast("double")
    two_decimals = F.rint(value * F.lit(100.0)) / F.lit(100.0) == value
    finite = F.abs(value) < F.lit(float("inf"))
    return F.when(finite & two_decimals, value).when(finite, F.round(value, 2))


CENTS = "decimal(28,0)"
CENT_SUMS = "decimal(38,0)"


def to_cents(amount: Column | str) -> Column:
    """Amount in whole cents; NULL for what is not finite or has more than 26 digits."""
    column = F.col(amount) if isinstance(amount, str) else amount
    return F.rint(column * F.lit(100.0)).try_cast(CENTS)


def from_cents(cents: Column | str) -> Column:
    """Cents, or a sum of them, to the nearest double amount."""
    column = F.col(cents) if isinstance(cents, str) else cents
    return (column.cast(CENT_SUMS) / F.lit(100)).cast("double")


def money_per(cents: Column, units: Column) -> Column:
    """``cents / units`` as money rounded half up to two decimals; NULL for zero units.

    Takes non-negative cents and works on whole numbers, so the result is rounded once.
    """
    whole = F.nullif(units.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    doubled = cents.cast("decimal(36,0)") * F.lit(2)
    return from_cents(F.call_function("div", doubled + whole, whole * F.lit(2)))


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` rounded half up to two decimals; NULL for a zero whole.

    Takes non-negative decimals with two places and works on whole numbers, so
    the result is rounded once.
    """
    part_cents = (part * F.lit(100)).cast("decimal(30,0)")
    whole_cents = F.nullif((whole * F.lit(100)).cast("decimal(30,0)"), F.lit(0).cast("decimal(30,0)"))
    hundredths = F.call_function("div", part_cents * F.lit(20_000) + whole_cents, whole_cents * F.lit(2))
    return (hundredths.cast("decimal(16,0)") / F.lit(100)).cast("decimal(18,2)")
