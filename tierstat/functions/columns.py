"""Column expressions shared by the operators (all JVM-side, no UDFs)."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_long(c: str | Column) -> Column:
    """Text to bigint the way a non-ANSI cast reads it: '12.0' -> 12, 'x' -> null.

    Whole numbers are read exactly; only other texts, for which
    ``try_cast('12.0' as bigint)`` is null, go through double, and their
    fraction is dropped: counts are whole.
    """
    number = col_of(c).try_cast("double")
    # A cast of 2**63 would give the largest bigint instead of null.
    truncated = F.when(number < F.lit(float(1 << 63)), number.try_cast("bigint"))
    return F.coalesce(col_of(c).try_cast("bigint"), truncated)


def lenient_double(c: str | Column) -> Column:
    return col_of(c).try_cast("double")


def sum_columns(columns: list[str | Column]) -> Column:
    """Row-wise sum by folding ``+``; null if any input is null."""
    if not columns:
        raise ValueError("sum_columns needs at least one column")
    return reduce(add, [col_of(c) for c in columns])


def percent(numer: str | Column, denom: str | Column, digits: int = 3) -> Column:
    """``round(numer / denom * 100, digits)``, HALF_UP; null on a zero or null denominator."""
    return F.round(F.try_divide(col_of(numer), col_of(denom)) * F.lit(100), digits)


def format_thousands(c: str | Column) -> Column:
    """Whole number with thousands separators; fractions are truncated first.

    A value that is not a finite number in bigint range gives null, not an error.
    """
    return F.format_number(col_of(c).try_cast("bigint"), 0)


def format_percent(c: str | Column) -> Column:
    """The value as text followed by ``%``; null stays null."""
    return F.concat(col_of(c).cast("string"), F.lit("%"))


def ordinal(n: int) -> str:
    """1 -> '1st', 2 -> '2nd', 11 -> '11th', 23 -> '23rd'."""
    if 10 <= n % 100 <= 20:
        suffix = "th"
    else:
        suffix = {1: "st", 2: "nd", 3: "rd"}.get(n % 10, "th")
    return f"{n}{suffix}"
