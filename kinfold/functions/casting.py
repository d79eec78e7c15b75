"""Tolerant casts and IEEE-exact rounding (SURVEY types table, quirks Q3 and Q15)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: Column | str) -> Column:
    """Accept a column name (dots allowed) or a Column."""
    if isinstance(c, Column):
        return c
    return F.col(f"`{c}`")


def safe_double(c: Column | str) -> Column:
    """Text or number -> double; '' and junk -> NULL (no ANSI error)."""
    return F.try_cast(col_of(c), "double") if hasattr(F, "try_cast") else col_of(c).try_cast("double")


def safe_int(c: Column | str) -> Column:
    """R ``as.integer``: '12.7' -> 12, '' -> NULL, overflow -> NULL.

    A direct string -> int cast would give NULL for '12.7', so the value goes through double first and is
    truncated toward zero by the second cast.
    """
    return safe_double(c).try_cast("int")


def safe_divide(num: Column, den: Column) -> Column:
    """Division that yields NULL for a zero divisor (R gives Inf/NaN, quirk Q15)."""
    return F.try_divide(num, den)


def round_half_away(c: Column, digits: int) -> Column:
    """sign(x) * floor(|x| * 10^d + 0.5) / 10^d.

    Written with plain IEEE operations so that any SQL engine computing the same expression gets the same
    double; used before numbers are printed as text.
    """
    scale = float(10 ** digits)
    return F.signum(c) * F.floor(F.abs(c) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
