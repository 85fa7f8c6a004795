"""Scalar column expressions. All stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_days(end: Column, start: Column) -> Column:
    """Calendar days from ``start`` to ``end``; the time of day does not count."""
    return F.datediff(end.cast("date"), start.cast("date"))


def at_least_zero(value: Column) -> Column:
    """Clip below at 0, keeping NULL (``greatest`` alone would turn NULL into 0)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0)))


def is_value(column: Column, value: str) -> Column:
    """``column = value`` where NULL is plainly "no"."""
    return F.coalesce(column == value, F.lit(False))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, part / whole).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """Percentage to one decimal, halves to even."""
    return half_even(part / whole * 100, 1)


def half_even(value: Column, places: int) -> Column:
    """Round a double as array libraries do: scale, nearest even integer, scale back."""
    return F.rint(value * 10.0**places) / 10.0**places


def headline(text: Column) -> Column:
    """The part of an action before its first `` - ``."""
    return F.split_part(text, F.lit(" - "), F.lit(1))


def pairs(n: Column) -> Column:
    """Unordered pairs among ``n`` rows, as a double so that large counts cannot overflow."""
    n = n.cast("double")
    return n * (n - 1) / 2
