"""Calendar and clock expressions. All take and return columns in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flightmarts.constants import MONTHS, WEEKDAYS

MICROS_PER_MINUTE = 6e7


def minutes_between(later: Column, earlier: Column) -> Column:
    """Signed, fractional minutes; NULL when either side is NULL."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(MICROS_PER_MINUTE)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("long")


def iso_weekday(ts: Column) -> Column:
    """1 = Monday … 7 = Sunday."""
    return (F.weekday(ts) + 1).cast("long")


def _pick(names: list[str], position: Column) -> Column:
    # A constant array is indexed far faster than a date pattern is formatted,
    # and does not depend on the JVM's locale.
    return F.get(F.array(*[F.lit(n) for n in names]), position)


def day_name(ts: Column) -> Column:
    return _pick(WEEKDAYS, F.weekday(ts))


def day_name_short(ts: Column) -> Column:
    return _pick([n[:3] for n in WEEKDAYS], F.weekday(ts))


def month_name(ts: Column) -> Column:
    return _pick(MONTHS, F.month(ts) - 1)


def month_name_short(ts: Column) -> Column:
    return _pick([n[:3] for n in MONTHS], F.month(ts) - 1)


def date_key(ts: Column) -> Column:
    """Day as an integer, 2026-01-25 → 20260125."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)
