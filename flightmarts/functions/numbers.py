"""Rounding and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round2(x: Column) -> Column:
    """Two digits, halves away from zero, decided on the binary value times 100.

    ``F.round`` decides on the shortest decimal text instead, so that 1.005
    becomes 1.01; the results to match have 1.0 there.
    """
    return F.signum(x) * F.floor(F.abs(x) * 100.0 + 0.5) / 100.0


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, two digits; NULL when ``whole`` is 0."""
    return round2(part * F.lit(100.0) / F.nullif(whole, F.lit(0)))
