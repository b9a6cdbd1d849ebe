"""Boolean flags and buckets. None of them is ever NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flightmarts.constants import AIRPORT_CODES, NIGHT_PERIOD, ON_TIME_MINUTES, TIME_PERIODS


def is_status(status: Column, code: str) -> Column:
    return F.coalesce(status == code, F.lit(False))


def is_listed_airport(iata: Column) -> Column:
    return F.coalesce(iata.isin(AIRPORT_CODES), F.lit(False))


def is_on_time(delay_minutes: Column) -> Column:
    """Early counts as on time; a missing delay does not."""
    return F.coalesce(delay_minutes <= ON_TIME_MINUTES, F.lit(False))


def time_period(hour: Column) -> Column:
    """Part of the day; a missing hour falls into the night."""
    bucket = F
    for first, last, label in TIME_PERIODS:
        bucket = bucket.when(hour.between(first, last), F.lit(label))
    return bucket.otherwise(F.lit(NIGHT_PERIOD))
