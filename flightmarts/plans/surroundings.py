"""Flights beside what surrounds them: weather, alliances, local time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightmarts.constants import LOCAL_ZONE, NIGHT_HOURS
from flightmarts.functions import percent, round2
from flightmarts.operators.asof import last_known, merged_spans, within_spans
from flightmarts.operators.star import at_own_airport
from flightmarts.plans.tallies import flown_delay, is_active, is_flown

MAX_AGE = 3 * 3600  # seconds an observation is good for
_MICROS = 60_000_000.0


def _counts() -> list[Column]:
    late = F.sum(F.round(flown_delay() * _MICROS).cast("long"))
    return [
        F.count_if(is_active()).alias("total"), F.count_if("is_cancelled").alias("cancelled"),
        F.count_if(is_flown()).alias("flown"), F.count_if(F.col("is_on_time") & is_flown()).alias("punctual"),
        late.alias("late"),
    ]


def _summed() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("total", "cancelled", "flown", "punctual", "late")]


def _figures() -> list[Column]:
    return [
        F.col("total").alias("total_flights"), F.col("cancelled").alias("cancelled_flights"),
        F.col("flown").alias("completed_flights"),
        round2(F.col("late") / _MICROS / F.nullif("flown", F.lit(0))).alias("avg_delay_minutes"),
        percent(F.col("punctual"), F.col("flown")).alias("on_time_percentage"),
    ]


# ---------------------------------------------------------------- weather


def weather_per_time(fact: DataFrame, weather: DataFrame, max_age: int = MAX_AGE) -> DataFrame:
    """Flights counted per covered airport and scheduled time, with the weather known then.

    ``weather`` has ``airport_iata, observed_at, condition, wind``. Flights are
    counted before the weather is looked up, so a busy hour is a few cells.
    """
    timed = at_own_airport(fact).filter(F.col("scheduled_time_utc").isNotNull())
    cells = timed.groupBy("airport_iata", "scheduled_time_utc").agg(*_counts())
    return last_known(
        cells, weather, ["airport_iata"], "scheduled_time_utc", "observed_at", ["condition", "wind"], max_age
    )


def weather_punctuality(fact: DataFrame, weather: DataFrame, max_age: int = MAX_AGE) -> DataFrame:
    """Punctuality per airport and condition; ``unknown`` where nothing recent was observed."""
    condition = F.coalesce("condition", F.lit("unknown")).alias("condition")
    return (
        weather_per_time(fact, weather, max_age).groupBy("airport_iata", condition).agg(*_summed())
        .select("airport_iata", "condition", *_figures())
    )


def windy_hours(fact: DataFrame, weather: DataFrame, limit: float, max_age: int = MAX_AGE) -> DataFrame:
    """Per airport: flights in wind of at least ``limit``, in less, and without a recent observation."""
    wind = F.when(F.col("wind") >= limit, "strong").when(F.col("wind") < limit, "light").otherwise("unknown")
    return (
        weather_per_time(fact, weather, max_age).groupBy("airport_iata", wind.alias("wind_class"))
        .agg(*_summed()).select("airport_iata", "wind_class", *_figures())
    )


# ---------------------------------------------------------------- alliances


def alliance_punctuality(fact: DataFrame, dim_airline: DataFrame, members: DataFrame) -> DataFrame:
    """Punctuality per alliance group and month, over the airlines in it *on the day*.

    ``members`` is a bridge ``alliance, airline_iata, valid_from, valid_before``
    (days; null: no end): an airline may be in several groups, leave and return.
    Memberships that overlap count a flight once per group, and airlines are
    counted that flew as members. Flights are counted per airline and day first;
    those without an airline or a day are in no group.
    """
    day = F.col("flight_date").cast("date")
    cells = (
        fact.filter(F.col("flight_date").isNotNull())
        .groupBy("airline_key", day.alias("day")).agg(*_counts())
    )
    codes = dim_airline.select("airline_key", "airline_iata").distinct()
    spans = merged_spans(members, ["alliance", "airline_iata"], "valid_from", "valid_before")
    # No span without an end needs bins beyond the calendar.
    counted = within_spans(
        cells.join(codes, "airline_key"), spans, ["airline_iata"], "day", "valid_from", "valid_before",
        F.lit("2031-01-01"),
    )
    per_airline = counted.groupBy(
        "alliance", F.trunc("day", "month").cast("timestamp").alias("flight_month"), "airline_iata"
    ).agg(*_summed())
    return (
        per_airline.groupBy("alliance", "flight_month").agg(*_summed(), F.count("*").alias("airlines"))
        .select("alliance", "flight_month", "airlines", *_figures())
    )


# ---------------------------------------------------------------- local time


def with_local_time(flights: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Adds ``local_date, local_hour, utc_offset_minutes`` and ``hour_pass`` of the scheduled time.

    Where clocks go back, an hour of the day comes twice: ``hour_pass`` is 2 for
    the second one and 1 at all other times. Where they go forward no flight falls
    on the missing hour. All are null for flights without a scheduled time.
    """
    utc = F.col("scheduled_time_utc")
    local = F.from_utc_timestamp(utc, zone)
    earlier = F.from_utc_timestamp(utc - F.expr("INTERVAL 1 HOUR"), zone)
    same_hour = F.date_trunc("hour", local) == F.date_trunc("hour", earlier)
    return flights.withColumns(
        {
            "local_date": F.date_trunc("day", local),
            "local_hour": F.hour(local).cast("long"),
            "utc_offset_minutes": F.floor((F.unix_micros(local) - F.unix_micros(utc)) / _MICROS),
            "hour_pass": F.when(utc.isNotNull(), F.when(same_hour, 2).otherwise(1)).cast("long"),
        }
    )


def local_hourly_traffic(fact: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Covered airport, local day, local hour and direction; both passes of a repeated hour apart."""
    local = with_local_time(at_own_airport(fact).filter(F.col("scheduled_time_utc").isNotNull()), zone)
    cell = ["airport_iata", "local_date", "local_hour", "hour_pass", "utc_offset_minutes", "flight_type"]
    return local.groupBy(*cell).agg(*_counts()).select(*cell, *_figures())


def night_movements(fact: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Movements per airport and local month in the night hours of the local clock, and their share.

    A flight in the night moves when it actually does; one that has not moved, or
    is deleted or cancelled, is no movement.
    """
    moved = at_own_airport(fact).filter(is_active() & ~F.col("is_cancelled") & is_flown())
    local = F.from_utc_timestamp("actual_time_utc", zone)
    first, last = NIGHT_HOURS
    night = (F.hour(local) >= first) | (F.hour(local) <= last)
    return (
        moved.groupBy("airport_iata", F.date_trunc("month", local).alias("local_month"))
        .agg(F.count("*").alias("movements"), F.count_if(night).alias("night_movements"))
        .withColumn("night_percentage", percent(F.col("night_movements"), F.col("movements")))
    )
