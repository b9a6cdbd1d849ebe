"""Daily states of the marts' statistics that can be added up over any period.

A median or a distinct count of a longer period does not follow from those of its
days. What follows is kept instead: how often each value occurs in a cell
(``tally_*``), and which airlines do, a bit each (``state_*``). Both are summed or
or-ed over days without touching a flight again, and stay exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightmarts.constants import ARRIVAL
from flightmarts.functions import surrogate_key
from flightmarts.operators.star import at_listed_airports, at_own_airport

DAY = "flight_date_key"
HOUR_CELL = ["airport_iata", DAY, "flight_hour", "flight_type"]
ROUTE_CELL = [
    "origin_airport_iata", "destination_airport_iata", "route_key", "flight_type", "is_domestic", DAY,
]
BAGGAGE_CELL = ["airport_iata", "baggage_claim_unit", "is_domestic", DAY, "flight_hour"]
DELAY_COUNTS = ["total_flights", "cancelled_flights", "completed_flights", "within_limit_flights"]
_BITS = 64  # airlines per word of a state


def is_flown() -> Column:
    return F.col("actual_time_utc").isNotNull()


def is_active() -> Column:
    return ~F.col("is_deleted")


def flown_delay() -> Column:
    """Delay of flights with an actual time, else NULL."""
    return F.when(is_flown(), F.col("delay_minutes"))


def on_a_day(flights: DataFrame) -> DataFrame:
    """Flights without a scheduled time belong to no day and so to no period."""
    return flights.filter(F.col(DAY).isNotNull())


def delay_tally(fact: DataFrame, key: str, at: Column) -> DataFrame:
    """Flights counted per cell *and delay*; a cell is ``at`` (named ``key``), day, direction, domestic."""
    return on_a_day(fact).groupBy(
        at.alias(key), DAY, "flight_type", "is_domestic", flown_delay().alias("delay")
    ).agg(
        F.count_if(is_active()).alias("total_flights"),
        F.count_if("is_cancelled").alias("cancelled_flights"),
        F.count_if(is_flown()).alias("completed_flights"),
        F.count_if(F.col("is_on_time") & is_flown()).alias("within_limit_flights"),
    )


def airport_delays(fact: DataFrame) -> DataFrame:
    """Delays at the covered airports."""
    return delay_tally(at_own_airport(fact), "airport_iata", F.col("airport_iata"))


def airline_delays(fact: DataFrame) -> DataFrame:
    """Delays of the airlines; flights without one are left out."""
    flown_by = fact.filter(F.col("airline_key") != surrogate_key(F.lit(None)))
    return delay_tally(flown_by, "airline_key", F.col("airline_key"))


def baggage(fact: DataFrame) -> DataFrame:
    """Arrivals with a known carousel, per cell, handling minutes and delay."""
    minutes = F.col("baggage_handling_minutes")
    arrivals = on_a_day(fact).filter((F.col("flight_type") == ARRIVAL) & F.col("baggage_claim_unit").isNotNull())
    return (
        at_listed_airports(arrivals, "destination_airport_iata")
        .withColumnRenamed("destination_airport_iata", "airport_iata")
        .groupBy(
            *BAGGAGE_CELL,
            minutes.alias("handling"),
            F.when(minutes.isNotNull(), F.col("delay_minutes")).alias("delay"),
        )
        .agg(F.count("*").alias("flights"))
    )


def new_airlines(fact: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Numbers, from 0 or behind the ``known`` ones, of airlines that have none yet.

    A number never changes, so that states of other days stay valid. The flights
    without an airline count as one. Airlines are a dimension: that their keys
    meet in one task to be numbered does not grow with the flights.
    """
    airlines = fact.select("airline_key").distinct()
    if known is None:
        known = airlines.limit(0).withColumn("number", F.lit(None).cast("long"))
    # Known numbers run from 0 without a gap, so that the places of all others go on behind them.
    order = Window.orderBy(F.asc_nulls_last("number"), "airline_key")
    numbered = known.join(airlines, "airline_key", "full").withColumn("nth", F.row_number().over(order) - 1)
    return numbered.filter("number IS NULL").select("airline_key", F.col("nth").cast("long").alias("number"))


def _airlines_in(flights: DataFrame, cell: list[str], numbers: DataFrame) -> DataFrame:
    """Airlines of each cell as bits, ``_BITS`` to a ``word``; each airline of a cell is looked up once."""
    present = on_a_day(flights).select(*cell, "airline_key").distinct().join(numbers, "airline_key")
    bit = F.expr(f"shiftleft(1L, CAST(number % {_BITS} AS INT))")
    return present.groupBy(*cell, F.floor(F.col("number") / _BITS).alias("word")).agg(
        F.bit_or(bit).alias("bits")
    )


def hourly_airlines(fact: DataFrame, numbers: DataFrame) -> DataFrame:
    return _airlines_in(at_own_airport(fact), HOUR_CELL, numbers)


def route_airlines(fact: DataFrame, numbers: DataFrame) -> DataFrame:
    listed = at_listed_airports(fact, "origin_airport_iata", "destination_airport_iata")
    return _airlines_in(listed, ROUTE_CELL, numbers)
