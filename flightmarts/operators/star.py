"""Star-schema helpers shared by the marts.

The marts aggregate the fact by its keys first and look airlines up on the
aggregated rows: same rows as joining first, but the joins see cells
instead of flights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightmarts.constants import (
    AIRPORT_CODES,
    ARRIVAL,
    CALENDAR_FIRST_DAY,
    CALENDAR_LAST_DAY,
    DEPARTURE,
)

PERIOD_COLUMNS = [
    "flight_date", "flight_week", "flight_month", "flight_year", "week_number", "month_number",
]


def own_airport(at_destination: str, at_origin: str) -> Column:
    """The airport a flight is counted at: where it arrives or departs."""
    kind = F.col("flight_type")
    return F.when(kind == ARRIVAL, F.col(at_destination)).when(kind == DEPARTURE, F.col(at_origin))


def other_airport(at_destination: str, at_origin: str) -> Column:
    """The airport at the far end."""
    return own_airport(at_origin, at_destination)


def with_periods(cells: DataFrame) -> DataFrame:
    """Adds day, week, month and year; cells without a day on the calendar drop out.

    All of them follow from the day, so they are computed and not looked up; the
    calendar's first and last day are those of ``dim_date``. A comparison of the
    date key can reach the scan and prune its folders.
    """
    key, day = F.col("flight_date_key"), F.col("flight_date")
    date = F.make_date(F.floor(key / 10000).cast("int"), F.floor(key / 100).cast("int") % 100, key % 100)
    first, last = (int(d.replace("-", "")) for d in (CALENDAR_FIRST_DAY, CALENDAR_LAST_DAY))
    dated = cells.filter(key.between(first, last)).withColumn("flight_date", date.cast("timestamp"))
    return dated.withColumns(
        {
            "flight_week": F.date_trunc("week", day),
            "flight_month": F.date_trunc("month", day),
            "flight_year": F.year(day).cast("long"),
            "week_number": F.weekofyear(day).cast("long"),
            "month_number": F.month(day).cast("long"),
        }
    )


def at_listed_airports(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose airports are all among those covered; the test can reach a scan."""
    for column in columns:
        df = df.filter(F.col(column).isin(AIRPORT_CODES))
    return df


def at_own_airport(fact: DataFrame) -> DataFrame:
    """Flights counted at a covered airport, with its code as ``airport_iata``."""
    own = own_airport("destination_airport_iata", "origin_airport_iata")
    return fact.withColumn("airport_iata", own).filter(F.col("airport_iata").isin(AIRPORT_CODES))
