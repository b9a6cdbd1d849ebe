"""Questions by attributes of the dimensions: joins that prune the fact's folders.

The stored fact lies in a folder per day, named by its date key. A condition on
the calendar (a week, weekends, holidays) selects keys at run time, and Spark
then opens these days' folders only (dynamic partition pruning). Calendar,
holidays and airports have a fixed number of rows, so they are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightmarts.constants import ARRIVAL
from flightmarts.functions import percent, round2
from flightmarts.operators.star import own_airport
from flightmarts.plans.tallies import flown_delay, is_active, is_flown


def on_days(fact: DataFrame, days: DataFrame) -> DataFrame:
    """Flights of the given calendar days, with the days' columns; others drop out."""
    return fact.join(F.broadcast(days), fact["flight_date_key"] == days["date_key"])


def at_airport(flights: DataFrame, dim_airport: DataFrame, key: Column) -> DataFrame:
    """Flights with the airport in a role, ``key`` being its key; airports not covered drop out."""
    return flights.withColumn("airport_key", key).join(F.broadcast(dim_airport), "airport_key")


def both_airports(flights: DataFrame, dim_airport: DataFrame) -> DataFrame:
    """Flights with the names of both ends; null where an end is not covered."""
    for role, key in (("origin", "origin_airport_key"), ("destination", "dest_airport_key")):
        names = dim_airport.select(
            F.col("airport_key").alias(key), F.col("airport_name").alias(f"{role}_airport_name")
        )
        flights = flights.join(F.broadcast(names), key, "left")
    return flights


def _own_key() -> Column:
    return own_airport("dest_airport_key", "origin_airport_key")


def week_punctuality(
    fact: DataFrame, dim_date: DataFrame, dim_airport: DataFrame, year: int, week: int
) -> DataFrame:
    """Airport, weekday and direction in one ISO week of a calendar year."""
    days = dim_date.filter((F.col("year") == year) & (F.col("week_number") == week))
    flights = at_airport(on_days(fact, days), dim_airport, _own_key())
    return flights.groupBy("airport_iata", "airport_name", "day_of_week", "day_name", "flight_type").agg(
        F.count_if(is_active()).alias("total_flights"),
        F.count_if(is_flown()).alias("completed_flights"),
        round2(F.avg(flown_delay())).alias("avg_delay_minutes"),
        percent(F.count_if(F.col("is_on_time") & is_flown()), F.count_if(is_flown())).alias(
            "on_time_percentage"
        ),
    )


def weekend_baggage(
    fact: DataFrame, dim_date: DataFrame, dim_airport: DataFrame, year: int, month: int
) -> DataFrame:
    """Airport, carousel and weekend day of one month; arrivals with a known carousel."""
    days = dim_date.filter("is_weekend").filter((F.col("year") == year) & (F.col("month") == month))
    arrivals = fact.filter((F.col("flight_type") == ARRIVAL) & F.col("baggage_claim_unit").isNotNull())
    flights = at_airport(on_days(arrivals, days), dim_airport, F.col("dest_airport_key"))
    return flights.groupBy("airport_iata", "airport_name", "baggage_claim_unit", "date_day", "week_number").agg(
        F.count("*").alias("total_arrivals"),
        F.count("baggage_handling_minutes").alias("flights_with_baggage_data"),
        round2(F.avg("baggage_handling_minutes")).alias("avg_baggage_handling_minutes"),
    )


def holiday_traffic(
    fact: DataFrame, holidays: DataFrame, dim_date: DataFrame, dim_airport: DataFrame, year: int
) -> DataFrame:
    """Active flights per airport on each holiday of a year, beside plain days of its month.

    ``usual_flights`` is the mean of the same weekday in the same month without
    holidays, null if there is none with flights.
    """
    named = dim_date.join(F.broadcast(holidays), "date_key", "left")
    months = dim_date.join(F.broadcast(holidays), "date_key").filter(F.col("year") == year)
    months = months.select("year", "month").distinct()
    days = named.join(F.broadcast(months), ["year", "month"])
    flights = at_airport(on_days(fact.filter(is_active()), days), dim_airport, _own_key())
    per_day = flights.groupBy(
        "airport_iata", "airport_name", "month", "day_of_week", "date_day", "holiday_name"
    ).agg(F.count("*").alias("flight_count"))
    usual = (
        per_day.filter("holiday_name IS NULL").groupBy("airport_iata", "month", "day_of_week")
        .agg(round2(F.avg("flight_count")).alias("usual_flights"))
    )
    return (
        per_day.filter("holiday_name IS NOT NULL")
        .join(usual, ["airport_iata", "month", "day_of_week"], "left")
        .select("airport_iata", "airport_name", "holiday_name", "date_day", "flight_count", "usual_flights")
    )


def named_routes(
    fact: DataFrame, dim_date: DataFrame, dim_airport: DataFrame, year: int, quarter: int
) -> DataFrame:
    """Flights and cancellations per route with the names of both ends, in one quarter."""
    days = dim_date.filter((F.col("year") == year) & (F.col("quarter") == quarter))
    flights = both_airports(on_days(fact, days), dim_airport).filter(
        F.col("origin_airport_name").isNotNull() & F.col("destination_airport_name").isNotNull()
    )
    return flights.groupBy("route_key", "origin_airport_name", "destination_airport_name").agg(
        F.count_if(is_active()).alias("flight_count"),
        F.count_if("is_cancelled").alias("cancelled_flights"),
        percent(F.count_if("is_cancelled"), F.count_if(is_active())).alias("cancellation_ratio"),
    )
