"""Dashboard questions, answered from the marts.

Longer periods add up counts and recompute ratios from the sums; medians,
percentiles and distinct counts of a mart cannot be combined, so no function
here returns one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightmarts.constants import ARRIVAL, DEPARTURE
from flightmarts.functions import percent
from flightmarts.operators.shares import share_of_total, top
from flightmarts.operators.stats import mean_of_rounded


def pick(
    mart: DataFrame,
    airports: list[str] | None = None,
    airlines: list[str] | None = None,
    flight_type: str | None = None,
    domestic: bool | None = None,
    year: int | None = None,
    week: int | None = None,
    month: dt.date | str | None = None,
    since: dt.date | str | None = None,
    until: dt.date | str | None = None,
    time_periods: list[str] | None = None,
    weekdays: list[int] | None = None,
    carousels: list[str] | None = None,
) -> DataFrame:
    """The dashboard's filters; those left out do not restrict."""

    def stamp(day: dt.date | str) -> Column:
        return F.lit(str(day)).cast("timestamp")

    one_of = {
        "airport_iata": airports,
        "airline_iata": airlines,
        "flight_type": None if flight_type is None else [flight_type],
        "is_domestic": None if domestic is None else [domestic],
        "flight_year": None if year is None else [year],
        "week_number": None if week is None else [week],
        "flight_time_period": time_periods,
        "flight_day_of_week": weekdays,
        "baggage_claim_unit": carousels,
    }
    for column, values in one_of.items():
        if values is not None:
            mart = mart.filter(F.col(column).isin(values))
    if month is not None:
        mart = mart.filter(F.col("flight_month") == stamp(month))
        if "month_key" in mart.columns:  # a stored mart: other months' folders stay unread
            mart = mart.filter(F.col("month_key") == str(month)[:7])
    if since is not None:
        mart = mart.filter(F.col("flight_date") >= stamp(since))
    if until is not None:
        mart = mart.filter(F.col("flight_date") <= stamp(until))
    return mart


def _sums(*names: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def _rate(part: str, whole: str, name: str) -> Column:
    return percent(F.col(part), F.col(whole)).alias(name)


def peak_hours(
    hourly_traffic: DataFrame, airport: str, month: dt.date | str, flight_type: str = ARRIVAL
) -> DataFrame:
    """Busiest hours of an airport in a month."""
    traffic = pick(hourly_traffic, airports=[airport], flight_type=flight_type, month=month)
    return (
        traffic.groupBy("flight_hour", "flight_time_period")
        .agg(*_sums("flight_count", "domestic_flights", "international_flights"))
        .orderBy(F.desc("flight_count"), "flight_hour")
    )


def domestic_comparison(
    airport_punctuality: DataFrame, airport: str, year: int, week: int
) -> DataFrame:
    """Domestic against international punctuality at an airport in a week."""
    chosen = pick(airport_punctuality, airports=[airport], year=year, week=week)
    sums = chosen.groupBy("is_domestic").agg(
        *_sums(
            "total_flights", "cancelled_flights", "completed_flights",
            "ahead_of_schedule_flights", "on_time_flights", "delayed_flights",
        )
    )
    return sums.select(
        "*",
        _rate("on_time_flights", "completed_flights", "on_time_percentage"),
        _rate("delayed_flights", "completed_flights", "delayed_percentage"),
        _rate("cancelled_flights", "total_flights", "cancelled_percentage"),
        _rate("completed_flights", "total_flights", "completion_rate"),
    ).orderBy("is_domestic")


def airline_comparison(
    airline_punctuality: DataFrame, airlines: list[str], month: dt.date | str
) -> DataFrame:
    """Punctuality of airlines side by side over a month."""
    chosen = pick(airline_punctuality, airlines=airlines, month=month)
    sums = chosen.groupBy("airline_iata", "airline_name").agg(
        *_sums(
            "total_flights", "on_time_flights", "delayed_flights", "early_flights",
            "cancelled_flights", "completed_flights",
        )
    )
    return sums.select(
        "*",
        _rate("on_time_flights", "completed_flights", "on_time_percentage"),
        _rate("delayed_flights", "completed_flights", "delayed_percentage"),
        _rate("early_flights", "completed_flights", "early_percentage"),
        _rate("cancelled_flights", "total_flights", "cancelled_percentage"),
    ).orderBy(F.desc("on_time_percentage"), "airline_iata", "airline_name")


def top_routes(
    route_popularity: DataFrame,
    airport: str,
    month: dt.date | str,
    flight_type: str = DEPARTURE,
    k: int = 10,
) -> DataFrame:
    """Busiest routes of an airport in a month."""
    routes = pick(route_popularity, airports=[airport], flight_type=flight_type, month=month)
    sums = routes.groupBy("route_key", "other_airport_iata").agg(
        *_sums("flight_count", "cancelled_flights")
    )
    return top(sums, k, "flight_count", ["route_key"])


def slowest_carousels(
    baggage_performance: DataFrame, airport: str, weekday: int, k: int = 3
) -> DataFrame:
    """Carousels with the longest mean handling time on an ISO weekday.

    The mart's means carry two digits, and so does the result.
    """
    chosen = pick(baggage_performance, airports=[airport], weekdays=[weekday])
    means = chosen.groupBy("baggage_claim_unit").agg(
        F.sum("flights_with_baggage_data").alias("flights"),
        mean_of_rounded("avg_baggage_handling_minutes", "flights_with_baggage_data").alias(
            "avg_baggage_handling_minutes"
        ),
    )
    means = means.filter(F.col("avg_baggage_handling_minutes").isNotNull())
    return top(means, k, "avg_baggage_handling_minutes", ["baggage_claim_unit"])


def traffic_share(
    hourly_traffic: DataFrame, month: dt.date | str | None = None
) -> DataFrame:
    """Each airport's part of all traffic."""
    sums = pick(hourly_traffic, month=month).groupBy("airport_iata").agg(*_sums("flight_count"))
    return sums.withColumn("percentage_of_traffic", share_of_total("flight_count")).orderBy(
        F.desc("flight_count"), "airport_iata"
    )


def trend(
    airport_punctuality: DataFrame,
    period: str = "flight_week",
    airports: list[str] | None = None,
) -> DataFrame:
    """Volume and punctuality per ``flight_week`` or ``flight_month``."""
    sums = (
        pick(airport_punctuality, airports=airports)
        .groupBy(period)
        .agg(
            *_sums("total_flights", "cancelled_flights", "completed_flights", "on_time_flights")
        )
    )
    return sums.select(
        "*",
        _rate("on_time_flights", "completed_flights", "on_time_percentage"),
        _rate("cancelled_flights", "total_flights", "cancelled_percentage"),
    ).orderBy(period)


def worst_delays(
    punctuality: DataFrame,
    by: list[str],
    month: dt.date | str | None = None,
    k: int = 10,
) -> DataFrame:
    """Airports or airlines with the longest mean delay, from either punctuality mart.

    The mart's means carry two digits and are weighted by completed flights.
    """
    sums = pick(punctuality, month=month).groupBy(*by).agg(
        *_sums("completed_flights", "delayed_flights"),
        mean_of_rounded("avg_delay_minutes", "completed_flights").alias("avg_delay_minutes"),
    )
    rated = sums.select("*", _rate("delayed_flights", "completed_flights", "delayed_percentage"))
    return top(rated.filter(F.col("avg_delay_minutes").isNotNull()), k, "avg_delay_minutes", by)


def airline_routes(
    fact: DataFrame,
    dim_airline: DataFrame,
    airlines: list[str] | None = None,
    k: int = 10,
) -> DataFrame:
    """The routes airlines fly most often, without deleted flights.

    Counted by key first; names are looked up for the counts.
    """
    flown = fact.filter(~F.col("is_deleted") & F.col("route_key").isNotNull())
    counts = flown.groupBy("airline_key", "route_key").agg(F.count("*").alias("flight_count"))
    named = pick(counts.join(dim_airline, "airline_key"), airlines=airlines)
    chosen = named.select("airline_iata", "airline_name", "route_key", "flight_count")
    return top(chosen, k, "flight_count", ["airline_iata", "airline_name", "route_key"])


def route_trend(
    route_popularity: DataFrame,
    period: str = "flight_week",
    airport: str | None = None,
) -> DataFrame:
    """Routes and flights per ``flight_week``, ``flight_month`` or ``flight_date``."""
    chosen = pick(route_popularity, airports=None if airport is None else [airport])
    return (
        chosen.groupBy(period)
        .agg(
            F.count_distinct("route_key").alias("routes"),
            *_sums("flight_count", "cancelled_flights"),
        )
        .orderBy(period)
    )
