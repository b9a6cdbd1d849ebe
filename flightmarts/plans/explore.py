"""Exploratory queries over the raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightmarts.constants import DELETED, LANDED, RAW_ARRIVALS, RAW_DEPARTURES
from flightmarts.functions import day_name, iso_weekday, minutes_between, round2, time_period
from flightmarts.operators.shares import share_of_total, top

_STATUS = "location_and_status__flight_leg_status"
_ORIGIN = "flight_leg_identifier__departure_airport_iata"
_DESTINATION = "flight_leg_identifier__arrival_airport_iata"
_ORIGIN_NAME = "departure_airport_english"
_SCHEDULED = "arrival_time__scheduled_utc"
_ACTUAL = "arrival_time__actual_utc"


def _not_deleted(raw: DataFrame) -> DataFrame:
    """Drops deleted flights and those without a status."""
    return raw.filter(F.col(_STATUS) != DELETED)


def _landed(arrivals: DataFrame) -> DataFrame:
    return arrivals.filter((F.col(_STATUS) == LANDED) & F.col(_ACTUAL).isNotNull())


def _delay() -> Column:
    return minutes_between(F.col(_ACTUAL), F.col(_SCHEDULED))


def _airports(dim_airport: DataFrame, code: str, name: str) -> DataFrame:
    """The fixed airport list under the given column names, small enough to broadcast."""
    return F.broadcast(
        dim_airport.select(F.col("airport_iata").alias(code), F.col("airport_name").alias(name))
    )


def row_counts(arrivals: DataFrame, departures: DataFrame) -> DataFrame:
    """Rows per raw table."""

    def counted(raw: DataFrame, name: str) -> DataFrame:
        return raw.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )

    return counted(arrivals, RAW_ARRIVALS).union(counted(departures, RAW_DEPARTURES))


def sample_rows(raw: DataFrame, n: int = 5, by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows by the given columns, or any ``n`` rows."""
    return (raw.orderBy(*by) if by else raw).limit(n)


def status_distribution(arrivals: DataFrame) -> DataFrame:
    counts = arrivals.groupBy(F.col(_STATUS).alias("status")).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "status")


def flights_per_hour(arrivals: DataFrame) -> DataFrame:
    """Flights per clock hour and status."""
    hour = F.date_trunc("hour", F.col(_SCHEDULED)).alias("arrival_hour")
    counts = _not_deleted(arrivals).groupBy(hour, F.col(_STATUS).alias("status")).agg(
        F.count("*").alias("flight_count")
    )
    return counts.select("arrival_hour", "flight_count", "status").orderBy(
        F.asc_nulls_last("arrival_hour"), F.desc("flight_count"), "status"
    )


def flights_per_period(arrivals: DataFrame) -> DataFrame:
    """Flights per part of the day."""
    period = time_period(F.hour(_SCHEDULED)).alias("time_period")
    counts = _not_deleted(arrivals).groupBy(period).agg(F.count("*").alias("flight_count"))
    return counts.orderBy(F.desc("flight_count"), "time_period")


def delay_per_flight(arrivals: DataFrame) -> DataFrame:
    """Delay of every landed flight."""
    return _landed(arrivals).select(
        "flight_id", _SCHEDULED, _ACTUAL, _delay().alias("delay_minutes")
    )


def top_airlines(arrivals: DataFrame, k: int = 30) -> DataFrame:
    counts = (
        _not_deleted(arrivals)
        .groupBy(
            F.col("airline_operator__name").alias("airline"),
            F.col("airline_operator__iata").alias("iata_code"),
        )
        .agg(F.count("*").alias("flight_count"))
    )
    return top(counts, k, "flight_count", ["airline", "iata_code"])


def airline_delays(arrivals: DataFrame, at_least: int = 3) -> DataFrame:
    """Delay figures per airline with enough landed flights."""
    delay = F.col("delay")
    stats = (
        _landed(arrivals)
        .select(F.col("airline_operator__name").alias("airline"), _delay().alias("delay"))
        .groupBy("airline")
        .agg(
            F.count("*").alias("landed_flights"),
            round2(F.avg(delay)).alias("avg_delay_minutes"),
            round2(F.min(delay)).alias("best_early_minutes"),
            round2(F.max(delay)).alias("worst_late_minutes"),
        )
    )
    return stats.filter(F.col("landed_flights") >= at_least).orderBy(
        F.desc("avg_delay_minutes"), "airline"
    )


def _route_counts(arrivals: DataFrame) -> DataFrame:
    return (
        _not_deleted(arrivals)
        .groupBy(
            F.col(_ORIGIN).alias("origin_code"),
            F.col(_ORIGIN_NAME).alias("origin_name"),
            F.col(_DESTINATION).alias("destination_code"),
        )
        .agg(F.count("*").alias("flight_count"))
    )


_ROUTE = ["origin_code", "destination_code", "origin_name"]


def top_routes(arrivals: DataFrame, k: int = 20) -> DataFrame:
    routes = top(_route_counts(arrivals), k, "flight_count", _ROUTE)
    return routes.select(
        F.col("origin_code").alias("origin"),
        F.col("destination_code").alias("destination"),
        "origin_name",
        "flight_count",
    )


def _named_routes(arrivals: DataFrame, dim_airport: DataFrame) -> DataFrame:
    # Airports are looked up per route, after counting; they do not split routes.
    names = _airports(dim_airport, "destination_code", "destination_name")
    return _route_counts(arrivals).join(names, "destination_code", "left")


def top_routes_named(arrivals: DataFrame, dim_airport: DataFrame, k: int = 20) -> DataFrame:
    """Busiest routes with the destination's full name."""
    routes = _named_routes(arrivals, dim_airport).select(
        "origin_code", "origin_name", "destination_code", "destination_name", "flight_count"
    )
    return top(routes, k, "flight_count", _ROUTE)


def _route_type(listed_origin: str) -> Column:
    return (
        F.when(F.col(listed_origin).isNotNull(), F.lit("Domestic"))
        .otherwise(F.lit("International"))
        .alias("route_type")
    )


def top_routes_by_type(arrivals: DataFrame, dim_airport: DataFrame, k: int = 20) -> DataFrame:
    """Busiest routes, domestic if their origin is a listed airport."""
    origins = _airports(dim_airport, "origin_code", "listed_origin")
    routes = _named_routes(arrivals, dim_airport).join(origins, "origin_code", "left")
    routes = routes.select(
        "origin_code", "origin_name", "destination_code", "destination_name",
        _route_type("listed_origin"), "flight_count",
    )
    return top(routes, k, "flight_count", _ROUTE)


def domestic_share(arrivals: DataFrame, dim_airport: DataFrame) -> DataFrame:
    """Domestic and international arrivals with their share."""
    origins = _airports(dim_airport, "origin_code", "listed_origin")
    per_origin = (
        _not_deleted(arrivals)
        .groupBy(F.col(_ORIGIN).alias("origin_code"))
        .agg(F.count("*").alias("flights"))
    )
    per_type = (
        per_origin.join(origins, "origin_code", "left")
        .groupBy(_route_type("listed_origin"))
        .agg(F.sum("flights").alias("total_flights"))
    )
    return per_type.withColumn("percentage", share_of_total("total_flights")).orderBy(
        F.desc("total_flights")
    )


def arrival_share(arrivals: DataFrame, dim_airport: DataFrame) -> DataFrame:
    """Arrivals per listed airport with their share."""
    counts = (
        _not_deleted(arrivals)
        .groupBy(F.col(_DESTINATION).alias("airport_code"))
        .agg(F.count("*").alias("total_arrivals"))
    )
    shares = counts.join(_airports(dim_airport, "airport_code", "airport_name"), "airport_code")
    return shares.select(
        "airport_code", "airport_name", "total_arrivals",
        share_of_total("total_arrivals").alias("percentage_of_traffic"),
    ).orderBy(F.desc("total_arrivals"), "airport_code")


def movement_share(
    arrivals: DataFrame, departures: DataFrame, dim_airport: DataFrame
) -> DataFrame:
    """Arrivals and departures per listed airport; airports without any stay, at 0."""

    def counted(raw: DataFrame, code: str, name: str) -> DataFrame:
        return (
            _not_deleted(raw)
            .groupBy(F.col(code).alias("airport_code"))
            .agg(F.count("*").alias(name))
        )

    airports = dim_airport.select(
        F.col("airport_iata").alias("airport_code"), "airport_name"
    )
    merged = airports.join(
        counted(arrivals, _DESTINATION, "arrivals"), "airport_code", "left"
    ).join(counted(departures, _ORIGIN, "departures"), "airport_code", "left")
    merged = merged.na.fill(0, ["arrivals", "departures"]).withColumn(
        "total_movements", F.col("arrivals") + F.col("departures")
    )
    return merged.withColumn("percentage_of_total", share_of_total("total_movements")).orderBy(
        F.desc("total_movements"), "airport_code"
    )


def weekday_distribution(arrivals: DataFrame) -> DataFrame:
    """Arrivals per weekday with their share."""
    at = F.col(_SCHEDULED)
    counts = (
        _not_deleted(arrivals)
        .groupBy(iso_weekday(at).alias("day_number"), day_name(at).alias("day_of_week"))
        .agg(F.count("*").alias("flight_count"))
    )
    return counts.select(
        "day_of_week", "day_number", "flight_count",
        share_of_total("flight_count").alias("percentage"),
    ).orderBy(F.asc_nulls_last("day_number"))


def completeness(arrivals: DataFrame) -> DataFrame:
    """How many rows have each key column filled."""
    filled = {
        "has_flight_id": "flight_id",
        "has_scheduled": _SCHEDULED,
        "has_actual": _ACTUAL,
        "has_status": _STATUS,
        "has_airline": "airline_operator__name",
        "has_origin": _ORIGIN,
        "has_destination": _DESTINATION,
    }
    return arrivals.agg(
        F.count("*").alias("total_rows"),
        *[F.count(column).alias(name) for name, column in filled.items()],
    )
