"""Arrivals and departures as one relation, and the flight fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightmarts.constants import ARRIVAL, DEPARTURE
from flightmarts.functions import date_key, surrogate_key

_SHARED_HEAD = [
    "flight_id", "flight_number", "origin_airport_iata", "destination_airport_iata",
    "departure_date_utc", "airline_name", "airline_iata",
]
_SHARED_BODY = [
    "flight_status", "terminal", "gate", "route_key",
    "is_deleted", "is_cancelled", "is_domestic", "delay_minutes",
]
# Columns only arrivals have, with the type departures fill in as NULL.
_ARRIVAL_ONLY = {
    "is_landed": "boolean",
    "baggage_claim_unit": "string",
    "first_bag_utc": "timestamp",
    "last_bag_utc": "timestamp",
    "baggage_handling_minutes": "double",
}

UNIFIED_COLUMNS = [
    *_SHARED_HEAD,
    "scheduled_time_utc", "actual_time_utc",
    *_SHARED_BODY,
    "flight_hour", "flight_day_of_week", "flight_day_name", "flight_date", "flight_time_period",
    "is_on_time",
    *_ARRIVAL_ONLY,
    "flight_type",
]

FACT_COLUMNS = [
    "flight_key", "airline_key", "origin_airport_key", "dest_airport_key", "flight_date_key",
    "flight_id", "flight_number", "flight_type", "flight_status", "terminal", "gate", "route_key",
    "scheduled_time_utc", "actual_time_utc", "flight_date", "flight_hour", "flight_day_of_week",
    "flight_day_name", "flight_time_period",
    "delay_minutes", "baggage_handling_minutes",
    "is_deleted", "is_cancelled", "is_domestic", "is_on_time", "is_landed",
    "baggage_claim_unit", "first_bag_utc", "last_bag_utc",
    "departure_date_utc", "airline_name", "origin_airport_iata", "destination_airport_iata",
]


def _conformed(staged: DataFrame, direction: str, arrival_only: list[str]) -> DataFrame:
    """Staged columns in unified order; ``arrival_only`` are SQL expressions."""
    sources = [
        *_SHARED_HEAD,
        f"scheduled_{direction}_utc",
        f"actual_{direction}_utc",
        *_SHARED_BODY,
        f"{direction}_hour",
        f"{direction}_day_of_week",
        f"{direction}_day_name",
        f"{direction}_date",
        f"{direction}_time_period",
        "is_on_time",
        *arrival_only,
        f"'{direction}'",
    ]
    return staged.selectExpr(
        *[f"{source} AS {name}" for source, name in zip(sources, UNIFIED_COLUMNS, strict=True)]
    )


def unify(stg_arrivals: DataFrame, stg_departures: DataFrame) -> DataFrame:
    """All flights in one shape, told apart by ``flight_type``."""
    absent = [f"CAST(NULL AS {kind})" for kind in _ARRIVAL_ONLY.values()]
    arrivals = _conformed(stg_arrivals, ARRIVAL, list(_ARRIVAL_ONLY))
    return arrivals.unionByName(_conformed(stg_departures, DEPARTURE, absent))


def with_keys(flights: DataFrame) -> DataFrame:
    """Unified flights plus the fact's keys; a projection, no shuffle."""
    return flights.withColumns(
        {
            "flight_key": surrogate_key("flight_id", "flight_type", "scheduled_time_utc"),
            "airline_key": surrogate_key("airline_iata"),
            "origin_airport_key": surrogate_key("origin_airport_iata"),
            "dest_airport_key": surrogate_key("destination_airport_iata"),
            "flight_date_key": date_key(F.col("flight_date")),
        }
    )


def fact(keyed_flights: DataFrame) -> DataFrame:
    """One row per flight, with keys to the dimensions."""
    return keyed_flights.select(*FACT_COLUMNS)
