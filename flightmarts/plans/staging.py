"""Staging: named, typed, deduplicated flights per direction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightmarts.constants import CANCELLED, DELETED, LANDED, SCHEDULED
from flightmarts.functions import (
    day_name,
    hour_of_day,
    is_listed_airport,
    is_on_time,
    is_status,
    iso_weekday,
    minutes_between,
    time_period,
)
from flightmarts.operators.latest import latest_per_key

_LEG = "flight_leg_identifier__"
_PLACE = "location_and_status__"

# Staged name → raw name.
_IDENTITY = {
    "flight_id": "flight_id",
    "flight_number": f"{_LEG}flight_id",
    "origin_airport_iata": f"{_LEG}departure_airport_iata",
    "destination_airport_iata": f"{_LEG}arrival_airport_iata",
    "departure_date_utc": f"{_LEG}flight_departure_date_utc",
    "airline_name": "airline_operator__name",
    "airline_iata": "airline_operator__iata",
}
_LOCATION = {
    "flight_status": f"{_PLACE}flight_leg_status",
    "terminal": f"{_PLACE}terminal",
    "gate": f"{_PLACE}gate",
}
_METADATA = {"_dlt_load_id": "_dlt_load_id", "_dlt_id": "_dlt_id"}

ARRIVAL_COLUMNS = {
    **_IDENTITY,
    "origin_airport_swedish": "departure_airport_swedish",
    "origin_airport_english": "departure_airport_english",
    "scheduled_arrival_utc": "arrival_time__scheduled_utc",
    "estimated_arrival_utc": "arrival_time__estimated_utc",
    "actual_arrival_utc": "arrival_time__actual_utc",
    **_LOCATION,
    "baggage_claim_unit": "baggage__baggage_claim_unit",
    "first_bag_utc": "baggage__first_bag_utc",
    "last_bag_utc": "baggage__last_bag_utc",
    **_METADATA,
}
DEPARTURE_COLUMNS = {
    **_IDENTITY,
    "destination_airport_swedish": "arrival_airport_swedish",
    "destination_airport_english": "arrival_airport_english",
    "scheduled_departure_utc": "departure_time__scheduled_utc",
    "estimated_departure_utc": "departure_time__estimated_utc",
    "actual_departure_utc": "departure_time__actual_utc",
    **_LOCATION,
    **_METADATA,
}


def _renamed(raw: DataFrame, columns: dict[str, str]) -> DataFrame:
    return raw.selectExpr(*[f"{source} AS {name}" for name, source in columns.items()])


def _latest(flights: DataFrame, scheduled: str) -> DataFrame:
    # The time leads, as a number sorts faster than a text. A load can hold a
    # flight twice; the row id decides then.
    return latest_per_key(flights, [scheduled, "flight_id"], ["_dlt_load_id", "_dlt_id"])


def _derived(
    direction: str, far_end: str, own_status: dict[str, Column], more: dict[str, Column]
) -> dict[str, Column]:
    """Computed columns; ``far_end`` is the endpoint away from the airport."""
    status = F.col("flight_status")
    scheduled = F.col(f"scheduled_{direction}_utc")
    delay = minutes_between(F.col(f"actual_{direction}_utc"), scheduled)
    return {
        # NULL when either end is unknown.
        "route_key": F.concat(
            F.col("origin_airport_iata"), F.lit("-"), F.col("destination_airport_iata")
        ),
        "is_deleted": is_status(status, DELETED),
        "is_cancelled": is_status(status, CANCELLED),
        **own_status,
        "is_domestic": is_listed_airport(F.col(far_end)),
        "delay_minutes": delay,
        f"{direction}_hour": hour_of_day(scheduled),
        f"{direction}_day_of_week": iso_weekday(scheduled),
        f"{direction}_day_name": day_name(scheduled),
        f"{direction}_date": F.date_trunc("day", scheduled),
        f"{direction}_time_period": time_period(F.hour(scheduled)),
        "is_on_time": is_on_time(delay),
        **more,
    }


def stage_arrivals(raw: DataFrame) -> DataFrame:
    flights = _latest(_renamed(raw, ARRIVAL_COLUMNS), "scheduled_arrival_utc")
    derived = _derived(
        "arrival",
        far_end="origin_airport_iata",
        own_status={"is_landed": is_status(F.col("flight_status"), LANDED)},
        more={
            "baggage_handling_minutes": minutes_between(
                F.col("last_bag_utc"), F.col("first_bag_utc")
            )
        },
    )
    return flights.withColumns(derived)


def stage_departures(raw: DataFrame) -> DataFrame:
    flights = _latest(_renamed(raw, DEPARTURE_COLUMNS), "scheduled_departure_utc")
    derived = _derived(
        "departure",
        far_end="destination_airport_iata",
        own_status={"is_scheduled": is_status(F.col("flight_status"), SCHEDULED)},
        more={},
    )
    return flights.withColumns(derived)
