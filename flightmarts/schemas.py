"""Schemas of the landed payload and of the raw tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _TS = T.StringType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


def _strings(*names: str) -> T.StructType:
    return _struct(*[(name, _S) for name in names])


_LEG = _strings("flightId", "departureAirportIata", "arrivalAirportIata", "flightDepartureDateUtc")
_AIRLINE = _strings("name", "iata")
_TIMES = _strings("scheduledUtc", "estimatedUtc", "actualUtc")
_LOCATION = _strings("flightLegStatus", "terminal", "gate")
_BAGGAGE = _strings("baggageClaimUnit", "firstBagUtc", "lastBagUtc")

ARRIVAL_FLIGHT = _struct(
    ("flightId", _S),
    ("flightLegIdentifier", _LEG),
    ("airlineOperator", _AIRLINE),
    ("departureAirportSwedish", _S),
    ("departureAirportEnglish", _S),
    ("arrivalTime", _TIMES),
    ("locationAndStatus", _LOCATION),
    ("baggage", _BAGGAGE),
)
DEPARTURE_FLIGHT = _struct(
    ("flightId", _S),
    ("flightLegIdentifier", _LEG),
    ("airlineOperator", _AIRLINE),
    ("arrivalAirportSwedish", _S),
    ("arrivalAirportEnglish", _S),
    ("departureTime", _TIMES),
    ("locationAndStatus", _LOCATION),
)


def payload(flight: T.DataType) -> T.StructType:
    """One landed document: a count and the list of flights."""
    return _struct(("numberOfFlights", T.LongType()), ("flights", T.ArrayType(flight, True)))


# Flights as their JSON text, whatever they hold.
UNTYPED_PAYLOAD = payload(_S)
ARRIVALS_PAYLOAD = payload(ARRIVAL_FLIGHT)
DEPARTURES_PAYLOAD = payload(DEPARTURE_FLIGHT)

_RAW_COMMON_HEAD = [
    ("flight_id", _S),
    ("flight_leg_identifier__flight_id", _S),
    ("flight_leg_identifier__departure_airport_iata", _S),
    ("flight_leg_identifier__arrival_airport_iata", _S),
    ("flight_leg_identifier__flight_departure_date_utc", _TS),
    ("airline_operator__name", _S),
    ("airline_operator__iata", _S),
]
_RAW_LOCATION = [
    ("location_and_status__flight_leg_status", _S),
    ("location_and_status__terminal", _S),
    ("location_and_status__gate", _S),
]
_RAW_META = [("_dlt_load_id", _S), ("_dlt_id", _S)]

ARRIVALS_RAW = _struct(
    *_RAW_COMMON_HEAD,
    ("departure_airport_swedish", _S),
    ("departure_airport_english", _S),
    ("arrival_time__scheduled_utc", _TS),
    ("arrival_time__estimated_utc", _TS),
    ("arrival_time__actual_utc", _TS),
    *_RAW_LOCATION,
    ("baggage__baggage_claim_unit", _S),
    ("baggage__first_bag_utc", _TS),
    ("baggage__last_bag_utc", _TS),
    *_RAW_META,
)
DEPARTURES_RAW = _struct(
    *_RAW_COMMON_HEAD,
    ("arrival_airport_swedish", _S),
    ("arrival_airport_english", _S),
    ("departure_time__scheduled_utc", _TS),
    ("departure_time__estimated_utc", _TS),
    ("departure_time__actual_utc", _TS),
    *_RAW_LOCATION,
    *_RAW_META,
)
