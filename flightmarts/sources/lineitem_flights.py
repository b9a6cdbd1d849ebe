"""Raw flight tables derived from the ``lineitem`` test table.

The test data holds no flights, so order lines are read as flights by integer
arithmetic on their columns: odd lines arrive, even lines depart. Day, airline
and airport come from different digits of the order key, so that none fixes
another; some flights lack a time, a status or an origin, stop at an airport
that is not covered, have an unknown status or an airline with a second name, and
one morning at one airport is very busy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmarts import schemas
from flightmarts.constants import AIRPORT_CODES, RAW_ARRIVALS, RAW_DEPARTURES
from flightmarts.sources.landing import snake_case

_LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_shipdate timestamp_ntz"
)
_AIRLINES = ["SK", "DY", "FR", "LH", "AY", "KL", "BA", "W6", "FI", "EW", "D8", None]
_OTHER_AIRPORTS = AIRPORT_CODES + ["CPH", "OSL", "HEL", "LHR"]
_FIRST_DAY = 1767225600  # 2026-01-01 00:00:00 UTC
_BUSY = "(l_linenumber = 1 AND l_orderkey % 5 = 0)"


def _pick(values: list[str | None], position: str) -> str:
    texts = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"get(array({texts}), int({position}))"


# Flight in seconds and codes: name → expression over lineitem.
_FLIGHT = {
    "arrives": "l_linenumber % 2 = 1",
    "airline": _pick(_AIRLINES, "(l_orderkey div 60) % 12"),
    "second_name": "l_partkey % 2 = 0",
    "flight_id": f"concat(coalesce({_pick(_AIRLINES, '(l_orderkey div 60) % 12')}, 'XX'), "
    "string(100 + l_orderkey % 900))",
    "home": f"CASE WHEN l_partkey % 41 = 0 THEN 'SFT' WHEN {_BUSY} THEN 'ARN'"
    f" ELSE {_pick(AIRPORT_CODES, '(l_orderkey div 720) % 10')} END",
    "other": "CASE WHEN l_partkey % 67 <> 0 THEN "
    f"{_pick(_OTHER_AIRPORTS, '(l_orderkey div 7 + l_linenumber) % 14')} END",
    "scheduled": f"CASE WHEN l_partkey % 61 = 0 THEN NULL WHEN {_BUSY}"
    f" THEN {_FIRST_DAY} + 20 * 86400 + 8 * 3600 + (l_orderkey % 60) * 60"
    f" ELSE {_FIRST_DAY} + (l_orderkey % 60) * 86400"
    " + ((l_orderkey * 7 + l_linenumber * 131) % 1440) * 60 END",
    "status": "CASE WHEN l_partkey % 53 = 0 THEN NULL WHEN l_partkey % 59 = 0 THEN 'ZZZ' WHEN l_partkey % 20 <= 2 THEN 'DEL' WHEN l_partkey % 20 = 3 THEN 'CAN'"
    " WHEN l_partkey % 20 <= 6 THEN 'SCH' WHEN l_partkey % 20 = 7 THEN 'ACT' ELSE 'LAN' END",
    "late": "((l_partkey * 37 + l_suppkey * 11) % 80) * 60 - 1200",
    "terminal": "string(1 + l_suppkey % 5)",
    "gate": "concat('G', string(1 + l_suppkey % 20))",
    "carousel": "CASE WHEN l_partkey % 5 <> 0 THEN string(1 + l_suppkey % 6) END",
    "to_first_bag": "300 + l_suppkey * 60",
    "to_last_bag": "CASE WHEN l_partkey % 11 <> 0 THEN 120 + ((l_partkey * 17) % 40) * 60 END",
    "load": "string(1769300000 + l_partkey % 3)",
    "row": "concat(lpad(string(l_partkey), 8, '0'), lpad(string(l_suppkey), 8, '0'),"
    " string(unix_date(date(l_shipdate))))",
}


def _raw_columns(direction: str, origin: str, destination: str) -> dict[str, str]:
    """Raw column → expression over a flight."""
    actual = "CASE WHEN status = 'LAN' THEN scheduled + late END"
    return {
        "flight_id": "flight_id",
        "flight_leg_identifier__flight_id": "flight_id",
        "flight_leg_identifier__departure_airport_iata": origin,
        "flight_leg_identifier__arrival_airport_iata": destination,
        "flight_leg_identifier__flight_departure_date_utc": (
            "date_trunc('day', timestamp_seconds(scheduled))"
        ),
        "airline_operator__name": (
            "concat('Airline ', airline, CASE WHEN airline = 'W6' AND second_name"
            " THEN ' Malta' ELSE '' END)"
        ),
        "airline_operator__iata": "airline",
        "departure_airport_swedish": f"concat('Airport ', {origin})",
        "departure_airport_english": f"concat('Airport ', {origin})",
        "arrival_airport_swedish": f"concat('Airport ', {destination})",
        "arrival_airport_english": f"concat('Airport ', {destination})",
        f"{direction}_time__scheduled_utc": "timestamp_seconds(scheduled)",
        f"{direction}_time__estimated_utc": "timestamp(NULL)",
        f"{direction}_time__actual_utc": f"timestamp_seconds({actual})",
        "location_and_status__flight_leg_status": "status",
        "location_and_status__terminal": "terminal",
        "location_and_status__gate": "gate",
        "baggage__baggage_claim_unit": "carousel",
        "baggage__first_bag_utc": f"timestamp_seconds({actual} + to_first_bag)",
        "baggage__last_bag_utc": f"timestamp_seconds({actual} + to_first_bag + to_last_bag)",
        "_dlt_load_id": "load",
        "_dlt_id": "row",
    }


def _raw(flights: DataFrame, direction: str, origin: str, destination: str) -> DataFrame:
    schema = schemas.ARRIVALS_RAW if direction == "arrival" else schemas.DEPARTURES_RAW
    columns = _raw_columns(direction, origin, destination)
    return flights.selectExpr(
        *[f"{columns[name]} AS {name}" for name in schema.names], "home AS airport"
    )


def raw_flights(spark: SparkSession, sf_dir: str, by_day: bool = False) -> dict[str, DataFrame]:
    """Both raw tables, by name, from the test data under ``sf_dir``.

    ``by_day`` brings the flights of an airport and scheduled day together, while
    they are still order lines of five numbers.
    """
    lines = spark.read.schema(_LINEITEM).parquet(f"{sf_dir}/lineitem.parquet")
    if by_day:
        lines = lines.repartition(F.expr(_FLIGHT["home"]), F.expr(f"({_FLIGHT['scheduled']}) div 86400"))
    flights = lines.selectExpr(*[f"{e} AS {name}" for name, e in _FLIGHT.items()])
    return {
        RAW_ARRIVALS: _raw(flights.filter("arrives"), "arrival", "other", "home"),
        RAW_DEPARTURES: _raw(flights.filter("NOT arrives"), "departure", "home", "other"),
    }


def payload_documents(
    spark: SparkSession, sf_dir: str, direction: str, by_day: bool = False
) -> DataFrame:
    """The same flights as landed payloads, in JSON text, one flight a document.

    ``direction`` is ``arrivals`` or ``departures``. Columns: ``document``,
    ``airport``, ``date`` (scheduled day) and ``load_id``. ``by_day`` as for ``raw_flights``.
    """
    arrives = direction == "arrivals"
    table, kind = (RAW_ARRIVALS, "arrival") if arrives else (RAW_DEPARTURES, "departure")
    flight_type = schemas.ARRIVAL_FLIGHT if arrives else schemas.DEPARTURE_FLIGHT
    raw = raw_flights(spark, sf_dir, by_day)[table]

    def as_text(name: str) -> Column:
        if name.endswith("_utc"):
            return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss'Z'")
        return F.col(name)

    def nested(struct: T.StructType, prefix: str) -> Column:
        return F.struct(
            *[
                (
                    nested(field.dataType, f"{prefix}{snake_case(field.name)}__")
                    if isinstance(field.dataType, T.StructType)
                    else as_text(prefix + snake_case(field.name))
                ).alias(field.name)
                for field in struct.fields
            ]
        )

    document = F.struct(
        F.lit(1).alias("numberOfFlights"), F.array(nested(flight_type, "")).alias("flights")
    )
    return raw.select(
        F.to_json(document).alias("document"),
        "airport",
        F.date_format(f"{kind}_time__scheduled_utc", "yyyy-MM-dd").alias("date"),
        F.col("_dlt_load_id").alias("load_id"),
    )
