"""Data-quality checks: 52 of them, reported as a table of failures.

``failing_rows`` is 0 for a check that holds. It counts NULLs (not_null),
values that occur more than once (unique) or rows with a value outside the
list (accepted_values); NULLs pass the last two.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightmarts.constants import AIRPORT_CODES, ARRIVAL, DEPARTURE, FLIGHT_STATUSES

_STAGED = ["flight_id", "origin_airport_iata", "destination_airport_iata"]

# Table → columns that must be filled.
NOT_NULL: dict[str, list[str]] = {
    "stg_flights_arrivals": [*_STAGED, "scheduled_arrival_utc", "flight_status", "route_key"],
    "stg_flights_departures": [*_STAGED, "scheduled_departure_utc", "flight_status", "route_key"],
    "int_flights": ["flight_type"],
    "fct_flights": [
        "flight_key", "airline_key", "origin_airport_key", "dest_airport_key", "flight_date_key",
    ],
    "dim_airline": ["airline_key", "airline_iata"],
    "dim_airport": ["airport_key", "airport_iata"],
    "dim_date": ["date_key", "date_day"],
    "mart_airport_hourly_traffic": ["hourly_traffic_key", "airport_iata"],
    "mart_airport_punctuality": ["punctuality_key", "airport_iata"],
    "mart_airline_punctuality": ["airline_punctuality_key", "airline_iata"],
    "mart_route_popularity": ["route_popularity_key", "airport_iata"],
    "mart_baggage_performance": ["baggage_performance_key", "airport_iata"],
}

# Table → columns without repeats.
UNIQUE: dict[str, list[str]] = {
    "fct_flights": ["flight_key"],
    "dim_airline": ["airline_key", "airline_iata"],
    "dim_airport": ["airport_key", "airport_iata"],
    "dim_date": ["date_key", "date_day"],
    "mart_airport_hourly_traffic": ["hourly_traffic_key"],
    "mart_airport_punctuality": ["punctuality_key"],
    "mart_airline_punctuality": ["airline_punctuality_key"],
    "mart_route_popularity": ["route_popularity_key"],
    "mart_baggage_performance": ["baggage_performance_key"],
}

# Table → column → allowed values.
ACCEPTED_VALUES: dict[str, dict[str, list[str]]] = {
    "stg_flights_arrivals": {
        "destination_airport_iata": AIRPORT_CODES, "flight_status": FLIGHT_STATUSES,
    },
    "stg_flights_departures": {
        "origin_airport_iata": AIRPORT_CODES, "flight_status": FLIGHT_STATUSES,
    },
    "int_flights": {"flight_type": [ARRIVAL, DEPARTURE]},
    "fct_flights": {"flight_type": [ARRIVAL, DEPARTURE]},
}

_KINDS = ["not_null", "unique", "accepted_values"]


def _finding(table: str, column: str, check: str, failing: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(check).alias("check_name"),
        failing.alias("failing_rows"),
    )


def _counted_in_one_pass(
    tables: Mapping[str, DataFrame], table: str, kinds: list[str]
) -> DataFrame | None:
    """All checks of a table that need no grouping, from a single scan."""
    failures: dict[tuple[str, str], Column] = {}
    if "not_null" in kinds:
        for column in NOT_NULL.get(table, []):
            failures[column, "not_null"] = F.col(column).isNull()
    if "accepted_values" in kinds:
        for column, values in ACCEPTED_VALUES.get(table, {}).items():
            failures[column, "accepted_values"] = ~F.col(column).isin(values)
    if not failures:
        return None
    counts = tables[table].agg(*[F.count_if(f).alias(f"{c}:{k}") for (c, k), f in failures.items()])
    findings = [_finding(table, c, k, F.col(f"`{c}:{k}`")) for c, k in failures]
    return counts.select(F.inline(F.array(*findings)))


def _repeats(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Values that occur more than once, of all unique columns of all tables together.

    Each table is read once. Its values are counted by table, column and value
    in one shuffle, which a column with few values shares with all others.
    """
    checks = [(t, c) for t in tables for c in UNIQUE.get(t, [])]
    values = [
        tables[t].select(
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(checks.index((t, c))).alias("n"), F.col(c).cast("string").alias("v"))
                        for c in UNIQUE[t]
                    ]
                )
            )
        )
        for t in tables
        if t in UNIQUE
    ]
    counted = reduce(DataFrame.unionAll, values).filter("v IS NOT NULL").groupBy("n", "v").count()
    repeats = counted.groupBy("n").agg(F.count_if(F.col("count") > 1).alias("repeats"))
    # One row with the counts of all checks, also of tables without any value.
    row = repeats.agg(
        *[F.coalesce(F.sum(F.when(F.col("n") == i, F.col("repeats"))), F.lit(0).cast("long")).alias(f"r{i}")
          for i in range(len(checks))]
    )
    findings = [_finding(t, c, "unique", F.col(f"r{i}")) for i, (t, c) in enumerate(checks)]
    return row.select(F.inline(F.array(*findings)))


def quality_report(tables: Mapping[str, DataFrame], kinds: list[str] | None = None) -> DataFrame:
    """One row per check over the given models.

    Every table is read once for its counts and once for its unique columns, so
    give it stored or cached tables.
    """
    kinds = kinds or _KINDS
    reports: list[DataFrame] = []
    for table in tables:
        counted = _counted_in_one_pass(tables, table, kinds)
        if counted is not None:
            reports.append(counted)
    if "unique" in kinds:
        reports.append(_repeats(tables))
    return reduce(DataFrame.unionAll, reports)
