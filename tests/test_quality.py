from __future__ import annotations

from flightmarts.constants import RAW_ARRIVALS, RAW_DEPARTURES
from flightmarts.plans.quality import ACCEPTED_VALUES, NOT_NULL, UNIQUE, quality_report
from flightmarts.plans.warehouse import Models


def failures(report):
    return {
        (r.table_name, r.column_name, r.check_name): r.failing_rows
        for r in report.collect()
        if r.failing_rows
    }


def test_there_are_52_checks():
    not_null = sum(map(len, NOT_NULL.values()))
    unique = sum(map(len, UNIQUE.values()))
    accepted = sum(map(len, ACCEPTED_VALUES.values()))
    assert (not_null, unique, accepted) == (34, 12, 6)


def test_bad_rows_are_counted(spark, arrivals, departures):
    noon = "2026-01-25 12:00:00"
    raw = {
        RAW_ARRIVALS: arrivals(
            dict(flight_id="A", sched=noon, airline="SK", airline_name="Old"),
            dict(flight_id="B", sched=noon, airline="SK", airline_name="New"),
            dict(flight_id="C", sched=noon, status="XXX"),
            dict(flight_id="D", sched=noon, dest="CPH"),
            dict(flight_id="E", sched=None, origin=None),
        ),
        RAW_DEPARTURES: departures(dict(flight_id=None, sched=noon, status=None)),
    }
    built = Models(raw, "2026-01-25")
    report = quality_report({name: built[name] for name in built})
    assert report.count() == 52
    assert failures(report) == {
        ("stg_flights_arrivals", "origin_airport_iata", "not_null"): 1,
        ("stg_flights_arrivals", "scheduled_arrival_utc", "not_null"): 1,
        ("stg_flights_arrivals", "route_key", "not_null"): 1,
        ("stg_flights_arrivals", "destination_airport_iata", "accepted_values"): 1,
        ("stg_flights_arrivals", "flight_status", "accepted_values"): 1,
        ("stg_flights_departures", "flight_id", "not_null"): 1,
        ("stg_flights_departures", "flight_status", "not_null"): 1,
        ("fct_flights", "flight_date_key", "not_null"): 1,
        ("dim_airline", "airline_key", "unique"): 1,
        ("dim_airline", "airline_iata", "unique"): 1,
        ("mart_airline_punctuality", "airline_punctuality_key", "unique"): 1,
    }


def test_one_kind_only(spark, arrivals, departures):
    raw = {RAW_ARRIVALS: arrivals(), RAW_DEPARTURES: departures()}
    built = Models(raw, "2026-01-25")
    report = quality_report(built, ["accepted_values"])
    assert {r.check_name for r in report.collect()} == {"accepted_values"}
    assert report.count() == 6
