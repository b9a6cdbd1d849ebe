"""Payloads whose fields change, and airlines whose names do."""

from __future__ import annotations

import json

import pytest
from test_ingest import flight

from flightmarts.constants import RAW_ARRIVALS, RAW_DEPARTURES
from flightmarts.plans import history
from flightmarts.sources import drift
from flightmarts.sources.landing import ARRIVALS


@pytest.fixture(scope="module")
def flights(spark):
    plain = flight("SK1", "GOT", "ARN", "2026-01-25T10:00:00Z", True, "2026-01-25T10:20:00Z")
    del plain["unknownField"]
    rows = [("1", plain), ("1", plain)]
    rows += [("2", plain | {"aircraft": {"type": "A320", "seats": [1, 2]}})]
    rows += [("3", plain | {"arrivalTime": "soon", "locationAndStatus": {"terminal": 5, "gate": {"no": 3}}})]
    rows += [("3", plain | {"arrivalTime": {"scheduledUtc": "not a time"}, "extra": None})]
    texts = [(load, json.dumps(f)) for load, f in rows] + [("3", "{broken")]
    return spark.createDataFrame(texts, "load_id string, flight string")


def test_report(flights):
    found = {
        (r.load_id, r.path): (r.observed_type, r.status)
        for r in drift.drift_report(flights, ARRIVALS).collect() if r.status != "missing"
    }
    assert found == {
        ("2", "aircraft.type"): ("STRING", "added"), ("2", "aircraft.seats"): ("ARRAY", "added"),
        ("3", "arrivalTime"): ("VARIANT", "retyped"), ("3", "locationAndStatus.terminal"): ("VARIANT", "retyped"),
        ("3", "locationAndStatus.gate"): ("OBJECT", "retyped"), ("3", "locationAndStatus.gate.no"): ("BIGINT", "added"),
    }


def test_versions(flights):
    rows = drift.schema_versions(flights).orderBy("version").collect()
    assert [(r.version, r.first_load, r.last_load, r.flights) for r in rows] == [
        (1, "1", "1", 2), (2, "2", "2", 1), (3, "3", "3", 3)
    ]
    again = flights.unionByName(flights.filter("load_id = '1'").selectExpr("'0' AS load_id", "flight"))
    assert drift.schema_versions(again).orderBy("version").first()[1:4] == ("0", "1", 2)


def test_nothing_is_lost(flights):
    rows = drift.typed_flights(flights, ARRIVALS).collect()
    assert len(rows) == 6 and all(r.payload for r in rows)
    by_text = {r.payload: r for r in rows}
    plain = next(r for t, r in by_text.items() if "not a time" not in t and "soon" not in t and "broken" not in t)
    assert plain.drifted == "" and plain.arrival_time__scheduled_utc is not None
    late = next(r for t, r in by_text.items() if "soon" in t)
    assert (late.location_and_status__terminal, late.location_and_status__gate) == ("5", None)
    assert late.drifted == "locationAndStatus.gate,arrivalTime"
    assert next(r for t, r in by_text.items() if "not a time" in t).drifted == "arrivalTime.scheduledUtc"
    assert by_text["{broken"].drifted == "$" and by_text["{broken"].flight_id is None


def test_fields_are_taken_out_together(spark):
    plain = flight("SK1", "GOT", "ARN", "2026-01-25T10:00:00Z", True, "2026-01-25T10:20:00Z")
    changed = [
        {"flightId": "{not an object", "baggage": {}}, {"flightId": ["x"], "baggage": None}, {"flightId": {}, "baggage": 3},
    ]
    texts = [("1", json.dumps(plain | more)) for more in changed] + [("1", "[1]"), ("1", None)]
    typed = drift.typed_flights(spark.createDataFrame(texts, "load_id string, flight string"), ARRIVALS)
    assert [(r.flight_id, r.drifted) for r in typed.collect()] == [
        ("{not an object", ""), (None, "flightId"), (None, "flightId,baggage"), (None, ""), (None, "$")
    ]
    # Three casts of the whole flight, and one look at each object that is not there.
    plan = typed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("variant_get(") <= 3 + 5


def test_lost_fields_stay_queryable(flights):
    rows = drift.typed_flights(flights, ARRIVALS).filter("drifted LIKE '%gate%'")
    assert [r.no for r in rows.selectExpr("variant_get(parse_json(payload), '$.locationAndStatus.gate.no', 'int') AS no").collect()] == [3]


def test_observed_fields():
    text = "OBJECT<a: STRING, `b c`: OBJECT<d: ARRAY<OBJECT<x: BIGINT>>, e: DECIMAL(3,1)>, f: VOID, g: OBJECT<>>"
    assert drift.observed_fields(text) == {"a": "STRING", "b c.d": "ARRAY", "b c.e": "DECIMAL(3,1)", "f": "VOID"}
    assert drift.observed_fields("VOID") == {} == drift.observed_fields("")


def test_renamed_airline_has_a_row_per_period(spark, arrivals, departures):
    def loaded(load, names, first):
        return [
            dict(flight_id=f"F{first + i}", airline="SK", airline_name=n, load=load, sched="2026-01-25 12:00:00",
                 actual=f"2026-01-25 12:{first + i:02d}:00")
            for i, n in enumerate(names)
        ]

    rows = [*loaded("1", ["Old", "Old", "New"], 0), *loaded("2", ["Old"], 10), *loaded("3", ["New", "New"], 20),
            *loaded("4", ["Old", None], 30)]
    rows.append(dict(flight_id="X", airline=None, airline_name="Nobody", sched="2026-01-25 12:00:00"))
    raw = {RAW_ARRIVALS: arrivals(*rows), RAW_DEPARTURES: departures()}
    periods = history.name_periods(history.names_per_load(raw))
    assert sorted(tuple(r)[1:] for r in periods.collect()) == [
        ("New", 2, "3", "4"), ("Old", 1, "1", "3"), ("Old", 3, "4", None)
    ]
    found = {r.period_no: (r.airline_name, r.total_flights, r.avg_delay_minutes)
             for r in history.punctuality_by_period(raw, periods).collect()}
    assert found == {1: ("Old", 4, 3.25), 2: ("New", 2, 20.5), 3: ("Old", 2, 30.5)}
