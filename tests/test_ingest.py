"""Landed JSON through raw tables to stored marts, on real files."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from py4j.protocol import Py4JJavaError

from flightmarts.constants import AIRPORT_CODES, RAW_ARRIVALS, RAW_DEPARTURES
from flightmarts.plans import pipeline, serving
from flightmarts.plans.warehouse import Models
from flightmarts.sources import bronze, landing
from flightmarts.sources.tables import ParquetStore


def flight(number, origin, dest, sched, arrives, actual=None, **more):
    end = "arrivalTime" if arrives else "departureTime"
    record = {
        "flightId": number,
        "flightLegIdentifier": {
            "flightId": number,
            "departureAirportIata": origin,
            "arrivalAirportIata": dest,
            "flightDepartureDateUtc": sched[:10],
        },
        "airlineOperator": {"name": "Airline SK", "iata": "SK"},
        end: {"scheduledUtc": sched, "actualUtc": actual},
        "locationAndStatus": {"flightLegStatus": "LAN" if actual else "SCH", "terminal": "5"},
        "unknownField": {"deep": [1, 2]},
    }
    record.update(more)
    return record


def land(root, date, airport, direction, flights, name="a.json"):
    folder = root / f"date={date}" / f"airport={airport}" / f"direction={direction}"
    folder.mkdir(parents=True, exist_ok=True)
    text = json.dumps({"numberOfFlights": len(flights), "flights": flights}, indent=1)
    (folder / name).write_text(text)


@pytest.fixture()
def landed(tmp_path):
    root = tmp_path / "landing"
    late = "2026-01-25T10:20:00Z"
    bags = {
        "baggage": {
            "baggageClaimUnit": "3",
            "firstBagUtc": "2026-01-25T10:30:00Z",
            "lastBagUtc": "2026-01-25T10:42:00Z",
        }
    }
    land(root, "2026-01-25", "ARN", "arrivals", [
        flight("SK1", "GOT", "ARN", "2026-01-25T10:00:00Z", True, late, **bags),
        flight("SK2", "CPH", "ARN", "2026-01-25T11:00:00Z", True),
    ])
    land(root, "2026-01-25", "GOT", "departures", [
        flight("SK1", "GOT", "ARN", "2026-01-25T09:00:00Z", False, "2026-01-25T09:05:00Z"),
    ])
    land(root, "2026-01-25", "VBY", "arrivals", [])
    land(root, "2026-01-24", "ARN", "arrivals", [
        flight("SK3", "GOT", "ARN", "2026-01-24T10:00:00Z", True),
    ])
    return root


def ingest(spark, landed, tmp_path, load_id="1769300000", **options):
    path = str(tmp_path / "bronze")
    bronze.ingest(spark, str(landed), path, load_id, "2026-01-25", **options)
    return path


def test_names():
    assert landing.snake_case("flightDepartureDateUtc") == "flight_departure_date_utc"
    assert landing.airport_list(" arn, Got ") == ["ARN", "GOT"]
    assert landing.airport_list() == AIRPORT_CODES
    assert landing.backfill_dates(3, "2026-01-01") == ["2026-01-01", "2025-12-31", "2025-12-30"]
    assert landing.backfill_dates() == [dt.datetime.now(dt.timezone.utc).date().isoformat()]


def test_flatten_names_nested_fields(spark):
    nested = spark.range(1).selectExpr(
        "named_struct('scheduledUtc', 'x', 'innerPart', named_struct('deepField', 1)) AS arrivalTime",
        "'y' AS flightId",
    )
    assert landing.flatten(nested).columns == [
        "arrival_time__scheduled_utc", "arrival_time__inner_part__deep_field", "flight_id",
    ]


def test_payload_to_raw(spark, landed, tmp_path):
    path = ingest(spark, landed, tmp_path)
    raw = bronze.read_raw(spark, path, RAW_ARRIVALS)
    rows = {r.flight_id: r for r in raw.collect()}
    assert sorted(rows) == ["SK1", "SK2", "SK3"]
    one = rows["SK1"]
    assert one.arrival_time__actual_utc == dt.datetime(2026, 1, 25, 10, 20)
    assert one.flight_leg_identifier__flight_departure_date_utc == dt.datetime(2026, 1, 25)
    assert (one.airport, one.flight_day, one.load_date) == ("ARN", "2026-01-25", "2026-01-25")
    assert (one._dlt_load_id, one.baggage__baggage_claim_unit) == ("1769300000", "3")
    assert rows["SK2"].baggage__first_bag_utc is None
    assert len({r._dlt_id for r in rows.values()}) == 3


def test_row_ids_repeat_with_the_load_and_differ_between_loads(spark, landed, tmp_path):
    def ids(load_id):
        docs = landing.read_landing(spark, str(landed), "arrivals")
        return {r._dlt_id for r in landing.raw_rows(docs, "arrivals", load_id).collect()}

    assert ids("1") == ids("1")
    assert not ids("1") & ids("2")


def test_window_and_airports_prune_folders(spark, landed):
    docs = landing.read_landing(
        spark, str(landed), "arrivals", ["ARN"], landing.backfill_dates(1, "2026-01-25")
    )
    assert [(r.airport, r.date, len(r.flights)) for r in docs.collect()] == [
        ("ARN", "2026-01-25", 2)
    ]
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(direction" in plan


def test_window_without_payloads_is_empty(spark, landed):
    docs = landing.read_landing(spark, str(landed), "departures", ["KRN"], ["2026-01-25"])
    assert docs.columns == ["numberOfFlights", "flights", "date", "airport"]
    assert docs.count() == 0


def test_documents_one_per_line(spark, tmp_path):
    folder = tmp_path / "date=2026-01-25" / "airport=ARN" / "direction=arrivals"
    folder.mkdir(parents=True)
    lines = [
        json.dumps({"flights": [flight(n, "GOT", "ARN", "2026-01-25T10:00:00Z", True)]})
        for n in ("A", "B")
    ]
    (folder / "many.json").write_text("\n".join(lines))
    docs = landing.read_landing(spark, str(tmp_path), "arrivals", one_per_line=True)
    rows = landing.raw_rows(docs, "arrivals", "1").collect()
    assert sorted(r.flight_id for r in rows) == ["A", "B"]


def test_folders_outside_the_window_are_not_listed(spark, landed):
    docs = landing.read_landing(
        spark, str(landed), "arrivals", ["ARN", "GOT"], ["2026-01-25", "2026-01-23"]
    )
    assert {f.split("/date=")[1][:10] for f in docs.inputFiles()} == {"2026-01-25"}
    assert all("airport=ARN" in f for f in docs.inputFiles())


def test_damaged_payload_stops_the_load(spark, landed, tmp_path):
    folder = landed / "date=2026-01-25" / "airport=ARN" / "direction=arrivals"
    (folder / "broken.json").write_text('{"numberOfFlights": 1, "flights": [{"flightId"')
    with pytest.raises(Py4JJavaError, match="FAILED_READ_FILE|MALFORMED"):
        ingest(spark, landed, tmp_path)


def test_append_keeps_and_replace_rewrites(spark, landed, tmp_path):
    path = ingest(spark, landed, tmp_path, "1769300000")
    ingest(spark, landed, tmp_path, "1769300001")
    assert bronze.read_raw(spark, path, RAW_ARRIVALS).count() == 6
    ingest(spark, landed, tmp_path, "1769300002", replace=True)
    rows = bronze.read_raw(spark, path, RAW_ARRIVALS).collect()
    assert {r._dlt_load_id for r in rows} == {"1769300002"} and len(rows) == 3


def test_load_summary(spark, landed, tmp_path):
    summary = pipeline.load(
        spark, str(landed), str(tmp_path / "bronze"), "1769300000", "2026-01-25"
    )
    assert sorted(tuple(r) for r in summary.collect()) == [
        (RAW_ARRIVALS, "ARN", 3), (RAW_DEPARTURES, "GOT", 1),
    ]


def test_conform_fills_missing_columns_and_reads_zoneless_times_as_utc(spark):
    partial = spark.sql(
        "SELECT 'A' AS flight_id, timestamp_ntz'2026-01-25 10:00:00' AS arrival_time__scheduled_utc"
    )
    row = bronze.conform_raw(partial, RAW_ARRIVALS).first()
    assert row.arrival_time__scheduled_utc == dt.datetime(2026, 1, 25, 10)
    assert row.location_and_status__flight_leg_status is None


def test_build_check_and_reopen(spark, landed, tmp_path):
    raw = pipeline.raw_tables(spark, ingest(spark, landed, tmp_path))
    warehouse = str(tmp_path / "warehouse")
    built = pipeline.build(spark, raw, warehouse, "2026-01-25")
    lazy = Models(raw, "2026-01-25")
    store = ParquetStore(spark, warehouse)
    for name in lazy:
        expected = sorted(map(str, lazy[name].collect()))
        assert sorted(map(str, built[name].collect())) == expected, name
        assert built[name].columns == lazy[name].columns, name
        if not name.startswith("stg_"):
            reopened = store.open(name).select(*lazy[name].columns)
            assert sorted(map(str, reopened.collect())) == expected, name
        assert spark.table(name).count() == len(expected)
    report = pipeline.check(spark, raw, warehouse)
    assert report.count() == 52
    assert report.filter("failing_rows > 0").count() == 0


def test_refresh_redoes_only_the_given_days(spark, landed, tmp_path):
    bronze_path = ingest(spark, landed, tmp_path)
    warehouse = str(tmp_path / "warehouse")
    pipeline.build(spark, pipeline.raw_tables(spark, bronze_path), warehouse, "2026-01-25")

    land(landed, "2026-01-25", "ARN", "arrivals", [
        flight("SK2", "CPH", "ARN", "2026-01-25T11:00:00Z", True, "2026-01-25T11:05:00Z"),
        flight("SK9", "CPH", "ARN", "2026-01-25T12:00:00Z", True),
    ], "b.json")
    ingest(spark, landed, tmp_path, "1769300001", dates=["2026-01-25"])
    raw = pipeline.raw_tables(spark, bronze_path)
    untouched = tmp_path / "warehouse" / "facts" / "flights_keyed" / "flight_date_key=20260124"
    before = sorted(p.name for p in untouched.iterdir())
    refreshed = pipeline.refresh(spark, raw, warehouse, "2026-01-25", "2026-01-25", "2026-01-25")
    assert sorted(p.name for p in untouched.iterdir()) == before

    fresh = Models(raw, "2026-01-25")
    for name in ("fct_flights", "dim_airline", "mart_airport_punctuality", "mart_route_popularity"):
        assert sorted(map(str, refreshed[name].collect())) == sorted(
            map(str, fresh[name].collect())
        ), name


def test_replace_touches_only_what_it_selects(spark, landed, tmp_path):
    land(landed, "2026-01-25", "GOT", "arrivals", [
        flight("SK5", "ARN", "GOT", "2026-01-25T10:00:00Z", True),
    ])
    path = ingest(spark, landed, tmp_path, "1769300000")
    ingest(spark, landed, tmp_path, "1769300001", airports=["GOT"], replace=True)
    ingest(spark, landed, tmp_path, "1769300002", dates=["2026-01-24"], replace=True)
    loads = {
        r.flight_id: r._dlt_load_id for r in bronze.read_raw(spark, path, RAW_ARRIVALS).collect()
    }
    assert loads == {
        "SK1": "1769300000", "SK2": "1769300000", "SK3": "1769300002", "SK5": "1769300001",
    }


def test_missing_landing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="landing"):
        landing.read_landing(spark, str(tmp_path / "landnig"), "arrivals")


def test_the_whole_payload_is_kept(spark, landed, tmp_path):
    raw = bronze.read_raw(spark, ingest(spark, landed, tmp_path), RAW_ARRIVALS)
    kept = [json.loads(r.payload) for r in raw.collect()]
    assert all(p["unknownField"] == {"deep": [1, 2]} for p in kept)
    built = pipeline.build(spark, pipeline.raw_tables(spark, str(tmp_path / "bronze")), str(tmp_path / "w"))
    assert built["fct_flights"].count() == 4


def test_one_document_per_line_through_ingest(spark, tmp_path):
    folder = tmp_path / "landing" / "date=2026-01-25" / "airport=ARN" / "direction=arrivals"
    folder.mkdir(parents=True)
    lines = [
        json.dumps({"flights": [flight(n, "GOT", "ARN", "2026-01-25T10:00:00Z", True)]})
        for n in ("A", "B")
    ]
    (folder / "many.json").write_text("\n".join(lines))
    path = ingest(spark, tmp_path / "landing", tmp_path, one_per_line=True)
    rows = bronze.read_raw(spark, path, RAW_ARRIVALS).collect()
    assert sorted(r.flight_id for r in rows) == ["A", "B"]


@pytest.fixture()
def eventful(landed):
    """Flights without a time, off the stored calendar, and late at night."""
    land(landed, "2026-01-24", "ARN", "arrivals", [
        flight("A9", "GOT", "ARN", "2026-01-24T10:00:00Z", True, arrivalTime={}),
        flight("L1", "GOT", "ARN", "2026-01-25T00:30:00Z", True),
    ], "odd.json")
    land(landed, "2031-01-05", "ARN", "arrivals", [
        flight("F1", "GOT", "ARN", "2031-01-05T10:00:00Z", True, "2031-01-05T10:10:00Z"),
    ])
    return landed


def test_refresh_equals_build(spark, eventful, tmp_path):
    bronze_path = ingest(spark, eventful, tmp_path)
    warehouse = str(tmp_path / "warehouse")
    pipeline.build(spark, pipeline.raw_tables(spark, bronze_path), warehouse, "2026-01-25")
    land(eventful, "2026-01-24", "ARN", "arrivals", [
        flight("B9", "GOT", "ARN", "2026-01-24T10:00:00Z", True, arrivalTime={}),
        flight("L1", "GOT", "ARN", "2026-01-25T00:30:00Z", True, "2026-01-25T00:40:00Z"),
    ], "later.json")
    ingest(spark, eventful, tmp_path, "1769300001", dates=["2026-01-24"])
    raw = pipeline.raw_tables(spark, bronze_path)
    refreshed = pipeline.refresh(spark, raw, warehouse, "2026-01-25", "2026-01-25", "2026-01-25")
    fresh = Models(raw, "2026-01-25")
    assert {"A9", "B9"} <= {r.flight_id for r in fresh["fct_flights"].collect()}
    for name in fresh:
        assert sorted(map(str, refreshed[name].collect())) == sorted(
            map(str, fresh[name].collect())
        ), name


def test_a_day_off_the_calendar_is_in_the_fact_and_no_mart(spark, eventful, tmp_path):
    """As an inner join with the calendar has it."""
    built = Models(pipeline.raw_tables(spark, ingest(spark, eventful, tmp_path)), "2026-01-25")
    assert built["fct_flights"].filter("flight_date_key = 20310105").count() == 1
    for name in ("mart_airport_punctuality", "mart_airline_punctuality", "mart_route_popularity"):
        assert built[name].filter("flight_year = 2031").count() == 0, name


def test_refresh_reads_the_folders_of_its_days_only(spark, eventful, tmp_path):
    raw = pipeline.raw_tables(spark, ingest(spark, eventful, tmp_path))
    window = bronze.in_days(raw[RAW_ARRIVALS], RAW_ARRIVALS, "2031-01-05", "2031-01-05")
    files = {r.f for r in window.selectExpr("input_file_name() AS f").distinct().collect()}
    assert files and all("flight_day=2031-01-05" in f or "timed=false" in f for f in files)
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((" in plan and "flight_day" in plan.split("PartitionFilters")[1]


def test_refresh_leaves_other_days_of_marts_alone(spark, eventful, tmp_path):
    bronze_path = ingest(spark, eventful, tmp_path)
    raw, warehouse = pipeline.raw_tables(spark, bronze_path), str(tmp_path / "warehouse")
    pipeline.build(spark, raw, warehouse, "2026-01-25")

    def files(day):
        marts = tmp_path / "warehouse" / "marts"
        return sorted(str(p) for p in marts.rglob(f"day_key={day}/*.parquet"))

    before, changed = files("20260124"), files("20260125")
    pipeline.refresh(spark, raw, warehouse, "2026-01-25", "2026-01-25", "2026-01-25")
    assert before and files("20260124") == before
    assert not set(files("20260125")) & set(changed)


def test_a_stored_mart_is_read_by_month(spark, eventful, tmp_path):
    raw, warehouse = pipeline.raw_tables(spark, ingest(spark, eventful, tmp_path)), str(tmp_path / "w")
    pipeline.build(spark, raw, warehouse, "2026-01-25")
    mart = ParquetStore(spark, warehouse).open_mart("mart_airport_hourly_traffic")
    hours = serving.peak_hours(mart, "ARN", "2026-01-01")
    plan = hours._jdf.queryExecution().executedPlan().toString()
    assert "month_key" in plan.split("PartitionFilters")[1].split("]")[0]
    lazy = serving.peak_hours(Models(raw)["mart_airport_hourly_traffic"], "ARN", "2026-01-01")
    assert sorted(map(str, hours.collect())) == sorted(map(str, lazy.collect()))
