"""Shape of the physical plans: what would hurt on a large cluster must not appear."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from conftest import SF_DIR

from flightmarts import catalog
from flightmarts.constants import RAW_ARRIVALS, RAW_DEPARTURES
from flightmarts.plans.warehouse import Models
from flightmarts.sources.lineitem_flights import raw_flights
from flightmarts.sources.tables import ParquetStore

MARTS = [
    "mart_airline_punctuality",
    "mart_airport_hourly_traffic",
    "mart_airport_punctuality",
    "mart_baggage_performance",
    "mart_route_popularity",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lazy(spark):
    return Models(raw_flights(spark, SF_DIR), "2026-01-25")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    store = ParquetStore(spark, str(tmp_path_factory.mktemp("warehouse")))
    return Models(
        raw_flights(spark, SF_DIR),
        "2026-01-25",
        lambda name, model: store.keep(name, model) if name == "flights_keyed" else model,
    )


def test_versions_are_dropped_before_the_shuffle(lazy):
    text = plan(lazy["stg_flights_arrivals"])
    steps = re.findall(r"WindowGroupLimit|Exchange", text)
    # Read bottom-up: limited per map task, shuffled, limited for good.
    assert steps == ["WindowGroupLimit", "Exchange", "WindowGroupLimit"]
    assert "Partial" in text and "Final" in text


@pytest.mark.parametrize("name", MARTS)
def test_marts_never_meet_in_one_task_nor_cross_join(lazy, name):
    text = plan(lazy[name])
    assert "SinglePartition" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text


@pytest.mark.parametrize("name", MARTS)
def test_only_fixed_dimensions_are_broadcast_by_hint(spark, stored, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(stored[name].select("*"))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for block in text.split("BroadcastExchange")[1:]:
        source = re.search(r"LocalTableScan|Range|FileScan", block).group()
        assert source in ("LocalTableScan", "Range"), block[:300]


@pytest.mark.parametrize("name", MARTS)
def test_flights_are_counted_before_any_join(stored, name):
    """Only the airline's name is looked up, on aggregated rows."""
    text = plan(stored[name])
    if name != "mart_airline_punctuality":
        assert "Join" not in text
        return
    lines = text.splitlines()
    scan = max(i for i, line in enumerate(lines) if "FileScan" in line and "is_deleted" in line)
    first_aggregate = max(i for i, line in enumerate(lines[:scan]) if "HashAggregate" in line)
    last_join = max(i for i, line in enumerate(lines[:scan]) if "Join" in line)
    assert last_join < first_aggregate < scan


def test_routes_are_filtered_before_they_are_grouped(stored):
    text = plan(stored["mart_route_popularity"])
    # The plan's text cuts long lists, so the second column is looked for in the filter.
    assert "PushedFilters: [In(origin_airport_iata" in text
    scan = text.index("FileScan")
    assert "destination_airport_iata" in text[text.rindex("Filter (", 0, scan) : scan]


def test_the_airline_mart_deduplicates_once(spark):
    """Both reads are of one stored copy, and nothing stays cached."""
    cached = lambda: spark._jsc.sc().getPersistentRDDs().size()
    before = cached()
    mart = catalog.queries()["mart_airline_punctuality"](spark, SF_DIR)
    text = plan(mart)
    assert text.count("FileScan") == 2 and "lineitem" not in text
    assert mart.count()
    assert "InMemoryTableScan" not in text and cached() == before
    assert "InMemoryTableScan" not in plan(catalog.queries()["fct_flights"](spark, SF_DIR))


def test_mart_reads_only_its_columns_and_pushes_its_filter(stored):
    text = plan(stored["mart_baggage_performance"])
    schema = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert set(re.findall(r"(\w+):", schema)) <= {
        "flight_type", "baggage_claim_unit", "is_domestic", "flight_hour", "flight_time_period",
        "flight_day_of_week", "flight_day_name", "baggage_handling_minutes", "delay_minutes",
        "destination_airport_iata",
    }
    assert "EqualTo(flight_type,arrival)" in text
    assert "IsNotNull(baggage_claim_unit)" in text


def test_a_day_filter_prunes_folders_of_the_stored_fact(stored):
    text = plan(stored["fct_flights"].filter("flight_date_key = 20260125"))
    assert "PartitionFilters: [isnotnull(flight_date_key" in text


def test_scheduled_time_filter_reaches_the_raw_scan(spark, stored, tmp_path):
    path = str(tmp_path / "raw")
    raw = raw_flights(spark, SF_DIR)
    raw[RAW_ARRIVALS].write.parquet(path)
    arrivals = spark.read.parquet(path)
    models = Models({RAW_ARRIVALS: arrivals, RAW_DEPARTURES: raw[RAW_DEPARTURES]})
    one_day = models["stg_flights_arrivals"].filter("scheduled_arrival_utc >= '2026-01-25'")
    assert "GreaterThanOrEqual(arrival_time__scheduled_utc" in plan(one_day)


def test_top_k_is_not_a_full_sort(spark):
    text = plan(catalog.queries()["explore_top_routes"](spark, SF_DIR))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_star_functions_that_coverage_names_are_called_by_the_marts():
    root = Path(__file__).resolve().parent.parent
    marts = (root / "flightmarts/plans/marts.py").read_text()
    named = set(re.findall(r"`star\.(\w+)", (root / "docs/COVERAGE.md").read_text()))
    assert named
    assert [n for n in sorted(named) if f"{n}(" not in marts] == []
