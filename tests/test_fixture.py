"""The flights read from the test data can tell right from wrong."""

from __future__ import annotations

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from flightmarts import catalog

SF = SF_DIR.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: catalog.queries()[name](spark, SF)


def test_cells_hold_several_airlines(run):
    for name in ("mart_airport_hourly_traffic", "mart_route_popularity"):
        shares = run(name).agg(
            F.avg((F.col("unique_airlines") > 1).cast("int")).alias("several"),
            F.countDistinct("unique_airlines").alias("values"),
        ).first()
        assert shares["several"] > 0.1 and shares["values"] > 2, (name, shares)


def test_days_hold_several_airlines_and_airports(run):
    days = run("fct_flights").filter("flight_date_key IS NOT NULL").groupBy("flight_date_key").agg(
        F.countDistinct("airline_key").alias("airlines"),
        F.countDistinct("destination_airport_iata").alias("airports"),
    )
    least = days.agg(F.min("airlines").alias("airlines"), F.min("airports").alias("airports")).first()
    assert least["airlines"] >= 3 and least["airports"] >= 5


def test_percentiles_have_values_to_choose_from(run):
    assert run("mart_baggage_performance").agg(F.max("flights_with_baggage_data")).first()[0] > 20


def test_the_window_is_filled(run):
    assert run("backfill_window").count() >= 12


@pytest.mark.parametrize("kind", ["not_null", "unique", "accepted_values"])
def test_each_kind_of_check_finds_something(run, kind):
    found = [r["failing_rows"] for r in run(f"quality_{kind}").collect()]
    assert any(found) and not all(found)
