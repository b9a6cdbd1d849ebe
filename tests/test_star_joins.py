"""Joins with the dimensions, and what they prune."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from flightmarts.constants import RAW_ARRIVALS, RAW_DEPARTURES
from flightmarts.plans import star_joins
from flightmarts.plans.dimensions import airport_dimension, date_dimension, easter_sunday, holiday_dimension
from flightmarts.plans.warehouse import Models
from flightmarts.sources.lineitem_flights import raw_flights
from flightmarts.sources.tables import ParquetStore


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    store = ParquetStore(spark, str(tmp_path_factory.mktemp("star")))
    return Models(
        raw_flights(spark, SF_DIR), "2026-01-25",
        lambda name, model: store.keep(name, model) if name == "flights_keyed" else model,
    )


def questions(spark, m):
    fact, days, airports = m["fct_flights"], m["dim_date"], m["dim_airport"]
    return {
        "week": star_joins.week_punctuality(fact, days, airports, 2026, 4),
        "weekend": star_joins.weekend_baggage(fact, days, airports, 2026, 2),
        "holiday": star_joins.holiday_traffic(fact, holiday_dimension(spark), days, airports, 2026),
        "routes": star_joins.named_routes(fact, days, airports, 2026, 1),
    }


@pytest.mark.parametrize("name", ["week", "weekend", "holiday", "routes"])
def test_conditions_on_the_calendar_prune_folders(spark, stored, name):
    plan = questions(spark, stored)[name]._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan[^\n]*", plan)
    assert scans and all("dynamicpruning" in s for s in scans)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # What is broadcast has a fixed number of rows.
    for block in plan.split("BroadcastExchange")[1:]:
        assert re.search(r"LocalTableScan|Range|FileScan", block).group() in ("LocalTableScan", "Range")


def test_only_the_week_s_folders_are_read(spark, stored):
    df = questions(spark, stored)["week"]
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    leaves = node.executedPlan().collectLeaves() if node.nodeName().startswith("Adaptive") else node.collectLeaves()
    read = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        while leaf.nodeName().endswith("QueryStage"):
            leaf = leaf.plan().collectLeaves().apply(0)
        if leaf.nodeName().startswith("Scan parquet"):
            read.append(leaf.metrics().apply("numPartitions").value())
    assert read == [7]


def test_days_off_the_calendar_drop_out_of_join_and_marts(spark, arrivals, departures):
    rows = [dict(sched=f"{day} 12:00:00") for day in ("2030-12-31", "2031-01-01", "2019-12-31", "2020-01-01")]
    built = Models({RAW_ARRIVALS: arrivals(*rows), RAW_DEPARTURES: departures()}, "2026-01-25")
    joined = star_joins.on_days(built["fct_flights"], built["dim_date"])
    assert sorted(r.date_key for r in joined.collect()) == [20200101, 20301231]
    days = [r.flight_date.date() for r in built["mart_airport_punctuality"].collect()]
    assert sorted(days) == [dt.date(2020, 1, 1), dt.date(2030, 12, 31)]


def test_airports_in_both_roles(spark, arrivals, departures):
    noon = "2026-01-25 12:00:00"
    built = Models(
        {RAW_ARRIVALS: arrivals(dict(sched=noon, origin="CPH", dest="ARN")),
         RAW_DEPARTURES: departures(dict(sched=noon, origin="GOT", dest="ARN"))}, "2026-01-25"
    )
    names = {
        r.flight_type: (r.origin_airport_name, r.destination_airport_name)
        for r in star_joins.both_airports(built["fct_flights"], built["dim_airport"]).collect()
    }
    assert names == {
        "arrival": (None, "Stockholm Arlanda Airport"),
        "departure": ("Göteborg Landvetter Airport", "Stockholm Arlanda Airport"),
    }


def test_easter(spark):
    known = ["2020-04-12", "2021-04-04", "2022-04-17", "2023-04-09", "2024-03-31", "2025-04-20", "2026-04-05",
             "2027-03-28", "2028-04-16", "2029-04-01", "2030-04-21", "1954-04-18", "1981-04-19", "2049-04-18"]
    rows = spark.createDataFrame([(int(d[:4]), d) for d in known], "year int, day string")
    found = rows.select("day", easter_sunday(F.col("year")).cast("string").alias("e")).collect()
    assert [r.e for r in found] == [r.day for r in found]


def test_holidays(spark):
    rows = {r.date_key: r.holiday_name for r in holiday_dimension(spark).collect()}
    assert {20260101: "New Year's Day", 20260403: "Good Friday", 20260514: "Ascension Day", 20260524: "Whit Sunday",
            20260620: "Midsummer Day", 20261031: "All Saints' Day", 20241102: "All Saints' Day"}.items() <= rows.items()
    assert len([k for k in rows if k // 10000 == 2026]) == 13
    keys = {r.date_key for r in date_dimension(spark, "2026-01-25").collect()}
    assert set(rows) <= keys and airport_dimension(spark).count() == 10


def test_holiday_beside_usual_days(spark, arrivals, departures):
    rows = [dict(sched=f"2026-01-{day:02d} 12:00:00") for day in (6, 6, 6, 13, 20, 20, 7)]
    built = Models({RAW_ARRIVALS: arrivals(*rows), RAW_DEPARTURES: departures()}, "2026-01-25")
    (row,) = star_joins.holiday_traffic(
        built["fct_flights"], holiday_dimension(spark), built["dim_date"], built["dim_airport"], 2026
    ).collect()
    assert (row.holiday_name, row.flight_count, row.usual_flights) == ("Epiphany", 3, 1.5)
