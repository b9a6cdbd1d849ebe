"""Last known values, intervals by bins, alliances and the local clock."""

from __future__ import annotations

import random

import pytest
from conftest import SF_DIR, at

from pyspark.sql import functions as F

from flightmarts import catalog
from flightmarts.constants import RAW_ARRIVALS, RAW_DEPARTURES
from flightmarts.operators.asof import last_known, merged_spans, within_spans
from flightmarts.plans import history, surroundings
from flightmarts.plans.warehouse import Models

LEFT, RIGHT = "k string, t timestamp, n int", "k string, at timestamp, v string, w double"


def looked_up(spark, left, right, max_age=3 * 3600):
    df = last_known(
        spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "t", "at", ["v", "w"], max_age
    )
    assert df.columns == ["k", "t", "n", "at", "v", "w"]
    return {r.n: (r.v, r.w) for r in df.collect()}


def test_last_known_at_borders(spark):
    left = [
        ("a", at("2026-01-01 10:00:00"), 1),  # at the very time of an observation
        ("a", at("2026-01-01 09:59:59"), 2),  # before the first one
        ("a", at("2026-01-01 13:00:00"), 3),  # as old as may be, three bins on
        ("a", at("2026-01-01 13:00:01"), 4),  # too old
        ("b", at("2026-01-01 11:00:00"), 5),  # another key
        (None, at("2026-01-01 11:00:00"), 6), ("a", None, 7), (None, None, 8),
    ]
    right = [
        ("a", at("2026-01-01 10:00:00"), "x", 1.0), ("a", at("2026-01-01 10:00:00"), "x", 2.0),
        ("a", None, "z", 9.0), (None, at("2026-01-01 10:30:00"), "z", 9.0),
    ]
    none = (None, None)
    assert looked_up(spark, left, right) == {
        1: ("x", 2.0), 2: none, 3: ("x", 2.0), 4: none, 5: none, 6: none, 7: none, 8: none,
    }


def test_last_known_null_values_and_repeated_rows(spark):
    noon = at("2026-01-01 12:00:00")
    right = [("a", at("2026-01-01 11:00:00"), "old", 1.0), ("a", at("2026-01-01 11:30:00"), None, None)]
    left = spark.createDataFrame([("a", noon, 1)] * 3, LEFT)
    found = last_known(left, spark.createDataFrame(right, RIGHT), ["k"], "t", "at", ["v", "w"], 7200).collect()
    # The last observation counts although it has no values.
    assert [(r.at is not None, r.v) for r in found] == [(True, None)] * 3
    empty = spark.createDataFrame([], RIGHT)
    assert last_known(left, empty, ["k"], "t", "at", ["v", "w"], 7200).filter("at IS NULL").count() == 3
    assert last_known(left.limit(0), empty, ["k"], "t", "at", ["v", "w"], 7200).count() == 0


@pytest.mark.parametrize("max_age", [1800, 3600, 5 * 3600 + 1])
def test_last_known_equals_brute_force(spark, max_age):
    pick = random.Random(max_age)

    def time():
        return at(f"2026-01-{pick.randint(1, 2):02d} {pick.randint(0, 23):02d}:{pick.randint(0, 59):02d}:00")

    left = [(pick.choice("ab"), time(), n) for n in range(300)]
    right = [(pick.choice("ab"), time(), pick.choice("xyz"), float(pick.randint(0, 3))) for _ in range(60)]
    expected = {}
    for k, t, n in left:
        known = [(o, v, w) for key, o, v, w in right if key == k and o <= t]
        last = max(known, default=None)
        expected[n] = last[1:] if last and (t - last[0]).total_seconds() <= max_age else (None, None)
    assert looked_up(spark, left, right, max_age) == expected


def test_weather_plan_joins_nothing_and_counts_first(spark):
    plan = catalog.queries()["weather_punctuality"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan


SPANS = "g string, k string, a date, b date"


def spans(spark, *rows):
    df = spark.createDataFrame([(g, k, a, b) for g, k, a, b in rows], "g string, k string, a string, b string")
    return df.select("g", "k", F.col("a").cast("date").alias("a"), F.col("b").cast("date").alias("b"))


def test_spans_merge(spark):
    merged = merged_spans(
        spans(
            spark,
            ("g", "k", "2026-01-01", "2026-01-10"), ("g", "k", "2026-01-05", "2026-01-07"),  # inside
            ("g", "k", "2026-01-10", "2026-01-12"),  # touches
            ("g", "k", "2026-01-20", None), ("g", "k", "2026-02-01", "2026-02-02"),  # within the open one
            ("g", "k", "2026-01-15", "2026-01-15"), ("g", "k", "2026-01-16", "2026-01-14"),  # empty
            ("g", "k", None, "2026-01-14"), (None, "k", "2026-01-01", None), ("g", None, "2026-01-01", None),
            ("h", "k", "2026-01-01", "2026-01-02"), ("h", "k", "2026-01-01", "2026-01-02"),
        ),
        ["g", "k"], "a", "b",
    )
    assert sorted((r.g, str(r.a), str(r.b)) for r in merged.collect()) == [
        ("g", "2026-01-01", "2026-01-12"), ("g", "2026-01-20", "None"), ("h", "2026-01-01", "2026-01-02"),
    ]


@pytest.mark.parametrize("bin_days", [1, 7, 32])
def test_points_within_spans(spark, bin_days):
    days = ["2025-12-31", "2026-01-01", "2026-01-31", "2026-02-01", "2026-03-15", "2030-12-31"]
    points = spark.createDataFrame([("k", d) for d in days], "k string, d string")
    points = points.withColumn("d", F.col("d").cast("date"))
    held = spans(spark, ("g", "k", "2026-01-01", "2026-02-01"), ("h", "k", "2026-02-01", None),
                 ("i", "other", "2026-01-01", None), ("j", "k", "2031-06-01", None))
    df = within_spans(points, held, ["k"], "d", "a", "b", F.lit("2031-01-01"), bin_days)
    assert sorted((r.g, str(r.d)) for r in df.collect()) == [
        ("g", "2026-01-01"), ("g", "2026-01-31"), ("h", "2026-02-01"), ("h", "2026-03-15"), ("h", "2030-12-31"),
    ]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_alliances_by_the_day(spark, arrivals, departures):
    def flight(day, airline):
        return dict(sched=f"{day} 12:00:00", actual=f"{day} 12:10:00", airline=airline, airline_name=airline)

    built = Models(
        {RAW_ARRIVALS: arrivals(
            flight("2026-01-09", "SK"), flight("2026-01-10", "SK"), flight("2026-02-01", "SK"), flight("2026-01-09", "DY"),
        ), RAW_DEPARTURES: departures()}, "2026-01-25",
    )
    members = spans(
        spark, ("One", "SK", "2026-01-01", "2026-01-10"), ("One", "SK", "2026-01-05", "2026-01-10"),
        ("Two", "SK", "2026-01-10", None), ("One", "DY", "2025-01-01", None),
    ).toDF("alliance", "airline_iata", "valid_from", "valid_before")
    result = surroundings.alliance_punctuality(built["fct_flights"], built["dim_airline"], members)
    found = {(r.alliance, r.flight_month.month): (r.airlines, r.total_flights) for r in result.collect()}
    assert found == {("One", 1): (2, 2), ("Two", 1): (1, 1), ("Two", 2): (1, 1)}


def test_clock_changes(spark):
    utc = ["2026-03-29 00:30:00", "2026-03-29 01:00:00", "2026-10-24 23:30:00", "2026-10-25 00:15:00",
           "2026-10-25 01:15:00", "2026-10-25 02:00:00", None]
    flights = spark.createDataFrame([(at(t) if t else None,) for t in utc], "scheduled_time_utc timestamp")
    rows = surroundings.with_local_time(flights).collect()
    assert [(r.local_date and str(r.local_date)[:10], r.local_hour, r.hour_pass, r.utc_offset_minutes) for r in rows] == [
        ("2026-03-29", 1, 1, 60), ("2026-03-29", 3, 1, 120),  # 02:00 to 03:00 is missing
        ("2026-10-25", 1, 1, 120), ("2026-10-25", 2, 1, 120),
        ("2026-10-25", 2, 2, 60), ("2026-10-25", 3, 1, 60), (None, None, None, None),
    ]


def test_night_follows_the_local_clock(spark, arrivals, departures):
    def landed(time):
        return dict(sched="2026-07-01 12:00:00", actual=time, dest="GOT")

    built = Models(
        {RAW_ARRIVALS: arrivals(
            landed("2026-07-01 20:00:00"), landed("2026-07-01 19:59:00"),  # 22:00 and 21:59 in summer
            landed("2026-07-31 22:30:00"),  # August there
            dict(landed("2026-07-01 23:00:00"), status="CAN"), dict(sched="2026-07-01 23:00:00"),
        ), RAW_DEPARTURES: departures()}, "2026-07-25",
    )
    rows = surroundings.night_movements(built["fct_flights"]).collect()
    assert sorted((r.local_month.month, r.movements, r.night_movements, r.night_percentage) for r in rows) == [
        (7, 2, 1, 50.0), (8, 1, 1, 100.0),
    ]


def test_load_date_follows_the_load_id(spark, arrivals, departures):
    raw = {
        RAW_ARRIVALS: arrivals(
            dict(sched="2026-01-25 12:00:00", load="1769299200.5"), dict(sched="2026-01-24 12:00:00", load="1769299200"),
            dict(sched="2026-01-24 12:00:00", load="first"), dict(load="1769299199"),
        ), RAW_DEPARTURES: departures(),
    }
    rows = history.flights_by_load_date(raw).collect()
    assert sorted((str(r.data_load_date)[:10], r.flights, r.ahead_flights) for r in rows) == [
        ("2026-01-24", 1, 0), ("2026-01-25", 2, 1), ("None", 1, 0),
    ]
