"""Weeks, months, quarters and years from stored daily states."""

from __future__ import annotations

import math
from collections import defaultdict

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from flightmarts.constants import RAW_ARRIVALS, RAW_DEPARTURES
from flightmarts.plans import periods, pipeline, tallies
from flightmarts.plans.warehouse import Models
from flightmarts.sources.lineitem_flights import raw_flights
from flightmarts.sources.tables import DAILY_STATES, ParquetStore


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fact") / "fact")
    Models(raw_flights(spark, SF_DIR), "2026-01-25")["fct_flights"].write.parquet(path)
    return spark.read.parquet(path)


def quantile(values, share):
    position = (len(values) - 1) * share
    low, high = sorted(values)[math.floor(position)], sorted(values)[math.ceil(position)]
    return low + (high - low) * (position - math.floor(position))


@pytest.mark.parametrize("period", periods.PERIODS)
def test_medians_of_periods_are_those_of_their_flights(fact, period):
    flights = defaultdict(list)
    rows = fact.filter("flight_date IS NOT NULL").withColumn("p", F.date_trunc(period, "flight_date"))
    for r in rows.collect():
        own = r.destination_airport_iata if r.flight_type == "arrival" else r.origin_airport_iata
        flights[own, r.p, r.flight_type, r.is_domestic].append(r)
    found = periods.airport_punctuality(tallies.airport_delays(fact), period).collect()
    assert found
    for cell in found:
        own = flights[cell.airport_iata, cell.period_start, cell.flight_type, cell.is_domestic]
        late = [r.delay_minutes for r in own if r.actual_time_utc is not None]
        assert cell.total_flights == sum(not r.is_deleted for r in own)
        assert cell.completed_flights == len(late)
        for name, share in (("median", 0.5), ("p90", 0.9)):
            expected = None if not late else pytest.approx(quantile(late, share), abs=0.006)
            assert cell[f"{name}_delay_minutes"] == expected


def test_unknown_period(fact):
    with pytest.raises(ValueError):
        periods.in_periods(tallies.airport_delays(fact), "decade")


def test_airlines_beyond_one_word_are_counted(spark):
    rows = [(f"k{a:03d}", 20260100 + d, "x") for d in range(1, 29) for a in range(0, 130 + 6 * d, d)]
    rows += [("k000", 20260201, "x"), ("k000", 20260203, "y")]
    flights = spark.createDataFrame(rows, "airline_key string, flight_date_key int, airport string")
    numbers = tallies.new_airlines(flights)
    assert sorted(r.number for r in numbers.collect()) == list(range(numbers.count()))
    state = tallies._airlines_in(flights, ["airport", "flight_date_key"], numbers)
    assert state.filter("word > 1").count() > 0
    found = {(r.airport, r.period_start.month): r.unique_airlines
             for r in periods.distinct_airlines(state, ["airport"], "month").collect()}
    assert found == {("x", 1): len({a for a, d, _ in rows if d < 20260200}), ("x", 2): 1, ("y", 2): 1}


def test_numbers_of_known_airlines_stay(spark):
    known = spark.createDataFrame([("m", 0), ("a", 1), ("z", 2)], "airline_key string, number long")
    flights = spark.createDataFrame([("b",), ("a",), ("c",), ("b",)], "airline_key string")
    assert sorted(map(tuple, tallies.new_airlines(flights, known).collect())) == [("b", 3), ("c", 4)]


def test_periods_read_states_and_no_flights(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path))
    stored = Models(raw_flights(spark, SF_DIR), "2026-01-25", store.keep)
    for name, mart in [
        ("tally_airport_delays", lambda t: periods.airport_punctuality(t, "year")),
        ("tally_baggage", lambda t: periods.baggage_performance(t, "quarter")),
        ("state_route_airlines", lambda t: periods.distinct_airlines(t, ["route_key"], "year")),
    ]:
        df = mart(stored[name])
        assert {f.split("/")[-3] for f in df.inputFiles()} == {name}
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in text and "Python" not in text
    quarter = periods.airport_punctuality(stored["tally_airport_delays"].filter("flight_date_key < 20260110"), "week")
    assert "PartitionFilters: [isnotnull(flight_date_key" in quarter._jdf.queryExecution().executedPlan().toString()


def test_refresh_keeps_states_of_other_days(spark, arrivals, departures, tmp_path):
    def flight(number, day, airline, **more):
        times = dict(sched=f"2026-01-{day} 12:00:00", actual=f"2026-01-{day} 12:{number:02d}:00")
        return dict(flight_id=f"F{number}", airline=airline, airline_name=airline, carousel="1",
                    first_bag=f"2026-01-{day} 13:00:00", last_bag=f"2026-01-{day} 13:30:00") | times | more

    first = [flight(1, 24, "SK"), flight(2, 24, "DY"), flight(3, 25, "SK")]
    later = [flight(4, 25, "AA"), flight(3, 25, "SK", load="2", row="b", actual="2026-01-25 12:50:00")]
    warehouse = str(tmp_path / "w")
    raw = {RAW_ARRIVALS: arrivals(*first), RAW_DEPARTURES: departures()}
    pipeline.build(spark, raw, warehouse, "2026-01-25")
    raw = {RAW_ARRIVALS: arrivals(*first, *later), RAW_DEPARTURES: departures()}
    pipeline.refresh(spark, raw, warehouse, "2026-01-25", "2026-01-25", "2026-01-25")
    store, fresh = ParquetStore(spark, warehouse), Models(raw, "2026-01-25")
    for name in DAILY_STATES:
        if name.startswith("tally"):
            assert sorted(map(str, store.read(name, fresh[name]).collect())) == sorted(map(str, fresh[name].collect()))
    numbers = {r.airline_key: r.number for r in store.open("airline_numbers").collect()}
    assert sorted(numbers.values()) == [0, 1, 2]
    month = periods.distinct_airlines(
        store.read("state_hourly_airlines", fresh["state_hourly_airlines"]), ["airport_iata"], "month"
    )
    assert [(r.airport_iata, r.unique_airlines) for r in month.collect()] == [("GOT", 3)]
