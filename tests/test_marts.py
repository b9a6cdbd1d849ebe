"""Marts against plain Python over the fact, and their edge cases."""

from __future__ import annotations

import datetime as dt
import math
import random
from collections import defaultdict

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from flightmarts.constants import AIRPORT_CODES, RAW_ARRIVALS, RAW_DEPARTURES
from flightmarts.plans.dimensions import date_dimension
from flightmarts.plans.warehouse import Models
from flightmarts.sources.lineitem_flights import raw_flights


def models(arrivals, departures):
    return Models({RAW_ARRIVALS: arrivals, RAW_DEPARTURES: departures}, as_of="2026-01-25")


def r2(x):
    return None if x is None else math.copysign(math.floor(abs(x) * 100 + 0.5), x) / 100


def quantile(values, share):
    if not values:
        return None
    values = sorted(values)
    position = (len(values) - 1) * share
    low = math.floor(position)
    high = math.ceil(position)
    return r2(values[low] + (values[high] - values[low]) * (position - low))


def mean(values):
    return r2(sum(values) / len(values)) if values else None


def pct(part, whole):
    return r2(part * 100.0 / whole) if whole else None


@pytest.fixture(scope="module")
def hot(spark, arrivals, departures):
    """Flights of which a third share one airport, airline, day and hour."""
    rng = random.Random(7)
    inbound, outbound = [], []
    for n in range(900):
        busy = n % 3 == 0
        airline = "SK" if busy else rng.choice(["SK", "DY", "LH", None])
        home = "ARN" if busy else rng.choice(AIRPORT_CODES)
        away = rng.choice([*AIRPORT_CODES, "CPH", "OSL"])
        day = 5 if busy else rng.randint(1, 9)
        sched = dt.datetime(2026, 1, day, 8 if busy else rng.randint(0, 23), rng.randint(0, 59))
        status = rng.choice(["LAN", "LAN", "LAN", "CAN", "DEL", "SCH"])
        actual = sched + dt.timedelta(seconds=rng.randint(-40, 80) * 30)
        first = actual + dt.timedelta(minutes=5)
        row = {
            "flight_id": f"{airline or 'XX'}{n}",
            "airline": airline,
            "airline_name": airline and f"Airline {airline}",
            "sched": str(sched),
            "actual": str(actual) if status == "LAN" else None,
            "status": status,
        }
        if n % 2:
            outbound.append(dict(row, origin=home, dest=away))
        else:
            bags = status == "LAN" and rng.random() < 0.8
            inbound.append(
                dict(
                    row, origin=away, dest=home,
                    carousel=rng.choice(["1", "2", None]),
                    first_bag=str(first) if bags else None,
                    last_bag=str(first + dt.timedelta(seconds=rng.randint(1, 80) * 30))
                    if bags else None,
                )
            )
    return models(arrivals(*inbound), departures(*outbound))


def cells(built, *key, where=lambda f: True):
    groups = defaultdict(list)
    for f in built["fct_flights"].collect():
        if where(f):
            groups[tuple(k(f) for k in key)].append(f)
    return groups



def own(f):
    return f.destination_airport_iata if f.flight_type == "arrival" else f.origin_airport_iata


def day(f):
    return f.flight_date


def kind(f):
    return f.flight_type


def domestic(f):
    return f.is_domestic


def flown_delays(group):
    return [f.delay_minutes for f in group if f.actual_time_utc and f.delay_minutes is not None]


def test_airport_punctuality(hot):
    expected = {}
    for key, group in cells(hot, own, day, kind, domestic).items():
        if key[0] not in AIRPORT_CODES:
            continue
        late = flown_delays(group)
        total = sum(not f.is_deleted for f in group)
        done = sum(f.actual_time_utc is not None for f in group)
        expected[key] = (
            total, sum(f.is_cancelled for f in group), done,
            sum(m < 0 for m in late), sum(m <= 15 for m in late), sum(m > 15 for m in late),
            mean(late), r2(min(late, default=None)), r2(max(late, default=None)),
            quantile(late, 0.5), pct(sum(m <= 15 for m in late), done), pct(done, total),
        )
    actual = {
        (m.airport_iata, m.flight_date, m.flight_type, m.is_domestic): (
            m.total_flights, m.cancelled_flights, m.completed_flights,
            m.ahead_of_schedule_flights, m.on_time_flights, m.delayed_flights,
            m.avg_delay_minutes, m.min_delay_minutes, m.max_delay_minutes,
            m.median_delay_minutes, m.on_time_percentage, m.completion_rate,
        )
        for m in hot["mart_airport_punctuality"].collect()
    }
    assert actual == expected


def test_airline_punctuality(hot):
    expected = {}
    for key, group in cells(
        hot, lambda f: f.airline_name, day, kind, domestic, where=lambda f: f.airline_name
    ).items():
        late = flown_delays(group)
        total = sum(not f.is_deleted for f in group)
        expected[key] = (
            total, sum(0 <= m < 15 for m in late), sum(m >= 15 for m in late),
            sum(m < 0 for m in late), mean(late), quantile(late, 0.5),
            total if key[3] else 0, 0 if key[3] else total,
            pct(sum(f.is_cancelled for f in group), total),
        )
    actual = {
        (m.airline_name, m.flight_date, m.flight_type, m.is_domestic): (
            m.total_flights, m.on_time_flights, m.delayed_flights, m.early_flights,
            m.avg_delay_minutes, m.median_delay_minutes,
            m.domestic_flights, m.international_flights, m.cancelled_percentage,
        )
        for m in hot["mart_airline_punctuality"].collect()
    }
    assert actual == expected


def test_hourly_traffic(hot):
    expected = {}
    for key, group in cells(hot, own, day, lambda f: f.flight_hour, kind).items():
        if key[0] not in AIRPORT_CODES:
            continue
        expected[key] = (
            sum(not f.is_deleted for f in group),
            sum(f.is_domestic and not f.is_deleted for f in group),
            len({f.airline_key for f in group}),
            mean(flown_delays(group)),
            sum(f.is_on_time and f.actual_time_utc is not None for f in group),
        )
    actual = {
        (m.airport_iata, m.flight_date, m.flight_hour, m.flight_type): (
            m.flight_count, m.domestic_flights, m.unique_airlines,
            m.avg_delay_minutes, m.on_time_flights,
        )
        for m in hot["mart_airport_hourly_traffic"].collect()
    }
    assert actual == expected


def test_baggage_performance(hot):
    expected = {}
    for key, group in cells(
        hot, lambda f: f.destination_airport_iata, lambda f: f.baggage_claim_unit, domestic, day,
        lambda f: f.flight_hour,
        where=lambda f: f.flight_type == "arrival" and f.baggage_claim_unit,
    ).items():
        took = [f.baggage_handling_minutes for f in group if f.baggage_handling_minutes is not None]
        late = [
            f.delay_minutes for f in group
            if f.baggage_handling_minutes is not None and f.delay_minutes is not None
        ]
        expected[key] = (
            len(took), len(group), mean(took), quantile(took, 0.5), r2(min(took, default=None)),
            r2(max(took, default=None)), mean(late), quantile(late, 0.5),
        )
    actual = {
        (m.airport_iata, m.baggage_claim_unit, m.is_domestic, m.flight_date, m.flight_hour): (
            m.flights_with_baggage_data, m.total_arrivals,
            m.avg_baggage_handling_minutes, m.median_baggage_handling_minutes,
            m.min_baggage_handling_minutes, m.max_baggage_handling_minutes,
            m.avg_flight_delay_minutes, m.median_flight_delay_minutes,
        )
        for m in hot["mart_baggage_performance"].collect()
    }
    assert actual == expected


def test_high_percentiles_of_one_cell(arrivals, departures):
    waits = [1, 2, 3, 4, 5, 6, 7, 8, 9, 20]
    rows = [
        dict(
            flight_id=f"F{n}", sched="2026-01-25 12:00:00", actual="2026-01-25 12:00:00",
            carousel="1", first_bag="2026-01-25 12:10:00", last_bag=f"2026-01-25 12:{10 + w}:00",
        )
        for n, w in enumerate(waits)
    ]
    cell = models(arrivals(*rows), departures())["mart_baggage_performance"].first()
    assert (cell.median_baggage_handling_minutes, cell.p90_baggage_handling_minutes) == (5.5, 10.1)
    assert cell.p95_baggage_handling_minutes == 15.05


def test_route_popularity_needs_both_ends_listed(hot):
    expected = {}
    for key, group in cells(
        hot, own, lambda f: f.route_key, day, kind,
        where=lambda f: {f.origin_airport_iata, f.destination_airport_iata} <= set(AIRPORT_CODES),
    ).items():
        expected[key] = (
            sum(not f.is_deleted for f in group), len({f.airline_key for f in group}),
            sum(f.is_cancelled for f in group),
        )
    actual = {
        (m.airport_iata, m.route_key, m.flight_date, m.flight_type): (
            m.flight_count, m.unique_airlines, m.cancelled_flights,
        )
        for m in hot["mart_route_popularity"].collect()
    }
    assert actual == expected
    assert all(
        m.other_airport_iata == (m.route_key[:3] if m.flight_type == "arrival" else m.route_key[4:])
        for m in hot["mart_route_popularity"].collect()
    )


def test_fifteen_minutes_is_on_time_for_airports_and_delayed_for_airlines(arrivals, departures):
    built = models(
        arrivals(
            dict(
                airline="SK", airline_name="S", sched="2026-01-25 12:00:00",
                actual="2026-01-25 12:15:00",
            )
        ),
        departures(),
    )
    airport = built["mart_airport_punctuality"].first()
    airline = built["mart_airline_punctuality"].first()
    assert (airport.on_time_flights, airport.delayed_flights) == (1, 0)
    assert (airline.on_time_flights, airline.delayed_flights) == (0, 1)


def test_early_flights_are_on_time_and_ahead_at_airports(arrivals, departures):
    built = models(
        arrivals(dict(sched="2026-01-25 12:00:00", actual="2026-01-25 11:50:00")), departures()
    )
    mart = built["mart_airport_punctuality"].first()
    assert (mart.on_time_percentage, mart.ahead_of_schedule_percentage) == (100.0, 100.0)


def test_cell_without_completed_flights_has_null_percentages(arrivals, departures):
    rows = dict(airline="SK", airline_name="S", sched="2026-01-25 12:00:00")
    built = models(
        arrivals(dict(rows, flight_id="A", status="SCH")),
        departures(dict(rows, flight_id="B", status="DEL")),
    )
    marts = {m.flight_type: m for m in built["mart_airport_punctuality"].collect()}
    open_, deleted = marts["arrival"], marts["departure"]
    assert (open_.on_time_percentage, open_.completion_rate) == (None, 0.0)
    assert (open_.avg_delay_minutes, open_.median_delay_minutes) == (None, None)
    assert (deleted.total_flights, deleted.completion_rate) == (0, None)
    assert deleted.cancelled_percentage is None


def test_actual_time_without_schedule_drops_off_the_calendar(arrivals, departures):
    built = models(arrivals(dict(sched=None, actual="2026-01-25 12:00:00")), departures())
    assert built["fct_flights"].count() == 1
    assert built["mart_airport_punctuality"].count() == 0


def test_airline_with_two_names_fans_out(arrivals, departures):
    noon = "2026-01-25 12:00:00"
    built = models(
        arrivals(
            dict(flight_id="A", airline="SK", airline_name="Old", sched=noon),
            dict(flight_id="B", airline="SK", airline_name="New", sched=noon),
            dict(flight_id="C", airline=None, airline_name="Nobody", sched=noon),
        ),
        departures(),
    )
    assert sorted(r.airline_name for r in built["dim_airline"].collect()) == ["New", "Old"]
    marts = built["mart_airline_punctuality"].collect()
    assert sorted((m.airline_name, m.total_flights) for m in marts) == [("New", 2), ("Old", 2)]


def test_calendar(spark):
    days = date_dimension(spark, as_of="2026-01-25")
    rows = {r.date_key: r for r in days.collect()}
    assert len(rows) == 4018
    assert {20200101, 20240229, 20301213, 20301231} <= set(rows)
    today = rows[20260125]
    assert (today.is_today, today.is_current_month, today.is_current_year) == (True, True, True)
    assert (rows[20260126].is_current_month, rows[20251231].is_current_year) == (False, False)
    assert (today.day_of_week, today.is_weekend, today.week_number) == (7, True, 4)
    assert today.week_start_date == dt.datetime(2026, 1, 19)
    assert (rows[20210101].week_number, rows[20210101].year) == (53, 2021)


def test_counts_agree_across_layers(spark):
    built = Models(raw_flights(spark, SF_DIR), as_of="2026-01-25")
    staged = built["stg_flights_arrivals"].count() + built["stg_flights_departures"].count()
    fact = built["fct_flights"]
    assert fact.count() == staged == fact.select("flight_key").distinct().count()
    own = F.when(F.col("flight_type") == "arrival", F.col("destination_airport_iata")).otherwise(
        F.col("origin_airport_iata")
    )
    active = fact.filter("NOT is_deleted").withColumn("own", own)
    # What the airport marts leave out: flights of no day, and airports not covered.
    no_day = active.filter("flight_date IS NULL")
    elsewhere = active.filter("flight_date IS NOT NULL").filter(~F.col("own").isin(AIRPORT_CODES))
    left_out = no_day.count(), elsewhere.count()
    assert left_out == (66, 34)
    for name, column in [
        ("mart_airport_punctuality", "total_flights"),
        ("mart_airport_hourly_traffic", "flight_count"),
    ]:
        assert built[name].groupBy().sum(column).first()[0] == active.count() - sum(left_out)
