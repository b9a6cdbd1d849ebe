from __future__ import annotations

from flightmarts.plans.staging import stage_arrivals, stage_departures


def by_id(df):
    return {row.flight_id: row for row in df.collect()}


def test_delay_flags_at_the_limit(arrivals):
    noon = "2026-01-25 12:00:00"
    rows = by_id(
        stage_arrivals(
            arrivals(
                dict(flight_id="limit", sched=noon, actual="2026-01-25 12:15:00"),
                dict(flight_id="over", sched=noon, actual="2026-01-25 12:15:01"),
                dict(flight_id="sharp", sched=noon, actual=noon),
                dict(flight_id="early", sched=noon, actual="2026-01-25 11:50:00"),
                dict(flight_id="open", sched=noon),
            )
        )
    )
    assert [rows[k].delay_minutes for k in ("limit", "over", "sharp", "early", "open")] == [
        15.0, 901 / 60, 0.0, -10.0, None,
    ]
    assert [rows[k].is_on_time for k in ("limit", "over", "sharp", "early", "open")] == [
        True, False, True, True, False,
    ]


def test_missing_values(arrivals):
    rows = by_id(
        stage_arrivals(
            arrivals(
                dict(flight_id="no status", sched="2026-01-25 12:00:00", status=None),
                dict(flight_id="no time", sched=None, actual="2026-01-25 12:00:00"),
                dict(flight_id="no origin", sched="2026-01-25 12:00:00", origin=None),
            )
        )
    )
    blank = rows["no status"]
    assert (blank.is_deleted, blank.is_cancelled, blank.is_landed) == (False, False, False)
    timeless = rows["no time"]
    assert timeless.arrival_time_period == "Night/Red-eye (22:00-05:59)"
    assert (timeless.delay_minutes, timeless.is_on_time) == (None, False)
    assert (timeless.arrival_hour, timeless.arrival_date, timeless.arrival_day_name) == (
        None, None, None,
    )
    assert (rows["no origin"].route_key, rows["no origin"].is_domestic) == (None, False)


def test_domestic_looks_at_the_far_end_only(arrivals, departures):
    inbound = by_id(
        stage_arrivals(
            arrivals(
                dict(flight_id="home", origin="ARN", dest="CPH"),
                dict(flight_id="abroad", origin="CPH", dest="ARN"),
            )
        )
    )
    assert (inbound["home"].is_domestic, inbound["abroad"].is_domestic) == (True, False)
    outbound = by_id(
        stage_departures(
            departures(
                dict(flight_id="home", origin="CPH", dest="ARN"),
                dict(flight_id="abroad", origin="ARN", dest="CPH", status="SCH"),
            )
        )
    )
    assert (outbound["home"].is_domestic, outbound["abroad"].is_domestic) == (True, False)
    assert (outbound["home"].is_scheduled, outbound["abroad"].is_scheduled) == (False, True)


def test_latest_load_wins_and_row_id_breaks_ties(arrivals):
    noon = "2026-01-25 12:00:00"
    staged = stage_arrivals(
        arrivals(
            dict(flight_id="A", sched=noon, load="1", row="z", status="SCH"),
            dict(flight_id="A", sched=noon, load="2", row="a", status="LAN"),
            dict(flight_id="A", sched="2026-01-26 12:00:00", load="1", status="ACT"),
            dict(flight_id="B", sched=noon, load="1", row="a", status="SCH"),
            dict(flight_id="B", sched=noon, load="1", row="b", status="CAN"),
            dict(flight_id="C", sched=None, load="1", status="SCH"),
            dict(flight_id="C", sched=None, load="2", status="DEL"),
        )
    )
    kept = sorted((r.flight_id, str(r.scheduled_arrival_utc), r.flight_status) for r in staged.collect())
    assert [(f, s) for f, _, s in kept] == [
        ("A", "LAN"), ("A", "ACT"), ("B", "CAN"), ("C", "DEL"),
    ]


def test_bag_times(arrivals):
    rows = by_id(
        stage_arrivals(
            arrivals(
                dict(
                    flight_id="both",
                    first_bag="2026-01-25 12:00:00",
                    last_bag="2026-01-25 12:07:30",
                ),
                dict(flight_id="one", first_bag="2026-01-25 12:00:00"),
            )
        )
    )
    assert rows["both"].baggage_handling_minutes == 7.5
    assert rows["one"].baggage_handling_minutes is None
