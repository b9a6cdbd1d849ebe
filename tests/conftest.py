from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flightmarts import schemas  # noqa: E402
from flightmarts.session import get_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        master="local[8]",
        shuffle_partitions=8,
        **{
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> dt.datetime:
    """A UTC time as Spark takes it from Python, whatever the local zone."""
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


_LEG = "flight_leg_identifier__"
_SHORT = {
    "origin": f"{_LEG}departure_airport_iata",
    "dest": f"{_LEG}arrival_airport_iata",
    "airline": "airline_operator__iata",
    "airline_name": "airline_operator__name",
    "status": "location_and_status__flight_leg_status",
    "carousel": "baggage__baggage_claim_unit",
    "first_bag": "baggage__first_bag_utc",
    "last_bag": "baggage__last_bag_utc",
    "load": "_dlt_load_id",
    "row": "_dlt_id",
}


def _raw(spark, schema, direction, rows):
    short = dict(
        _SHORT,
        sched=f"{direction}_time__scheduled_utc",
        actual=f"{direction}_time__actual_utc",
    )
    defaults = {"load": "1", "row": "a", "status": "LAN", "origin": "ARN", "dest": "GOT"}
    full = []
    for n, row in enumerate(rows):
        named = {short.get(k, k): v for k, v in {**defaults, "flight_id": f"F{n}", **row}.items()}
        full.append(
            tuple(
                at(v) if isinstance(v, str) and name.endswith("_utc") else v
                for name, v in ((f, named.get(f)) for f in schema.names)
            )
        )
    return spark.createDataFrame(full, schema)


@pytest.fixture(scope="session")
def arrivals(spark):
    return lambda *rows: _raw(spark, schemas.ARRIVALS_RAW, "arrival", rows)


@pytest.fixture(scope="session")
def departures(spark):
    return lambda *rows: _raw(spark, schemas.DEPARTURES_RAW, "departure", rows)
