from __future__ import annotations

import json
from types import SimpleNamespace

import pytest
from conftest import SF_DIR

from flightmarts import __main__ as cli
from flightmarts.session import fit_shuffles, scratch_dir


@pytest.fixture()
def restored(spark):
    """Puts the settings these tests touch back."""
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_shuffles_start_by_what_is_read_within_bounds(spark, restored):
    before = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    assert fit_shuffles(spark, lines) == before
    grown = fit_shuffles(spark, lines, bytes_per_partition=1_000)
    assert grown > before
    narrow = fit_shuffles(spark, lines.select("l_orderkey"), bytes_per_partition=1_000)
    assert before <= narrow < grown
    assert fit_shuffles(spark, lines, bytes_per_partition=1, most=500) == 500
    # A later, smaller command starts small again, and the session's own number stays.
    assert fit_shuffles(spark, lines) == before
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == before


def session_like(master, settings):
    return SimpleNamespace(
        conf=SimpleNamespace(get=settings.get), sparkContext=SimpleNamespace(master=master)
    )


def test_scratch_is_the_folder_the_cluster_names():
    shared = session_like("yarn", {"spark.checkpoint.dir": "hdfs:///shared"})
    assert scratch_dir(shared) == "hdfs:///shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session_like("yarn", {}))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session_like("yarn", {"spark.checkpoint.dir": "file:/tmp/x"}))
    local = session_like("local[4]", {})
    assert scratch_dir(local) != scratch_dir(local)


def test_command_line_from_landing_to_checks(spark, restored, tmp_path, capsys):
    folder = tmp_path / "landing" / "date=2026-01-25" / "airport=ARN" / "direction=arrivals"
    folder.mkdir(parents=True)
    leg = {"flightId": "SK1", "departureAirportIata": "GOT", "arrivalAirportIata": "ARN"}
    flight = {
        "flightId": "SK1",
        "flightLegIdentifier": leg,
        "airlineOperator": {"name": "Airline SK", "iata": "SK"},
        "arrivalTime": {"scheduledUtc": "2026-01-25T10:00:00Z"},
        "locationAndStatus": {"flightLegStatus": "SCH"},
    }
    (folder / "a.json").write_text(json.dumps({"numberOfFlights": 1, "flights": [flight]}))
    landing, bronze, warehouse = (str(tmp_path / n) for n in ("landing", "bronze", "warehouse"))

    assert cli.main(
        ["load", "--landing", landing, "--bronze", bronze, "--airports", " arn ,got",
         "--backfill-days", "2", "--until", "2026-01-26"]
    ) == 0
    stores = ["--bronze", bronze, "--warehouse", warehouse]
    assert cli.main(["build", *stores]) == 0
    assert cli.main(["refresh", *stores, "--since", "2026-01-25"]) == 0
    assert cli.main(["check", *stores]) == 0
    shown = capsys.readouterr().out
    assert "flights_arrivals_raw" in shown and "quality" not in shown
    assert spark.table("mart_airport_punctuality").count() == 1

    flight["locationAndStatus"]["flightLegStatus"] = "???"
    (folder / "b.json").write_text(json.dumps({"numberOfFlights": 1, "flights": [flight]}))
    cli.main(["load", "--landing", landing, "--bronze", bronze, "--until", "2026-01-25",
              "--load-id", "9999999999"])
    assert cli.main(["check", *stores]) == 1
