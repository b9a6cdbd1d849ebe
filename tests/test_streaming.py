"""Exactly-once loads of landed files."""

from __future__ import annotations

import os

import pytest
from test_ingest import flight, land, landed  # noqa: F401

from flightmarts.constants import RAW_ARRIVALS, RAW_DEPARTURES
from flightmarts.plans.warehouse import Models
from flightmarts.sources import bronze
from flightmarts.streaming import ingest


@pytest.fixture()
def run(spark, landed, tmp_path):  # noqa: F811
    def go(**options):
        paths = [str(landed), str(tmp_path / "bronze"), str(tmp_path / "checkpoint")]
        return ingest.load_new(spark, *paths, **options)

    return go


def rows(spark, tmp_path, table=RAW_ARRIVALS):
    return sorted(map(str, bronze.read_raw(spark, str(tmp_path / "bronze"), table).drop("load_date").collect()))


def test_new_files_only(spark, landed, run, tmp_path):  # noqa: F811
    first = run()
    assert {(r.table_name, r.row_count) for r in first.collect()} == {(RAW_ARRIVALS, 3), (RAW_DEPARTURES, 1)}
    before = rows(spark, tmp_path)
    assert run().count() == 2 and rows(spark, tmp_path) == before
    # A file that was read is not opened again: damage to it goes unnoticed.
    (landed / "date=2026-01-24" / "airport=ARN" / "direction=arrivals" / "a.json").write_text("damaged")
    land(landed, "2026-01-26", "ARN", "arrivals", [flight("SK9", "GOT", "ARN", "2026-01-26T10:00:00Z", True)])
    ledger = run()
    assert len(rows(spark, tmp_path)) == 4
    assert sorted(r.batch_id for r in ledger.collect()) == [0, 0, 1, 1]


@pytest.mark.parametrize("tables_written", [0, 1, 2])
def test_a_killed_load_leaves_the_same_rows(spark, landed, run, tmp_path, tables_written):  # noqa: F811
    class Killed(Exception):
        pass

    def dies(docs, batch_id, path):
        calls = []
        replace = ingest.replace_raw

        def write(some, where):
            if len(calls) == tables_written:
                raise Killed
            calls.append(where)
            replace(some, where)
            if len(calls) == tables_written == 2:
                raise Killed

        ingest.replace_raw = write
        try:
            ingest.write_batch(docs, batch_id, path)
        finally:
            ingest.replace_raw = replace

    with pytest.raises(Exception, match="Killed"):
        run(write=dies)
    assert ingest.complete_batches(spark, str(tmp_path / "bronze")).count() == 0
    ledger = run()
    assert {(r.batch_id, r.row_count) for r in ledger.collect()} == {(0, 3), (0, 1)}
    raw = {t: bronze.read_raw(spark, str(tmp_path / "bronze"), t) for t in (RAW_ARRIVALS, RAW_DEPARTURES)}
    assert raw[RAW_ARRIVALS].count() == 3 == raw[RAW_ARRIVALS].select("_dlt_id").distinct().count()
    assert raw[RAW_DEPARTURES].count() == 1
    assert Models(raw, "2026-01-25")["fct_flights"].count() == 4


def test_a_batch_that_is_in_the_ledger_is_not_written_again(spark, landed, run, tmp_path):  # noqa: F811
    run()
    before = rows(spark, tmp_path)
    ingest.write_batch(spark.createDataFrame([], "flights array<string>, direction string"), 0, str(tmp_path / "bronze"))
    assert rows(spark, tmp_path) == before


def test_later_files_supersede(spark, landed, run, tmp_path):  # noqa: F811
    run(files_per_batch=1)
    name = "b.json"
    land(landed, "2026-01-24", "ARN", "arrivals", [
        flight("SK3", "GOT", "ARN", "2026-01-24T10:00:00Z", True, "2026-01-24T10:30:00Z"),
    ], name)
    path = landed / "date=2026-01-24" / "airport=ARN" / "direction=arrivals" / name
    os.utime(path, (4_000_000_000, 4_000_000_000))
    ledger = run(files_per_batch=1)
    assert ledger.select("batch_id").distinct().count() == 5
    raw = {t: bronze.read_raw(spark, str(tmp_path / "bronze"), t) for t in (RAW_ARRIVALS, RAW_DEPARTURES)}
    staged = {r.flight_id: r for r in Models(raw, "2026-01-25")["stg_flights_arrivals"].collect()}
    assert staged["SK3"].delay_minutes == 30.0 and staged["SK3"]._dlt_load_id == "4000000000"


def test_missing_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ingest.load_new(spark, str(tmp_path / "none"), str(tmp_path / "b"), str(tmp_path / "c"))
