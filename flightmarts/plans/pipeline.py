"""From landed payloads to stored marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightmarts.constants import RAW_ARRIVALS, RAW_DEPARTURES
from flightmarts.plans import tallies
from flightmarts.plans.dimensions import airline_dimension
from flightmarts.plans.quality import quality_report
from flightmarts.plans.warehouse import KEYED_FLIGHTS, Models
from flightmarts.session import use_utc
from flightmarts.sources import bronze as raw_layer
from flightmarts.sources.tables import DAILY_MARTS, DAILY_STATES, ParquetStore

def load(
    spark: SparkSession,
    landing: str,
    bronze: str,
    load_id: str,
    load_date: str,
    airports: list[str] | None = None,
    dates: list[str] | None = None,
    replace: bool = False,
    one_per_line: bool = False,
) -> DataFrame:
    """Appends landed payloads to the raw tables; returns the load summary."""
    use_utc(spark)
    raw_layer.ingest(
        spark, landing, bronze, load_id, load_date, airports, dates, replace, one_per_line
    )
    raw = raw_tables(spark, bronze)
    return raw_layer.load_summary(raw[RAW_ARRIVALS], raw[RAW_DEPARTURES])


def raw_tables(spark: SparkSession, bronze: str) -> dict[str, DataFrame]:
    """Both raw tables by name, also registered as temporary views."""
    raw = {
        table: raw_layer.read_raw(spark, bronze, table) for table in (RAW_ARRIVALS, RAW_DEPARTURES)
    }
    for table, rows in raw.items():
        rows.createOrReplaceTempView(table)
    return raw


def build(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    warehouse: str,
    as_of: dt.date | str | None = None,
) -> dict[str, DataFrame]:
    """Builds and stores all models from the raw tables; returns them by name.

    Each model is also registered as a temporary view under its name.
    """
    use_utc(spark)
    return Models(raw, as_of, ParquetStore(spark, warehouse).keep).build_all()


def refresh(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    warehouse: str,
    since: dt.date | str,
    until: dt.date | str,
    as_of: dt.date | str | None = None,
) -> dict[str, DataFrame]:
    """Like ``build``, but only flights scheduled from ``since`` to ``until`` are redone.

    Versions of a flight share its scheduled time, so a day's flights depend on
    raw rows of that day alone: only the raw folders of these days are read,
    and only these days of the stored flights and marts are replaced. Flights
    without a scheduled time belong to no day and are always redone.

    A mart's rows belong to a day too. Only the airlines' mart also depends on
    all names of an airline, so it is rebuilt whole when those have changed.
    The daily states of longer periods are replaced day by day too.
    """
    use_utc(spark)
    window = {table: raw_layer.in_days(rows, table, since, until) for table, rows in raw.items()}
    store = ParquetStore(spark, warehouse)
    store.replace_days(KEYED_FLIGHTS, Models(window)[KEYED_FLIGHTS])
    flights = store.read(KEYED_FLIGHTS, Models(raw)[KEYED_FLIGHTS])

    airlines = airline_dimension(flights)
    known = store.open("dim_airline")
    changed = known.exceptAll(airlines).union(airlines.exceptAll(known)).head(1)
    first, last = (int(str(day).replace("-", "")) for day in (since, until))
    some = flights.filter(F.col("flight_date_key").between(first, last))
    # Airlines keep their numbers, which states of all days share; new ones get the next.
    known = store.read("airline_numbers", Models(raw)["airline_numbers"])
    store.append("airline_numbers", tallies.new_airlines(some, known))
    redone = {KEYED_FLIGHTS: some, "airline_numbers": store.read("airline_numbers", known)}
    partial = Models(raw, as_of, lambda name, model: redone.get(name, model))

    def keep(name: str, model: DataFrame) -> DataFrame:
        if name in redone:
            return store.read(name, model)
        if name in DAILY_STATES or name in DAILY_MARTS and not (name == "mart_airline_punctuality" and changed):
            store.replace_days(name, partial[name])
            model = store.read(name, model)
            model.createOrReplaceTempView(name)
            return model
        return store.keep(name, model)

    return Models(raw, as_of, keep).build_all()


def _stored(store: ParquetStore, staged: Models, name: str) -> DataFrame:
    if name.startswith("stg_"):
        return staged[name]
    # A mart without rows has no files to tell its columns.
    return store.read(name, staged[name]) if name in DAILY_MARTS or name in DAILY_STATES else store.open(name)


def check(spark: SparkSession, raw: dict[str, DataFrame], warehouse: str) -> DataFrame:
    """The quality report over the stored models and the staging views on ``raw``."""
    use_utc(spark)
    store = ParquetStore(spark, warehouse)
    staged = Models(raw)
    tables = {
        name: _stored(store, staged, name)
        for name in staged
        if name != KEYED_FLIGHTS
    }
    return quality_report(tables)
