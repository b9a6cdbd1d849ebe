"""Stored models: one Parquet folder per model, grouped by layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmarts.functions import date_key
from flightmarts.plans.flights import FACT_COLUMNS, UNIFIED_COLUMNS
from flightmarts.plans.marts import ORDER, in_order
from flightmarts.plans.warehouse import KEYED_FLIGHTS

_LAYERS = {
    KEYED_FLIGHTS: "facts",
    "dim_airline": "dimensions",
    "dim_airport": "dimensions",
    "dim_date": "dimensions",
    "mart_airline_punctuality": "marts",
    "mart_airport_hourly_traffic": "marts",
    "mart_airport_punctuality": "marts",
    "mart_baggage_performance": "marts",
    "mart_route_popularity": "marts",
    "airline_numbers": "dimensions",
    "tally_airport_delays": "states",
    "tally_airline_delays": "states",
    "tally_baggage": "states",
    "state_hourly_airlines": "states",
    "state_route_airlines": "states",
}

_DAY = "flight_date_key"
# Marts lie in folders by month and day, named by these.
_MART_PARTITIONS = ["month_key", "day_key"]
DAILY_MARTS = [name for name, layer in _LAYERS.items() if layer == "marts"]
# States lie in a folder per day, as the flights do.
DAILY_STATES = [name for name, layer in _LAYERS.items() if layer == "states"]


def with_folders(mart: DataFrame) -> DataFrame:
    """A mart with the month and day its rows lie under."""
    day = F.col("flight_date")
    return mart.withColumns(
        {"month_key": F.date_format(day, "yyyy-MM"), "day_key": date_key(day)}
    )


@dataclass
class ParquetStore:
    """Writes models and reads them back.

    Flights are stored once, with their keys, in one folder per day; the
    unified relation and the fact are column subsets of that table. Staging
    stays a view, as do all models not listed in a layer.
    """

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{_LAYERS[name]}/{name}"

    def keep(self, name: str, model: DataFrame) -> DataFrame:
        """Stores a model if it belongs to a layer; gives back what to read on."""
        if name in _LAYERS:
            self.write(name, model)
            model = self.read(name, model)
        model.createOrReplaceTempView(name)
        return model

    def write(self, name: str, model: DataFrame) -> None:
        """Full refresh of one model."""
        if name == KEYED_FLIGHTS or name in DAILY_MARTS or name in DAILY_STATES:
            self._write_days(name, model, "static")
            return
        ordered = in_order(model, name) if name in ORDER else model
        ordered.write.mode("overwrite").parquet(self.path(name))

    def replace_days(self, name: str, model: DataFrame) -> None:
        """Rewrites the days ``model`` holds and leaves all others alone."""
        self._write_days(name, model, "dynamic")

    def _write_days(self, name: str, model: DataFrame, overwrite: str) -> None:
        # Rows of a day meet in few files; a day too big for one file is split,
        # small days share a task.
        if name == KEYED_FLIGHTS:
            folders, order = [_DAY], [_DAY, "flight_type"]
        elif name in DAILY_STATES:
            folders, order = [_DAY], [_DAY, *model.columns[:1]]
        else:
            folders = _MART_PARTITIONS
            model = with_folders(model)
            order = [*folders, *ORDER[name]]
        (
            model.hint("rebalance", *folders).sortWithinPartitions(*order)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", overwrite)
            .partitionBy(*folders)
            .parquet(self.path(name))
        )

    def append(self, name: str, rows: DataFrame) -> None:
        """Adds rows to a model that is kept whole and only ever grows."""
        rows.write.mode("append").parquet(self.path(name))

    def read(self, name: str, like: DataFrame) -> DataFrame:
        """The stored model, with known columns so that no file is opened to infer them."""
        schema = like.schema
        if name in DAILY_MARTS:
            schema = T.StructType([*schema.fields]).add("month_key", "string").add("day_key", "integer")
        stored = self.spark.read.schema(schema).parquet(self.path(name))
        return stored.select(*like.columns)

    def open_mart(self, name: str) -> DataFrame:
        """A stored mart with its folder columns, which ``serving.pick`` prunes by."""
        return self.spark.read.parquet(self.path(name)).withColumn(
            "month_key", F.col("month_key").cast("string")
        )

    def open(self, name: str) -> DataFrame:
        """A stored model by name, in a later session."""
        columns = {"fct_flights": FACT_COLUMNS, "int_flights": UNIFIED_COLUMNS}.get(name)
        if columns is None:
            return self.spark.read.parquet(self.path(name)).drop(*_MART_PARTITIONS)
        return self.spark.read.parquet(self.path(KEYED_FLIGHTS)).select(*columns)
