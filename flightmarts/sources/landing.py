"""Landed flight payloads: nested JSON to flat raw rows.

Expected layout, one document per airport, direction and day:

    <landing>/date=2026-01-25/airport=ARN/direction=arrivals/*.json

Date, airport and direction are partition columns. A backfill window and an
airport list name the folders to look into, so that a daily load neither lists
nor opens what landed before.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmarts import schemas
from flightmarts.constants import AIRPORT_CODES

ARRIVALS, DEPARTURES = "arrivals", "departures"
_PAYLOADS = {ARRIVALS: schemas.ARRIVALS_PAYLOAD, DEPARTURES: schemas.DEPARTURES_PAYLOAD}
_RAW = {ARRIVALS: schemas.ARRIVALS_RAW, DEPARTURES: schemas.DEPARTURES_RAW}
_FLIGHTS = {ARRIVALS: schemas.ARRIVAL_FLIGHT, DEPARTURES: schemas.DEPARTURE_FLIGHT}


def airport_list(text: str | None = None) -> list[str]:
    """``" arn, Got"`` → ``["ARN", "GOT"]``; all airports by default."""
    if text is None:
        return list(AIRPORT_CODES)
    return [part.strip().upper() for part in text.split(",") if part.strip()]


def backfill_dates(days: int = 1, until: dt.date | str | None = None) -> list[str]:
    """The last ``days`` dates, latest first, ending at ``until`` (today)."""
    if until is None:
        until = dt.datetime.now(dt.timezone.utc).date()
    last = dt.date.fromisoformat(str(until))
    return [(last - dt.timedelta(days=n)).isoformat() for n in range(days)]


def snake_case(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()


def _leaves(struct: T.StructType, path: str, label: str) -> Iterator[tuple[str, str]]:
    for field in struct.fields:
        field_path, field_label = f"{path}`{field.name}`", label + snake_case(field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, f"{field_path}.", f"{field_label}__")
        else:
            yield field_path, field_label


def flatten(df: DataFrame) -> DataFrame:
    """Every nested field becomes ``parent__child``, in snake case."""
    return df.select([F.col(path).alias(label) for path, label in _leaves(df.schema, "", "")])


def read_landing(
    spark: SparkSession,
    path: str,
    direction: str,
    airports: list[str] | None = None,
    dates: list[str] | None = None,
    mode: str = "FAILFAST",
    one_per_line: bool = False,
) -> DataFrame:
    """Payload documents of one direction, with ``date`` and ``airport``.

    A file holds one document, read by one task; with ``one_per_line`` it holds
    a document per line and is split by size.

    A damaged document stops the load by default: skipping it would lose
    flights silently. Missing fields are fine and read as NULL, and a window
    in which nothing landed is empty; a missing landing folder is an error.

    Flights are read as their JSON text and typed afterwards, so that what the
    schema does not name is still there to be kept.
    """
    if not exists(spark, path):
        raise FileNotFoundError(f"no landing folder {path}")
    schema = T.StructType(
        schemas.UNTYPED_PAYLOAD.fields
        + [T.StructField(name, T.StringType()) for name in ("date", "airport", "direction")]
    )
    folders = f"{path}/{_level('date', dates)}/{_level('airport', airports)}/direction={direction}"
    reader = spark.read.schema(schema).option("basePath", path)
    try:
        docs = reader.json(folders, multiLine=not one_per_line, mode=mode)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        docs = spark.createDataFrame([], schema)
    docs = docs.filter(F.col("direction") == direction).drop("direction")
    return in_window(docs, airports, dates)


def _level(name: str, values: list[str] | None) -> str:
    """Folder pattern of one partition column."""
    return f"{name}=*" if values is None else f"{name}={{{','.join(values)}}}"


def in_window(
    docs: DataFrame, airports: list[str] | None = None, dates: list[str] | None = None
) -> DataFrame:
    """Documents of the given airports and days; what is left out does not restrict."""
    for column, wanted in (("airport", airports), ("date", dates)):
        if wanted is not None:
            docs = docs.filter(F.col(column).isin(wanted))
    return docs


def parse_payload(text: Column, direction: str) -> Column:
    """Payload held as JSON text in a column, for sources that are not files."""
    return F.from_json(text, _PAYLOADS[direction], {"mode": "FAILFAST"})


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, in whatever file system it names."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def raw_rows(docs: DataFrame, direction: str, load_id: str | Column) -> DataFrame:
    """One raw row per flight of every document.

    ``docs`` holds the payload's ``flights`` list; further columns (date,
    airport) are carried along behind the raw ones. A row id is the hash of
    the row and its load, so re-running a load gives the same ids. Flights
    given as JSON text are kept whole as ``payload`` beside the typed columns.
    """
    carried = [c for c in docs.columns if c not in ("numberOfFlights", "flights", "load_id")]
    load = F.lit(load_id) if isinstance(load_id, str) else load_id
    # A plain explode makes Spark test the list's size first, which parses the
    # JSON text of a computed payload again.
    flights = docs.select(
        F.explode_outer("flights").alias("flight"), load.alias("load"), *carried
    ).filter(F.col("flight").isNotNull())
    as_landed = isinstance(flights.schema["flight"].dataType, T.StringType)
    if as_landed:
        flights = flights.withColumns(
            {
                "payload": F.col("flight"),
                "flight": F.from_json("flight", _FLIGHTS[direction], {"mode": "FAILFAST"}),
            }
        )
        carried = ["payload", *carried]
    row_id = F.md5(F.concat_ws("|", F.col("load"), F.to_json(F.struct("flight"))))
    flat = flatten(flights.withColumn("row", row_id).select("flight.*", "load", "row", *carried))
    renamed = {"_dlt_load_id": "load", "_dlt_id": "row"}
    return flat.select(
        *[
            F.col(renamed.get(field.name, field.name)).cast(field.dataType).alias(field.name)
            for field in _RAW[direction].fields
        ],
        *carried,
    )
