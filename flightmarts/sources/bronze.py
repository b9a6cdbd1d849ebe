"""Raw tables: append-only, a folder per load date, flight day, airport and ``timed``.

A load selects airports and days, so it fills folders of its own and replacing
it touches no others. ``timed`` keeps flights without a scheduled time apart:
they belong to no day, and a refresh of some days must still find all of them.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmarts import schemas
from flightmarts.constants import RAW_ARRIVALS, RAW_DEPARTURES
from flightmarts.sources.landing import ARRIVALS, DEPARTURES, raw_rows, read_landing

TABLES = {ARRIVALS: RAW_ARRIVALS, DEPARTURES: RAW_DEPARTURES}
_SCHEMAS = {RAW_ARRIVALS: schemas.ARRIVALS_RAW, RAW_DEPARTURES: schemas.DEPARTURES_RAW}
SCHEDULED = {
    RAW_ARRIVALS: "arrival_time__scheduled_utc",
    RAW_DEPARTURES: "departure_time__scheduled_utc",
}
# The whole flight as it was landed, beside the typed columns.
PAYLOAD = "payload"
PARTITIONS = ["load_date", "flight_day", "timed", "airport"]


def append_raw(rows: DataFrame, path: str) -> None:
    """Add rows to a raw table, in files of even size.

    Landed documents are small and many; without the rebalance every read task
    would leave a small file behind.
    """
    (
        rows.hint("rebalance", *PARTITIONS)
        .write.mode("append")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def replace_raw(rows: DataFrame, path: str) -> None:
    """Rewrite the folders present in ``rows`` (re-run of a backfill) and no others.

    A folder is filled by one load date, day and airport. Rows must hold all
    flights of theirs, as ``ingest`` makes sure by reading whole documents.
    """
    (
        rows.hint("rebalance", *PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def ingest(
    spark: SparkSession,
    landing: str,
    bronze: str,
    load_id: str,
    load_date: str,
    airports: list[str] | None = None,
    dates: list[str] | None = None,
    replace: bool = False,
    one_per_line: bool = False,
) -> None:
    """Landed documents of both directions into the two raw tables.

    ``replace`` rewrites what this ``load_date`` holds of the selected airports and
    days, and leaves its other airports and days alone.
    """
    for direction, table in TABLES.items():
        docs = read_landing(
            spark, landing, direction, airports, dates, one_per_line=one_per_line
        )
        rows = raw_rows(docs, direction, load_id).withColumnRenamed("date", "flight_day")
        rows = rows.withColumns(
            {"load_date": F.lit(load_date), "timed": F.col(SCHEDULED[table]).isNotNull()}
        )
        (replace_raw if replace else append_raw)(rows, f"{bronze}/{table}")


def conform_raw(df: DataFrame, table: str) -> DataFrame:
    """Raw columns in their declared types; columns a source lacks become NULL.

    Zone-less timestamps are taken as UTC.
    """
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in _SCHEMAS[table].fields
        ],
        *[c for c in ("airport", "load_date") if c in present],
    )


def read_raw(spark: SparkSession, bronze: str, table: str) -> DataFrame:
    schema = T.StructType(
        _SCHEMAS[table].fields
        + [T.StructField(c, T.StringType()) for c in (PAYLOAD, "airport", "flight_day", "load_date")]
        + [T.StructField("timed", T.BooleanType())]
    )
    return spark.read.schema(schema).parquet(f"{bronze}/{table}")


def in_days(raw: DataFrame, table: str, since: dt.date | str, until: dt.date | str) -> DataFrame:
    """Raw flights scheduled in a span of days, and all without a scheduled time.

    The folders of these days are enough, with one more at either end as the
    day of a document is a local one; the exact time decides. A raw table
    without such folders is filtered by time alone.
    """
    scheduled = F.col(SCHEDULED[table])
    first = F.lit(str(since)).cast("timestamp")
    after = F.lit(str(until)).cast("timestamp") + F.expr("INTERVAL 1 DAY")
    if {"flight_day", "timed"} <= set(raw.columns):
        day = dt.timedelta(days=1)
        low, high = dt.date.fromisoformat(str(since)) - day, dt.date.fromisoformat(str(until)) + day
        raw = raw.filter(
            F.col("flight_day").between(low.isoformat(), high.isoformat()) | ~F.col("timed")
        )
    return raw.filter(scheduled.isNull() | ((scheduled >= first) & (scheduled < after)))


def merge_sources(*frames: DataFrame) -> DataFrame:
    """Many sources into one raw table; a column missing in one becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def load_summary(arrivals: DataFrame, departures: DataFrame) -> DataFrame:
    """Rows per raw table and airport, to check a load by."""
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("airport").agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "airport", "row_count"
        )

    return counted(arrivals, RAW_ARRIVALS).union(counted(departures, RAW_DEPARTURES))


def airports_loaded(raw: DataFrame) -> DataFrame:
    """Distinct airports of a raw table, sorted."""
    return raw.select("airport").distinct().orderBy("airport")
