"""Exactly-once loading of landed files: a file stream, and a ledger of its batches.

The stream's checkpoint knows which files have been seen, so a run opens new
files only. A batch that was cut short comes again with the same files and the
same number; its rows lie in folders of that number alone, which a repeat
replaces, and the ledger says which batches are complete. A load that was killed
at any point and started again leaves the same raw rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmarts import schemas
from flightmarts.session import use_utc
from flightmarts.sources.bronze import SCHEDULED, TABLES, replace_raw
from flightmarts.sources.landing import exists, raw_rows

LEDGER = "load_batches"
_LEDGER_SCHEMA = "batch_id bigint, table_name string, row_count bigint, first_load string, last_load string"


def landed_files(
    spark: SparkSession, landing: str, files_per_batch: int = 1000, one_per_line: bool = False
) -> DataFrame:
    """Stream of landed documents with their folders' columns and a load id.

    The load id is the second a file was written, ten digits: it rises with time,
    and a batch that is repeated gives its rows the same one.
    """
    folders = [T.StructField(name, T.StringType()) for name in ("date", "airport", "direction")]
    docs = (
        spark.readStream.schema(T.StructType(schemas.UNTYPED_PAYLOAD.fields + folders))
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing, multiLine=not one_per_line, mode="FAILFAST")
    )
    written = F.unix_timestamp(F.col("_metadata.file_modification_time"))
    return docs.withColumn("load_id", F.lpad(written.cast("string"), 10, "0"))


def batch_folder(batch_id: int) -> str:
    """What raw rows of a batch have as ``load_date``."""
    return f"batch-{batch_id:010d}"


def complete_batches(spark: SparkSession, bronze: str) -> DataFrame:
    """The ledger: a row per complete batch and raw table."""
    path = f"{bronze}/{LEDGER}"
    if not exists(spark, path):
        return spark.createDataFrame([], _LEDGER_SCHEMA)
    return spark.read.schema(_LEDGER_SCHEMA).parquet(path)


def write_batch(docs: DataFrame, batch_id: int, bronze: str) -> None:
    """Both raw tables' rows of a batch, then its lines of the ledger; again if asked again."""
    spark = docs.sparkSession
    if not complete_batches(spark, bronze).filter(F.col("batch_id") == batch_id).isEmpty():
        return
    counts: DataFrame | None = None
    for direction, table in TABLES.items():
        own = docs.filter(F.col("direction") == direction).drop("direction")
        rows = raw_rows(own, direction, F.col("load_id")).withColumnRenamed("date", "flight_day")
        folder = batch_folder(batch_id)
        rows = rows.withColumns(
            {"load_date": F.lit(folder), "timed": F.col(SCHEDULED[table]).isNotNull()}
        )
        replace_raw(rows, f"{bronze}/{table}")
        path = f"{bronze}/{table}/load_date={folder}"
        # A batch without flights in this direction has no folder.
        written = spark.read.parquet(path) if exists(spark, path) else rows.limit(0)
        line = written.agg(
            F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(table).alias("table_name"),
            F.count("*").alias("row_count"),
            F.min("_dlt_load_id").alias("first_load"), F.max("_dlt_load_id").alias("last_load"),
        )
        counts = line if counts is None else counts.unionByName(line)
    counts.coalesce(1).write.mode("append").parquet(f"{bronze}/{LEDGER}")


def load_new(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    one_per_line: bool = False,
    write: Callable[[DataFrame, int, str], None] = write_batch,
) -> DataFrame:
    """Loads what has landed since the last run, in batches, and ends; returns the ledger.

    ``checkpoint`` belongs to one landing folder and one bronze folder for good.
    """
    use_utc(spark)
    if not exists(spark, landing):
        raise FileNotFoundError(f"no landing folder {landing}")
    run = (
        landed_files(spark, landing, files_per_batch, one_per_line)
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda docs, batch_id: write(docs, batch_id, bronze))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return complete_batches(spark, bronze)
