"""What the operators share: tables, texts, stored intermediates, Arrow batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightmarts.session import scratch_path

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# One Arrow batch holds at most so many rows and, as far as Spark can tell, bytes.
BATCH_ROWS, BATCH_BYTES = 1000, 8_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space, as an array."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def row_key(doc_id: Column, mark: Column) -> Column:
    """A text that names a row by its id (null apart from all others) and a hash of its text.

    Keys of whole numbers from 0 on are in the order of the ids, null behind them.
    """
    return F.concat_ws(":", F.coalesce(F.lpad(doc_id.cast("string"), 20, "0"), F.lit("~")), F.hex(mark))


def small_batches(spark: SparkSession) -> None:
    """Rows reach Python workers in batches that fit beside an executor's heap."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Lost executors then cost no recomputation of what lies before. The files
    go when the driver ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _slot(columns: tuple[str, ...], words: int) -> dict[str, Column]:
    place = F.xxhash64(F.lit(7), *columns)
    return {
        "_word": F.pmod(place, F.lit(words)),
        "_bit": F.pmod(F.shiftright(place, 20), F.lit(64)).cast("int"),
    }


def bitmap(keys: DataFrame, *columns: str, words: int = 1 << 14) -> DataFrame:
    """Hashes of ``keys`` as a bitmap of ``words`` longs, whatever their number; stored."""
    return stored(
        keys.select(*[c.alias(n) for n, c in _slot(columns, words).items()])
        .groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits")),
        "bitmap",
    )


def flagged(df: DataFrame, bits: DataFrame, flag: str, *columns: str, words: int = 1 << 14) -> DataFrame:
    """``df`` with ``flag``: false if the key is surely not in the bitmap, which is broadcast."""
    hit = F.coalesce(F.expr("(shiftright(_bits, _bit) & 1L) = 1L"), F.lit(False))
    return (
        df.withColumns(_slot(columns, words)).join(F.broadcast(bits), "_word", "left")
        .withColumn(flag, hit).drop("_word", "_bit", "_bits")
    )
