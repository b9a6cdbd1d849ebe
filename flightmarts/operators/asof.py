"""Last known value at a time, and intervals joined by bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR = 3600


def _bin(at: Column, seconds: int) -> Column:
    return F.floor(F.unix_seconds(at) / seconds)


def last_known(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    time: str,
    observed: str,
    values: list[str],
    max_age: int,
    bin_seconds: int = HOUR,
) -> DataFrame:
    """``left`` plus ``observed`` and ``values`` of the last row of ``right`` at or before ``time``.

    Both tables share the key columns ``by``. An observation older than ``max_age``
    seconds counts as none, and all columns of ``right`` are null then, as for
    rows without a key or time. Of observations at one time the greatest by
    ``values`` in their order counts. Every row of ``left`` comes out once;
    observations without a key or time are ignored.

    No join: rows of both tables meet per key *and bin of time* and are read in
    order, so a key with a third of all rows is spread over its bins. What a bin
    needs from before it is one row each of the earlier bins within ``max_age``,
    found by a maximum that map tasks combine. A bin's rows spill. Callers with
    many rows at one time group them first.
    """
    seen = F.struct(F.col(observed), *values)
    known = right.filter(F.col(observed).isNotNull())
    for key in by:
        known = known.filter(F.col(key).isNotNull())
    known = known.select(
        *by, F.col(observed).alias("_at"), _bin(F.col(observed), bin_seconds).alias("_bin"),
        seen.alias("_seen"),
    )
    later = F.sequence(F.lit(1), F.lit(-(-max_age // bin_seconds)))
    carried = (
        known.groupBy(*by, "_bin").agg(F.max("_seen").alias("_seen"))
        .withColumn("_step", F.explode(later))
        .select(*by, F.col(f"_seen.{observed}").alias("_at"), (F.col("_bin") + F.col("_step")).alias("_bin"), "_seen")
    )
    row = F.struct(*left.columns)
    # Rows without a time have no bin; a hash keeps them from meeting in one task.
    spread = F.coalesce(_bin(F.col(time), bin_seconds), F.xxhash64(*left.columns))
    asked = left.select(*by, F.col(time).alias("_at"), spread.alias("_bin"), row.alias("_row"))
    in_order = (
        Window.partitionBy(*by, "_bin").orderBy("_at", F.col("_row").isNotNull(), "_seen")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    read = (
        known.unionByName(carried).unionByName(asked, allowMissingColumns=True)
        .withColumn("_last", F.last("_seen", ignorenulls=True).over(in_order))
        .filter(F.col("_row").isNotNull())
    )
    age = F.unix_micros(F.col("_at")) - F.unix_micros(F.col(f"_last.{observed}"))
    fresh = F.when(age <= max_age * 1_000_000, F.col("_last"))
    return read.select("_row.*", fresh.alias("_last")).select(*left.columns, "_last.*")


def merged_spans(spans: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """Half-open intervals of a key without overlaps: those that overlap or touch become one.

    An ``end`` of null lasts for ever. Intervals that are empty or have no start or
    key are dropped. The window runs over distinct intervals, in order of start.
    """
    open_ended = F.coalesce(F.col(end), F.lit("9999-12-31").cast(dict(spans.dtypes)[start]))
    clean = spans.select(*by, start, open_ended.alias("_end")).filter(F.col(start) < F.col("_end"))
    for key in by:
        clean = clean.filter(F.col(key).isNotNull())
    # Of intervals with one start the longest holds the others.
    clean = clean.groupBy(*by, start).agg(F.max("_end").alias("_end"))
    in_order = Window.partitionBy(*by).orderBy(start)
    reached = F.max("_end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce((F.col(start) > reached).cast("int"), F.lit(1))
    return (
        clean.withColumn("_apart", apart).withColumn("_island", F.sum("_apart").over(in_order))
        .groupBy(*by, "_island").agg(F.min(start).alias(start), F.max("_end").alias("_end"))
        .select(*by, start, F.when(F.col("_end") < F.lit("9999-12-31"), F.col("_end")).alias(end))
    )


def within_spans(
    points: DataFrame, spans: DataFrame, by: list[str], day: str, start: str, end: str, until: Column, bin_days: int = 32
) -> DataFrame:
    """``points`` joined to the spans ``[start, end)`` of their key that hold their ``day``.

    Days and spans meet by equality of key and bin of ``bin_days`` days, so the join
    is a hash or merge join that adaptive execution can split, and no range of a
    key is compared with all its points. A span is repeated once per bin it
    touches; one without an end is cut at ``until``, a day after all points.
    """
    number = F.unix_date(F.col(day).cast("date"))
    last = F.least(F.coalesce(F.col(end).cast("date"), until.cast("date")), until.cast("date"))
    first_bin = F.floor(F.unix_date(F.col(start).cast("date")) / bin_days)
    last_bin = F.floor((F.unix_date(last) - 1) / bin_days)
    binned = spans.filter(F.col(start).cast("date") < last).withColumn(
        "_bin", F.explode(F.sequence(first_bin, last_bin))
    )
    inside = (F.col(day) >= F.col(start)) & (F.col(end).isNull() | (F.col(day) < F.col(end)))
    return (
        points.withColumn("_bin", F.floor(number / bin_days))
        .join(binned, [*by, "_bin"]).filter(inside).drop("_bin")
    )
