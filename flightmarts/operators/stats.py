"""Exact statistics from tallies.

A median needs all values of its group in order. Shuffling rows by group would
send a busy group whole into one task, so statistics are taken in two steps:
rows are first tallied per group *and value* (a plain count, combined before
the shuffle, and spread over the values of a busy group). Only the tally, as
long as a group has distinct values, is then brought together per group, sorted
and numbered. Sort and window spill to disk, so no group has to fit in memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tally_mean(value: str, count: str) -> Column:
    """Mean of a tallied value; rows without a value do not take part."""
    known = F.col(value).isNotNull()
    total = F.sum(F.col(value) * F.col(count))
    return total / F.nullif(F.sum(F.when(known, F.col(count))), F.lit(0))


def tally_mean_minutes(value: str, count: str) -> Column:
    """Mean of tallied minutes between times, from whole microseconds.

    Such a sum is exact, so no rounding depends on the order of rows.
    """
    known = F.col(value).isNotNull()
    micros = F.round(F.col(value) * 60_000_000.0).cast("long")
    total = F.sum(micros * F.col(count)) / 60_000_000.0
    return total / F.nullif(F.sum(F.when(known, F.col(count))), F.lit(0))


def with_ranks(tally: DataFrame, group: list[str], value: str, count: str) -> DataFrame:
    """Adds to each tally row the ranks its value takes up within the group.

    A row takes up ranks ``<value>_from`` up to before ``<value>_to``, counted
    from 0, of ``<value>_total`` in the group; rows without a value none. The
    rows stay partitioned by group, so grouping them next needs no shuffle.
    """
    members = Window.partitionBy(*group)
    so_far = members.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    weight = F.when(F.col(value).isNotNull(), F.col(count)).otherwise(F.lit(0).cast("long"))
    ranked = tally.withColumn("weight", weight).withColumns(
        {
            f"{value}_to": F.sum("weight").over(so_far),
            f"{value}_total": F.sum("weight").over(members),
        }
    )
    return ranked.withColumn(f"{value}_from", F.col(f"{value}_to") - F.col("weight")).drop("weight")


def ranked_percentile(value: str, share: float) -> Column:
    """Exact percentile over rows from ``with_ranks``, between neighbours if need be."""
    position = (F.col(f"{value}_total") - 1) * F.lit(share)

    def at(rank: Column) -> Column:
        holds = (F.col(f"{value}_from") <= rank) & (rank < F.col(f"{value}_to"))
        return F.max(F.when(holds, F.col(value)))

    below, above = at(F.floor(position)), at(F.ceil(position))
    return below + (above - below) * F.max(position - F.floor(position))


def mean_of_rounded(mean: str, count: str) -> Column:
    """Count-weighted mean of means that carry two digits, to two digits.

    Sums whole hundredths, so the result does not depend on the row order.
    """
    hundredths = F.round(F.col(mean) * 100.0).cast("long")
    total = F.sum(hundredths * F.col(count))
    weight = F.nullif(F.sum(F.when(F.col(mean).isNotNull(), F.col(count))), F.lit(0))
    return F.round(total / weight) / 100.0
