"""Share of a grand total, and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightmarts.functions import percent


def share_of_total(amount: str | Column) -> Column:
    """``amount`` in percent of its sum over all rows.

    The total runs over one partition: use it on aggregated rows whose number
    is bounded by their keys (airports, weekdays, flags), never on flights.
    """
    amount = F.col(amount) if isinstance(amount, str) else amount
    return percent(amount, F.sum(amount).over(Window.partitionBy()))


def top(df: DataFrame, k: int, by: str, ties: list[str]) -> DataFrame:
    """The ``k`` greatest rows; ``ties`` makes the cut repeatable."""
    return df.orderBy(F.col(by).desc(), *ties).limit(k)
