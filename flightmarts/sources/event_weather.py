"""Weather observations and alliance memberships derived from the test tables.

The test data holds neither, so events are read as observations at airports and
orders as memberships, by integer arithmetic on their columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flightmarts.constants import AIRPORT_CODES

_CODES = ", ".join(f"'{c}'" for c in AIRPORT_CODES)
_AIRLINES = "'SK', 'DY', 'FR', 'LH', 'AY', 'KL', 'BA', 'W6', 'FI', 'EW', 'D8'"


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``airport_iata, observed_at, condition, wind``: events, two years (731 days) later, to the minute."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.selectExpr(
        f"get(array({_CODES}), int(user_id % 10)) AS airport_iata",
        "date_trunc('minute', CAST(ts AS TIMESTAMP)) + INTERVAL 731 DAYS AS observed_at",
        "event_type AS condition", "value AS wind",
    )


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``alliance, airline_iata, valid_from, valid_before``: orders as times of membership.

    An airline is in several groups, overlaps itself, and some have no end.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    start = "date_add(DATE'2025-12-20', int(o_custkey % 80))"
    return orders.selectExpr(
        "concat('Group ', string(1 + o_orderkey % 5)) AS alliance",
        f"get(array({_AIRLINES}), int(o_custkey % 11)) AS airline_iata",
        f"{start} AS valid_from",
        f"CASE WHEN o_orderkey % 97 <> 0 THEN date_add({start}, int(o_orderkey % 4)) END AS valid_before",
    )
