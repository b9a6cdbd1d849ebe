"""Marts of weeks, months, quarters and years, from the stored daily states alone.

Counts are summed, medians and percentiles taken from summed tallies, distinct
airlines counted in or-ed bits: all exact, and no flight is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightmarts.constants import ON_TIME_MINUTES
from flightmarts.functions import percent, round2
from flightmarts.operators.star import with_periods
from flightmarts.operators.stats import ranked_percentile, tally_mean_minutes, with_ranks
from flightmarts.plans.tallies import DELAY_COUNTS

PERIODS = ("week", "month", "quarter", "year")


def in_periods(state: DataFrame, period: str) -> DataFrame:
    """Daily rows with the first day of their period as ``period_start``."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}")
    return with_periods(state).withColumn("period_start", F.date_trunc(period, "flight_date"))


def _sums(names: list[str]) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def _percentiles(value: str, label: str, **shares: float) -> list[Column]:
    return [
        round2(ranked_percentile(value, share)).alias(f"{name}_{label}") for name, share in shares.items()
    ]


def _delays(tally: DataFrame, key: str, period: str) -> DataFrame:
    cell = [key, "period_start", "flight_type", "is_domestic"]
    merged = in_periods(tally, period).groupBy(*cell, "delay").agg(*_sums(DELAY_COUNTS))
    delay, flown = F.col("delay"), F.col("completed_flights")
    where = lambda condition: F.coalesce(F.sum(F.when(condition, flown)), F.lit(0).cast("long"))
    return (
        with_ranks(merged, cell, "delay", "completed_flights").groupBy(*cell)
        .agg(
            *_sums(DELAY_COUNTS[:3]),
            F.sum("within_limit_flights").alias("within_limit_flights"),
            where(delay < 0).alias("early_flights"),
            where((delay >= 0) & (delay < ON_TIME_MINUTES)).alias("punctual_flights"),
            where(delay >= ON_TIME_MINUTES).alias("late_flights"),
            where(delay > ON_TIME_MINUTES).alias("over_limit_flights"),
            round2(tally_mean_minutes("delay", "completed_flights")).alias("avg_delay_minutes"),
            round2(F.min("delay")).alias("min_delay_minutes"),
            round2(F.max("delay")).alias("max_delay_minutes"),
            *_percentiles("delay", "delay_minutes", median=0.5, p90=0.9),
        )
    )


_DELAY_STATS = [f"{s}_delay_minutes" for s in ("avg", "min", "max", "median", "p90")]


def airport_punctuality(tally: DataFrame, period: str) -> DataFrame:
    """Airport, period, direction, domestic; on time up to 15 minutes late, as in the daily mart."""
    done, total = F.col("completed_flights"), F.col("total_flights")
    return _delays(tally, "airport_iata", period).select(
        "airport_iata", "period_start", "flight_type", "is_domestic",
        "total_flights", "cancelled_flights", "completed_flights",
        F.col("early_flights").alias("ahead_of_schedule_flights"),
        F.col("within_limit_flights").alias("on_time_flights"),
        F.col("over_limit_flights").alias("delayed_flights"),
        *_DELAY_STATS,
        percent(F.col("within_limit_flights"), done).alias("on_time_percentage"),
        percent(F.col("cancelled_flights"), total).alias("cancelled_percentage"),
        percent(done, total).alias("completion_rate"),
    )


def airline_punctuality(tally: DataFrame, dim_airline: DataFrame, period: str) -> DataFrame:
    """Airline code, period, direction, domestic; on time 0 up to under 15 minutes late.

    By code and not by name: an airline with two names has one row.
    """
    codes = dim_airline.select("airline_key", "airline_iata").distinct()
    done, total = F.col("completed_flights"), F.col("total_flights")
    return _delays(tally, "airline_key", period).join(codes, "airline_key").select(
        "airline_iata", "period_start", "flight_type", "is_domestic",
        "total_flights", "cancelled_flights", "completed_flights",
        "early_flights", F.col("punctual_flights").alias("on_time_flights"),
        F.col("late_flights").alias("delayed_flights"),
        *_DELAY_STATS,
        percent(F.col("punctual_flights"), done).alias("on_time_percentage"),
        percent(F.col("cancelled_flights"), total).alias("cancelled_percentage"),
    )


def baggage_performance(tally: DataFrame, period: str) -> DataFrame:
    """Airport, carousel, period, domestic."""
    cell = ["airport_iata", "baggage_claim_unit", "period_start", "is_domestic"]
    merged = in_periods(tally, period).groupBy(*cell, "handling", "delay").agg(*_sums(["flights"]))
    ranked = with_ranks(with_ranks(merged, cell, "handling", "flights"), cell, "delay", "flights")
    handled = F.sum(F.when(F.col("handling").isNotNull(), F.col("flights")))
    return ranked.groupBy(*cell).agg(
        F.coalesce(handled, F.lit(0).cast("long")).alias("flights_with_baggage_data"),
        F.sum("flights").alias("total_arrivals"),
        round2(tally_mean_minutes("handling", "flights")).alias("avg_baggage_handling_minutes"),
        *_percentiles("handling", "baggage_handling_minutes", median=0.5, p90=0.90, p95=0.95),
        *_percentiles("delay", "flight_delay_minutes", median=0.5),
    )


def distinct_airlines(state: DataFrame, cell: list[str], period: str) -> DataFrame:
    """``unique_airlines`` per cell and period; ``cell`` may leave out parts of the daily one."""
    words = in_periods(state, period).groupBy(*cell, "period_start", "word").agg(
        F.bit_or("bits").alias("bits")
    )
    return words.groupBy(*cell, "period_start").agg(
        F.sum(F.bit_count("bits")).cast("long").alias("unique_airlines")
    )
