"""Marts: daily aggregates of the flight fact, one function each.

What follows from a key (the week from the day, the part of the day from the hour)
is put back on the aggregated rows, so that it is neither read nor shuffled; what
a mart leaves out, such as airports not covered, is left out before the shuffle.

Rows come back unordered; ``ORDER`` names each mart's published order, which
the writer stores and ``in_order`` applies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from flightmarts.constants import ON_TIME_MINUTES
from flightmarts.functions import (
    day_name,
    iso_weekday,
    percent,
    round2,
    surrogate_key,
    time_period,
)
from flightmarts.operators.star import (
    PERIOD_COLUMNS,
    at_listed_airports,
    at_own_airport,
    other_airport,
    own_airport,
    with_periods,
)
from flightmarts.operators.stats import ranked_percentile, tally_mean_minutes, with_ranks
from flightmarts.plans import tallies
from flightmarts.plans.tallies import flown_delay, is_active, is_flown

# Column → descending?
ORDER: dict[str, dict[str, bool]] = {
    "dim_date": {"date_day": False},
    "mart_airline_punctuality": {
        "airline_iata": False, "flight_date": False, "flight_type": False, "is_domestic": False,
    },
    "mart_airport_hourly_traffic": {
        "airport_iata": False, "flight_date": False, "flight_hour": False, "flight_type": False,
    },
    "mart_airport_punctuality": {
        "airport_iata": False, "flight_date": False, "flight_type": False, "is_domestic": False,
    },
    "mart_baggage_performance": {
        "airport_iata": False, "flight_date": False, "baggage_claim_unit": False,
    },
    "mart_route_popularity": {"airport_iata": False, "flight_date": False, "flight_count": True},
}


def in_order(df: DataFrame, model: str) -> DataFrame:
    order = ORDER[model]
    return df.orderBy(*[F.desc(c) if descending else F.asc(c) for c, descending in order.items()])


def _sum(name: str) -> Column:
    return F.sum(name).alias(name)


def _sum_where(condition: Column, name: str) -> Column:
    """Sum of a tally over the rows a condition holds for; 0 if there are none."""
    return F.sum(F.when(condition, F.col(name)).otherwise(F.lit(0).cast("long")))


def _split_by_domestic(total: str) -> dict[str, Column]:
    """Both halves of ``total`` where domestic is part of the grouping."""
    domestic, none = F.col("is_domestic"), F.lit(0).cast("long")
    return {
        "domestic_flights": F.when(domestic, F.col(total)).otherwise(none),
        "international_flights": F.when(~domestic, F.col(total)).otherwise(none),
    }


def _delay_cells(tally: DataFrame, key: str) -> GroupedData:
    """A tally of delays with its ranks, ready to be put together per cell."""
    cell = [key, "flight_date_key", "flight_type", "is_domestic"]
    return with_ranks(tally, cell, "delay", "completed_flights").groupBy(*cell)


def _delay_stats() -> list[Column]:
    return [
        round2(tally_mean_minutes("delay", "completed_flights")).alias("avg_delay_minutes"),
        round2(F.min("delay")).alias("min_delay_minutes"),
        round2(F.max("delay")).alias("max_delay_minutes"),
        round2(ranked_percentile("delay", 0.5)).alias("median_delay_minutes"),
    ]


def airline_punctuality(fact: DataFrame, dim_airline: DataFrame) -> DataFrame:
    """Airline, day, direction, domestic. On time means 0 up to under 15 minutes late.

    Flights without an airline have no dimension row and are left out first. The
    airline dimension comes from the data, so how to join it is left to its size.
    """
    delay = F.col("delay")
    cells = (
        _delay_cells(tallies.airline_delays(fact), "airline_key")
        .agg(
            _sum("total_flights"),
            _sum_where(
                (delay >= 0) & (delay < ON_TIME_MINUTES), "completed_flights"
            ).alias("on_time_flights"),
            _sum_where(delay >= ON_TIME_MINUTES, "completed_flights").alias("delayed_flights"),
            _sum_where(delay < 0, "completed_flights").alias("early_flights"),
            _sum("cancelled_flights"),
            _sum("completed_flights"),
            *_delay_stats(),
        )
    )
    cells = with_periods(cells.join(dim_airline, "airline_key", "inner"))
    cells = cells.withColumns(_split_by_domestic("total_flights"))
    done, total = F.col("completed_flights"), F.col("total_flights")
    return cells.select(
        surrogate_key("airline_iata", "flight_date", "flight_type", "is_domestic").alias(
            "airline_punctuality_key"
        ),
        "airline_iata", "airline_name", *PERIOD_COLUMNS, "flight_type", "is_domestic",
        "total_flights", "on_time_flights", "delayed_flights", "early_flights",
        "cancelled_flights", "completed_flights",
        "avg_delay_minutes", "min_delay_minutes", "max_delay_minutes", "median_delay_minutes",
        "domestic_flights", "international_flights",
        percent(F.col("on_time_flights"), done).alias("on_time_percentage"),
        percent(F.col("delayed_flights"), done).alias("delayed_percentage"),
        percent(F.col("early_flights"), done).alias("early_percentage"),
        percent(F.col("cancelled_flights"), total).alias("cancelled_percentage"),
    )


def airport_punctuality(fact: DataFrame) -> DataFrame:
    """Airport, day, direction, domestic. On time means up to 15 minutes late.

    Early flights count as on time *and* as ahead of schedule, so the three
    percentages may add up to more than 100.
    """
    delay = F.col("delay")
    cells = (
        _delay_cells(tallies.airport_delays(fact), "airport_iata")
        .agg(
            _sum("total_flights"),
            _sum("cancelled_flights"),
            _sum("completed_flights"),
            _sum_where(delay < 0, "completed_flights").alias("ahead_of_schedule_flights"),
            F.sum("within_limit_flights").alias("on_time_flights"),
            _sum_where(delay > ON_TIME_MINUTES, "completed_flights").alias("delayed_flights"),
            *_delay_stats(),
        )
    )
    cells = with_periods(cells).withColumns(_split_by_domestic("total_flights"))
    done, total = F.col("completed_flights"), F.col("total_flights")
    return cells.select(
        surrogate_key("airport_iata", "flight_date", "flight_type", "is_domestic").alias(
            "punctuality_key"
        ),
        "airport_iata", *PERIOD_COLUMNS, "flight_type", "is_domestic",
        "total_flights", "cancelled_flights", "completed_flights",
        "ahead_of_schedule_flights", "on_time_flights", "delayed_flights",
        "avg_delay_minutes", "min_delay_minutes", "max_delay_minutes", "median_delay_minutes",
        "domestic_flights", "international_flights",
        percent(F.col("cancelled_flights"), total).alias("cancelled_percentage"),
        percent(F.col("ahead_of_schedule_flights"), done).alias("ahead_of_schedule_percentage"),
        percent(F.col("on_time_flights"), done).alias("on_time_percentage"),
        percent(F.col("delayed_flights"), done).alias("delayed_percentage"),
        percent(done, total).alias("completion_rate"),
    )


def airport_hourly_traffic(fact: DataFrame) -> DataFrame:
    """Airport, day, hour, direction.

    Counting distinct airlines makes Spark aggregate per cell and airline
    first, which also spreads a busy cell. The airline count includes deleted
    flights and counts "no airline" as one.
    """
    domestic = F.col("is_domestic")
    cells = at_own_airport(fact).groupBy(
        "airport_iata", "flight_date_key", "flight_hour", "flight_type"
    ).agg(
        F.count_if(is_active()).alias("flight_count"),
        F.count_if(domestic & is_active()).alias("domestic_flights"),
        F.count_if(~domestic & is_active()).alias("international_flights"),
        F.count_distinct("airline_key").alias("unique_airlines"),
        round2(F.avg(flown_delay())).alias("avg_delay_minutes"),
        F.count_if(F.col("is_on_time") & is_flown()).alias("on_time_flights"),
        F.count_if(is_flown()).alias("completed_flights"),
    )
    return with_periods(cells).select(
        surrogate_key("airport_iata", "flight_date", "flight_hour", "flight_type").alias(
            "hourly_traffic_key"
        ),
        "airport_iata", *PERIOD_COLUMNS, "flight_hour",
        time_period(F.col("flight_hour")).alias("flight_time_period"),
        "flight_type", "flight_count", "domestic_flights", "international_flights", "unique_airlines",
        "avg_delay_minutes", "on_time_flights", "completed_flights",
    )


def baggage_performance(fact: DataFrame) -> DataFrame:
    """Airport, carousel, day, hour, domestic; arrivals with a known carousel."""
    cell = tallies.BAGGAGE_CELL
    tally = tallies.baggage(fact)
    tally = with_ranks(tally, cell, "handling", "flights")
    tally = with_ranks(tally, cell, "delay", "flights")
    cells = tally.groupBy(*cell).agg(
        _sum_where(F.col("handling").isNotNull(), "flights").alias("flights_with_baggage_data"),
        F.sum("flights").alias("total_arrivals"),
        round2(tally_mean_minutes("handling", "flights")).alias("avg_baggage_handling_minutes"),
        round2(ranked_percentile("handling", 0.5)).alias(
            "median_baggage_handling_minutes"
        ),
        round2(F.min("handling")).alias("min_baggage_handling_minutes"),
        round2(F.max("handling")).alias("max_baggage_handling_minutes"),
        round2(ranked_percentile("handling", 0.90)).alias("p90_baggage_handling_minutes"),
        round2(ranked_percentile("handling", 0.95)).alias("p95_baggage_handling_minutes"),
        round2(tally_mean_minutes("delay", "flights")).alias("avg_flight_delay_minutes"),
        round2(ranked_percentile("delay", 0.5)).alias("median_flight_delay_minutes"),
    )
    cells = with_periods(cells).withColumns(
        {
            "flight_time_period": time_period(F.col("flight_hour")),
            "flight_day_of_week": iso_weekday(F.col("flight_date")),
            "flight_day_name": day_name(F.col("flight_date")),
        }
    )
    return cells.select(
        surrogate_key(
            "airport_iata", "baggage_claim_unit", "flight_date", "is_domestic",
            "flight_hour", "flight_day_of_week",
        ).alias("baggage_performance_key"),
        "airport_iata", "baggage_claim_unit", "is_domestic", *PERIOD_COLUMNS,
        "flight_hour", "flight_time_period", "flight_day_of_week", "flight_day_name",
        "flights_with_baggage_data", "total_arrivals",
        "avg_baggage_handling_minutes", "median_baggage_handling_minutes",
        "min_baggage_handling_minutes", "max_baggage_handling_minutes",
        "p90_baggage_handling_minutes", "p95_baggage_handling_minutes",
        "avg_flight_delay_minutes", "median_flight_delay_minutes",
    )


def route_popularity(fact: DataFrame) -> DataFrame:
    """Airport, route, day, direction; both ends must be listed airports."""
    origin, destination = "origin_airport_iata", "destination_airport_iata"
    cells = at_listed_airports(fact, origin, destination).groupBy(
        origin, destination, "route_key", "flight_type", "is_domestic", "flight_date_key",
    ).agg(
        F.count_if(is_active()).alias("flight_count"),
        F.count_distinct("airline_key").alias("unique_airlines"),
        F.count_if("is_cancelled").alias("cancelled_flights"),
    )
    cells = cells.withColumns(
        {
            "airport_iata": own_airport(destination, origin),
            "other_airport_iata": other_airport(destination, origin),
        }
    )
    return with_periods(cells).select(
        surrogate_key("airport_iata", "route_key", "flight_date", "flight_type").alias(
            "route_popularity_key"
        ),
        "airport_iata", "route_key", origin, destination, "other_airport_iata",
        "flight_type", "is_domestic", *PERIOD_COLUMNS,
        "flight_count", "unique_airlines", "cancelled_flights",
    )
