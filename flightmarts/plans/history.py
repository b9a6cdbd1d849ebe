"""Names of an airline over the loads: periods of validity, and figures per period."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightmarts.constants import ARRIVAL, DEPARTURE, RAW_ARRIVALS, RAW_DEPARTURES
from flightmarts.functions import percent, round2
from flightmarts.plans.staging import stage_arrivals, stage_departures
from flightmarts.plans.tallies import is_active


def names_per_load(raw: dict[str, DataFrame]) -> DataFrame:
    """``airline_iata, load_id, airline_name``: the name most rows of a load carry; ties take the first.

    Rows are counted per code, name and load in map tasks, so that only counts meet.
    """
    code, name, load = "airline_operator__iata", "airline_operator__name", "_dlt_load_id"
    rows = [raw[table].select(code, name, load) for table in (RAW_ARRIVALS, RAW_DEPARTURES)]
    counted = (
        reduce(DataFrame.unionAll, rows)
        .filter(F.col(code).isNotNull() & F.col(name).isNotNull())
        .groupBy(F.col(code).alias("airline_iata"), F.col(load).alias("load_id"), F.col(name).alias("airline_name"))
        .agg(F.count("*").alias("n"))
    )
    return counted.groupBy("airline_iata", "load_id").agg(
        F.min_by("airline_name", F.struct(-F.col("n"), "airline_name")).alias("airline_name")
    )


def name_periods(per_load: DataFrame) -> DataFrame:
    """``airline_iata, airline_name, period_no, valid_from, valid_before``, in load ids.

    Runs of loads with one name; a period lasts until the next one of its airline
    begins (null: still valid). A name that returns has a period of its own. The
    windows run over a row per airline and load.
    """
    in_order = Window.partitionBy("airline_iata").orderBy("load_id")
    renamed = ~F.col("airline_name").eqNullSafe(F.lag("airline_name").over(in_order))
    runs = (
        per_load.withColumn("renamed", renamed.cast("int"))
        .withColumn("period_no", F.sum("renamed").over(in_order))
        .groupBy("airline_iata", "period_no", "airline_name").agg(F.min("load_id").alias("valid_from"))
    )
    by_period = Window.partitionBy("airline_iata").orderBy("period_no")
    return runs.withColumn("valid_before", F.lead("valid_from").over(by_period)).select(
        "airline_iata", "airline_name", F.col("period_no").cast("long").alias("period_no"),
        "valid_from", "valid_before",
    )


def punctuality_by_period(raw: dict[str, DataFrame], periods: DataFrame) -> DataFrame:
    """Latest versions of flights per airline *and name period* of the load that brought them.

    Flights are counted per airline and load first; these counts, a row per
    airline and load, are what the periods' intervals are joined to.
    """
    columns = ["airline_iata", "_dlt_load_id", "is_deleted", "is_cancelled", "delay_minutes"]
    staged = stage_arrivals(raw[RAW_ARRIVALS]).select(*columns).unionAll(
        stage_departures(raw[RAW_DEPARTURES]).select(*columns)
    )
    micros = F.round(F.col("delay_minutes") * 60_000_000.0).cast("long")
    per_load = (
        staged.filter(F.col("airline_iata").isNotNull())
        .groupBy("airline_iata", F.col("_dlt_load_id").alias("load_id"))
        .agg(
            F.count_if(is_active()).alias("total"), F.count_if("is_cancelled").alias("cancelled"),
            F.count("delay_minutes").alias("flown"), F.sum(micros).alias("late"),
        )
    )
    begun = F.col("load_id") >= F.col("valid_from")
    lasts = F.col("valid_before").isNull() | (F.col("load_id") < F.col("valid_before"))
    return (
        per_load.join(periods, "airline_iata").filter(begun & lasts)
        .groupBy("airline_iata", "airline_name", "period_no", "valid_from", "valid_before")
        .agg(
            F.sum("total").alias("total_flights"), F.sum("cancelled").alias("cancelled_flights"),
            F.sum("flown").alias("completed_flights"),
            round2(F.sum("late") / 60_000_000.0 / F.nullif(F.sum("flown"), F.lit(0))).alias("avg_delay_minutes"),
            percent(F.sum("cancelled"), F.sum("total")).alias("cancelled_percentage"),
        )
    )


def flights_by_load_date(raw: dict[str, DataFrame]) -> DataFrame:
    """Latest versions of flights by the day of the load that brought them, and direction.

    ``data_load_date`` is the day of the load id, which counts seconds; null for
    ids that are no number. ``ahead_flights`` were still to come when loaded.
    """
    loaded = F.timestamp_seconds(F.col("_dlt_load_id").try_cast("double"))
    staged = [
        stage(raw[table]).select(
            F.date_trunc("day", loaded).alias("data_load_date"), F.lit(direction).alias("flight_type"),
            (F.col(f"scheduled_{direction}_utc") > loaded).alias("ahead"),
            F.col(f"actual_{direction}_utc").isNotNull().alias("flown"),
        )
        for table, direction, stage in (
            (RAW_ARRIVALS, ARRIVAL, stage_arrivals), (RAW_DEPARTURES, DEPARTURE, stage_departures),
        )
    ]
    return reduce(DataFrame.unionAll, staged).groupBy("data_load_date", "flight_type").agg(
        F.count("*").alias("flights"), F.count_if("flown").alias("completed_flights"),
        F.count_if("ahead").alias("ahead_flights"),
    )
