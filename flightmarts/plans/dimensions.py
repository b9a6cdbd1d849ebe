"""Airline, airport and date dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightmarts.constants import AIRPORTS, CALENDAR_FIRST_DAY, CALENDAR_LAST_DAY
from flightmarts.functions import (
    date_key,
    day_name,
    day_name_short,
    iso_weekday,
    month_name,
    month_name_short,
    surrogate_key,
)


def airline_dimension(flights: DataFrame) -> DataFrame:
    """Distinct airline code and name; a code with two names keeps both rows."""
    airlines = flights.filter(F.col("airline_iata").isNotNull())
    return airlines.select("airline_iata", "airline_name").distinct().select(
        surrogate_key("airline_iata").alias("airline_key"), "airline_iata", "airline_name"
    )


def airport_dimension(spark: SparkSession) -> DataFrame:
    """The ten fixed airports."""
    rows = ", ".join(f"('{iata}', '{name}')" for iata, name in AIRPORTS)
    airports = spark.sql(f"SELECT * FROM VALUES {rows} AS airports(airport_iata, airport_name)")
    return airports.select(
        surrogate_key("airport_iata").alias("airport_key"), "airport_iata", "airport_name"
    )


def date_dimension(
    spark: SparkSession,
    as_of: dt.date | str | None = None,
    first_day: str = CALENDAR_FIRST_DAY,
    last_day: str = CALENDAR_LAST_DAY,
) -> DataFrame:
    """One row per day; ``as_of`` (today) anchors the relative flags."""
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    days = (dt.date.fromisoformat(last_day) - dt.date.fromisoformat(first_day)).days + 1
    day = F.col("date_day")

    def number(part: Column) -> Column:
        return part.cast("long")

    start = F.lit(first_day).cast("date")
    calendar = spark.range(0, days, 1, 1).select(
        F.date_add(start, F.col("id").cast("int")).cast("timestamp").alias("date_day")
    )
    calendar = calendar.filter(day <= F.lit(last_day).cast("timestamp"))
    on = day.cast("date")
    return calendar.select(
        "date_day",
        date_key(day).alias("date_key"),
        number(F.year(day)).alias("year"),
        number(F.quarter(day)).alias("quarter"),
        number(F.month(day)).alias("month"),
        month_name(day).alias("month_name"),
        month_name_short(day).alias("month_name_short"),
        number(F.weekofyear(day)).alias("week_number"),
        F.date_trunc("week", day).alias("week_start_date"),
        number(F.dayofmonth(day)).alias("day_of_month"),
        iso_weekday(day).alias("day_of_week"),
        day_name(day).alias("day_name"),
        day_name_short(day).alias("day_name_short"),
        iso_weekday(day).isin(6, 7).alias("is_weekend"),
        number(F.year(day)).alias("fiscal_year"),
        (on == today).alias("is_today"),
        on.between(F.trunc(today, "month"), today).alias("is_current_month"),
        on.between(F.trunc(today, "year"), today).alias("is_current_year"),
    )


# Holidays on a fixed day (month, day), and counted from Easter Sunday.
_FIXED_HOLIDAYS = {
    "New Year's Day": (1, 1), "Epiphany": (1, 6), "May Day": (5, 1), "National Day": (6, 6),
    "Christmas Day": (12, 25), "Second Day of Christmas": (12, 26),
}
_FROM_EASTER = {
    "Good Friday": -2, "Easter Sunday": 0, "Easter Monday": 1, "Ascension Day": 39, "Whit Sunday": 49,
}
# The Saturday from a day (month, day) on.
_SATURDAYS = {"Midsummer Day": (6, 20), "All Saints' Day": (10, 31)}


def easter_sunday(year: Column) -> Column:
    """Easter of the Gregorian calendar, from the year's golden number and century."""
    def over(x: Column, n: int) -> Column:
        return F.floor(x / n).cast("int")

    golden, century, rest = year % 19, over(year, 100), year % 100
    moon = century - over(century, 4) - over(century - over(century + 8, 25) + 1, 3)
    epact = (19 * golden + moon + 15) % 30
    weekday = (32 + 2 * (century % 4) + 2 * over(rest, 4) - epact - rest % 4) % 7
    days = epact + weekday - 7 * over(golden + 11 * epact + 22 * weekday, 451) + 114
    return F.make_date(year, over(days, 31), days % 31 + 1)


def holiday_dimension(
    spark: SparkSession, first_day: str = CALENDAR_FIRST_DAY, last_day: str = CALENDAR_LAST_DAY
) -> DataFrame:
    """``date_key, holiday_name`` of the public holidays in the calendar's years, one row per day.

    Where two fall on one day, the name that comes first in the alphabet stays.
    """
    year = F.col("year")
    years = spark.range(int(first_day[:4]), int(last_day[:4]) + 1, 1, 1).select(
        F.col("id").cast("int").alias("year")
    ).withColumn("easter", easter_sunday(year))

    def on(month: int, day: int) -> Column:
        return F.make_date(year, F.lit(month), F.lit(day))

    dates = {name: on(*day) for name, day in _FIXED_HOLIDAYS.items()}
    dates |= {name: F.date_add("easter", n) for name, n in _FROM_EASTER.items()}
    # The Saturday on or after a day is the one after the day before.
    dates |= {name: F.next_day(F.date_sub(on(*day), 1), "Sat") for name, day in _SATURDAYS.items()}
    rows = F.array(
        *[F.struct(date_key(d.cast("timestamp")).alias("date_key"), F.lit(n).alias("name")) for n, d in dates.items()]
    )
    return years.select(F.inline(rows)).groupBy("date_key").agg(F.min("name").alias("holiday_name"))
