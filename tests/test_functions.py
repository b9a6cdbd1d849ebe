from __future__ import annotations

import hashlib

import pytest
from conftest import at
from pyspark.sql import functions as F

from flightmarts import functions as X
from flightmarts.constants import NULL_KEY_TEXT


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize(
    ("value", "rounded"),
    [(1.005, 1.0), (1.015, 1.01), (-1.005, -1.0), (2.675, 2.68), (0.125, 0.13), (-0.125, -0.13),
     (0.0, 0.0), (15.0, 15.0), (79.225, 79.22), (None, None)],
)
def test_round2_decides_on_the_binary_value(spark, value, rounded):
    assert one(spark, X.round2(F.lit(value).cast("double"))) == (rounded,)


def test_percent_is_double_and_null_for_an_empty_whole(spark):
    row = spark.range(1).select(
        X.percent(F.lit(1), F.lit(3)).alias("third"), X.percent(F.lit(1), F.lit(0)).alias("none")
    )
    assert row.dtypes == [("third", "double"), ("none", "double")]
    assert tuple(row.first()) == (33.33, None)


def test_minutes_are_signed_fractional_and_null_safe(spark):
    a, b = F.lit(at("2026-01-25 10:00:01")), F.lit(at("2026-01-25 09:45:00"))
    nothing = F.lit(None).cast("timestamp")
    assert one(spark, X.minutes_between(a, b), X.minutes_between(b, a)) == (901 / 60, -901 / 60)
    assert one(spark, X.minutes_between(nothing, b), X.minutes_between(a, nothing)) == (None, None)


def test_weekday_is_iso(spark):
    monday, sunday = F.lit(at("2026-01-26 00:00:00")), F.lit(at("2026-01-25 23:59:59"))
    assert one(spark, X.iso_weekday(monday), X.day_name(monday)) == (1, "Monday")
    assert one(spark, X.iso_weekday(sunday), X.day_name_short(sunday)) == (7, "Sun")


def test_month_names_and_date_key(spark):
    day = F.lit(at("2026-09-05 12:00:00"))
    assert one(spark, X.month_name(day), X.month_name_short(day), X.date_key(day)) == (
        "September", "Sep", 20260905,
    )


@pytest.mark.parametrize(
    ("hour", "label"),
    [(5, "Night/Red-eye (22:00-05:59)"), (6, "Morning (06:00-11:59)"),
     (11, "Morning (06:00-11:59)"), (12, "Midday/Afternoon (12:00-16:59)"),
     (16, "Midday/Afternoon (12:00-16:59)"), (17, "Evening (17:00-21:59)"),
     (21, "Evening (17:00-21:59)"), (22, "Night/Red-eye (22:00-05:59)"),
     (None, "Night/Red-eye (22:00-05:59)")],
)
def test_time_period(spark, hour, label):
    assert one(spark, X.time_period(F.lit(hour).cast("int"))) == (label,)


def test_flags_are_never_null(spark):
    nothing = F.lit(None)
    assert one(
        spark,
        X.is_status(nothing.cast("string"), "DEL"),
        X.is_listed_airport(nothing.cast("string")),
        X.is_on_time(nothing.cast("double")),
    ) == (False, False, False)


def test_on_time_limit(spark):
    late = [X.is_on_time(F.lit(m)) for m in (-30.0, 0.0, 15.0, 15.0 + 1 / 60)]
    assert one(spark, *late) == (True, True, True, False)


def test_surrogate_key_text(spark):
    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    day, nothing = F.lit(at("2026-01-01 00:00:00")), F.lit(None).cast("string")
    assert one(
        spark,
        X.surrogate_key(F.lit("ARN"), day, F.lit(True), F.lit(7)),
        X.surrogate_key(nothing),
        X.surrogate_key(F.lit("a"), nothing),
    ) == (
        md5("ARN-2026-01-01 00:00:00-true-7"), md5(NULL_KEY_TEXT), md5(f"a-{NULL_KEY_TEXT}"),
    )
