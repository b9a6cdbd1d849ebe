from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from flightmarts.operators.latest import latest_per_key
from flightmarts.operators.shares import share_of_total, top
from flightmarts.operators.stats import (
    mean_of_rounded,
    ranked_percentile,
    tally_mean,
    with_ranks,
)


def quantile(values, share):
    values = sorted(values)
    position = (len(values) - 1) * share
    low, high = values[math.floor(position)], values[math.ceil(position)]
    return low + (high - low) * (position - math.floor(position))


@pytest.fixture(scope="module")
def numbers():
    rng = random.Random(3)
    groups = {
        "hot": [rng.randint(-50, 50) / 4 for _ in range(3000)],
        "one": [2.5],
        "two": [1.0, 4.0],
        "same": [7.0] * 9,
        "none": [None, None],
        "gaps": [None, 1.0, None, 3.0, 8.0],
    }
    for n in range(40):
        groups[f"g{n}"] = [rng.choice([None, rng.uniform(-5, 90)]) for _ in range(n)]
    return groups


@pytest.mark.parametrize("share", [0.0, 0.5, 0.9, 0.95, 1.0])
def test_ranked_percentile_is_exact(spark, numbers, share):
    rows = [(g, v) for g, values in numbers.items() for v in values]
    tally = spark.createDataFrame(rows, "g string, v double").groupBy("g", "v").count()
    found = (
        with_ranks(tally, ["g"], "v", "count")
        .groupBy("g")
        .agg(ranked_percentile("v", share).alias("p"), tally_mean("v", "count").alias("m"))
    )
    for row in found.collect():
        known = [v for v in numbers[row.g] if v is not None]
        if not known:
            assert (row.p, row.m) == (None, None)
        else:
            assert row.p == pytest.approx(quantile(known, share), abs=1e-9)
            assert row.m == pytest.approx(sum(known) / len(known), abs=1e-9)


def test_ranks_agree_with_the_built_in_percentile_on_repeated_values(spark):
    # The same value in several rows of a tally, as in a tally of two values.
    rows = [("a", v, n) for v, n in [(1.0, 2), (1.0, 3), (2.0, 1), (9.0, 4), (9.0, 1), (None, 5)]]
    tally = spark.createDataFrame(rows, "g string, v double, n bigint")
    for share in (0.1, 0.5, 0.75, 0.9):
        ours = with_ranks(tally, ["g"], "v", "n").groupBy("g").agg(
            ranked_percentile("v", share).alias("p")
        )
        builtin = tally.groupBy("g").agg(F.percentile("v", share, F.col("n")).alias("p"))
        assert ours.first().p == pytest.approx(builtin.first().p)


def test_mean_of_rounded_weighs_by_count(spark):
    rows = [(10.25, 1), (20.5, 3), (None, 0)]
    df = spark.createDataFrame(rows, "m double, n bigint")
    assert df.agg(mean_of_rounded("m", "n")).first()[0] == round((10.25 + 61.5) / 4 * 100) / 100
    assert df.filter("m IS NULL").agg(mean_of_rounded("m", "n")).first()[0] is None


def test_latest_compares_columns_in_turn(spark):
    rows = [("a", 1, "x"), ("a", 2, "b"), ("a", 2, "c"), ("b", None, "z"), ("b", 0, "a"), (None, 1, "n")]
    df = spark.createDataFrame(rows, "k string, load int, row string")
    kept = latest_per_key(df, ["k"], ["load", "row"])
    assert sorted(map(tuple, kept.collect()), key=str) == [
        ("a", 2, "c"), ("b", 0, "a"), (None, 1, "n"),
    ]
    assert kept.columns == df.columns


def test_share_and_top(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3), ("d", 0)], "k string, n bigint")
    shares = {r.k: r.s for r in df.withColumn("s", share_of_total("n")).collect()}
    assert shares == {"a": 14.29, "b": 42.86, "c": 42.86, "d": 0.0}
    assert [r.k for r in top(df, 2, "n", ["k"]).collect()] == ["b", "c"]
