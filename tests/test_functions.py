"""Ratings, votes, times, bins and records."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.functions import bins, display, ratings, records
from opinara.operators.projections import with_sentiment


def test_rating_boundaries(spark):
    df = spark.createDataFrame([(0.0,), (2.5,), (2.999,), (3.0,), (3.5,), (5.0,), (None,), (float("nan"),)], "overall float")
    codes = [r.sentiment for r in with_sentiment(df).collect()]
    assert codes == [0, 0, 0, 1, 2, 2, 2, 2]
    assert with_sentiment(df, null_rating="drop").count() == 7
    with pytest.raises(ValueError):
        with_sentiment(df, null_rating="other")


def test_label_names(spark):
    df = spark.createDataFrame([("positive",), ("neutral",), ("negative",), ("odd",), (None,)], "label string")
    shown = [r[0] for r in df.select(ratings.label_display(F.col("label"))).collect()]
    assert shown == ["Positive", "Neutral", "Negative", "Unknown", "Unknown"]


def test_votes(spark):
    df = spark.createDataFrame([("[1, 2]",), ("[0, 0]",), ("[3]",), ("nonsense",), (None,)], "helpful string")
    votes = ratings.parse_helpful(df)
    up, total = ratings.helpful_votes(votes), ratings.total_votes(votes)
    got = [r[:] for r in df.select(up, total, ratings.helpfulness_ratio(up, total)).collect()]
    assert got == [(1, 2, 0.5), (0, 0, 0.0), (3, None, 0.0), (None, None, 0.0), (None, None, 0.0)]


def test_iso_follows_python(spark):
    times = [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 60), dt.datetime(2024, 12, 31, 23, 59, 59, 999999)]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    text = df.select(display.iso(F.col("ts")).alias("t"), "ts")
    assert [r.t for r in text.collect()] == [t.isoformat() for t in times]
    assert [r[0] for r in text.select(display.parse_iso(F.col("t"))).collect()] == times


def test_bad_time_is_null(spark):
    df = spark.createDataFrame([("yesterday",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(display.parse_iso(F.col("t"))).collect()] == [None, None, None]


def test_percent(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (0.12345,)], "x double")
    assert [r[0] for r in df.select(display.percent(F.col("x"))).collect()] == ["50.00", "100.00", "12.35"]


@pytest.mark.parametrize("n", [1, 7, 20, 30])
def test_bins_follow_numpy(spark, n):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.random(300), np.arange(21) / 20, [0.6, 0.15, 0.3, 1.0, 0.0]])
    low, high = values.min(), values.max()
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = df.groupBy(bins.bin_no(F.col("v"), F.lit(float(low)), F.lit(float(high)), n).alias("b")).count().collect()
    expected, _ = np.histogram(values, bins=n)
    assert {r["b"]: r["count"] for r in got} == {i: c for i, c in enumerate(expected) if c}


def test_defaults(spark):
    df = spark.createDataFrame([(None, 1.0), ("x", None)], "a string, b double")
    out = records.default_fields(df, {"a": "none", "c": [0, 0], "d": None})
    assert out.columns == ["b", "a", "c", "d"]
    assert [r[:] for r in out.collect()] == [(1.0, "none", [0, 0], None), (None, "x", [0, 0], None)]


def test_typed(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(records.typed(F.col("t"), "float", 0.0)).collect()] == [1.5, 0.0, 0.0]
