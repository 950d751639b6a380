"""Profiles against numpy and pandas."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from opinara.operators import profile
from opinara.operators.quantiles import count_values, exact_quantiles


def column(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double").repartition(4)


@pytest.mark.parametrize("small", [20_000, 3])
@pytest.mark.parametrize(
    "values",
    [
        np.random.default_rng(0).normal(size=3001),
        np.concatenate([np.zeros(1000), np.random.default_rng(1).exponential(size=500)]),
        np.repeat([1.0, 2.0, 5.0], [700, 1, 2]),
        np.array([4.0]),
        np.array([1e12, 1.0, 2.0, 3.0, -1e12]),
    ],
)
def test_quantiles_are_exact(spark, values, small):
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    out = {r.share: r.value for r in exact_quantiles(count_values(column(spark, values), ["v"]), shares, small).collect()}
    assert set(out) == set(shares)
    for s in shares:
        assert out[s] == pytest.approx(np.quantile(values, s), rel=1e-12, abs=1e-12)


def test_a_million_distinct_values(spark):
    """Ranges are cut until they are small: no window sorts more than a bound."""
    df = spark.range(1_000_000).select((F.hash("id") + F.col("id") / 2e6).alias("v"))
    rows = np.sort(df.toPandas()["v"].to_numpy())
    found = exact_quantiles(count_values(df, ["v"]), [0.25, 0.5, 0.9], small=2_000)
    assert {r.share: r.value for r in found.collect()} == pytest.approx({s: np.quantile(rows, s) for s in (0.25, 0.5, 0.9)})


def test_describe_follows_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.integers(0, 5, 500).astype(float), "b": rng.random(500)})
    pdf.loc[::7, "b"] = None
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    out = {r["column"]: r for r in profile.describe_numeric(df, ["a", "b"]).collect()}
    expected = pdf.describe()
    for c in ("a", "b"):
        for ours, theirs in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
            assert out[c][ours] == pytest.approx(expected.loc[theirs, c])


@pytest.mark.parametrize("values", [np.random.default_rng(2).random(400), np.full(30, 2.5), np.arange(41) / 40])
def test_histogram_follows_numpy(spark, values):
    got = profile.histogram(column(spark, [*values, None]), F.col("v"), 20).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=20)
    assert [r.n for r in got] == list(counts)
    assert [r.left for r in got] == pytest.approx(list(edges[:-1]))
    assert [r.right for r in got] == pytest.approx(list(edges[1:]))


def test_density_follows_the_definition(spark):
    values = np.random.default_rng(5).gamma(2.0, size=300)
    values = np.concatenate([values, values[:50]])
    got = profile.density(column(spark, values), F.col("v"), 50).orderBy("point").collect()
    width = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 50)
    expected = [np.exp(-0.5 * ((g - values) / width) ** 2).sum() / (len(values) * width * np.sqrt(2 * np.pi)) for g in grid]
    assert [r.x for r in got] == pytest.approx(list(grid))
    assert [r.density for r in got] == pytest.approx(expected)


def test_density_over_cells_is_close(spark):
    values = np.random.default_rng(6).normal(size=2000)
    exact, close = (
        [r.density for r in profile.density(column(spark, values), F.col("v"), 40, c).orderBy("point").collect()] for c in (None, 500)
    )
    assert close == pytest.approx(exact, rel=0.05, abs=1e-3)


def test_approximate_distinct_counts(spark):
    df = spark.range(10000).select((F.col("id") % 1000).alias("k"))
    estimate = profile.distinct_counts(df, ["k"], 0.02).first()["distinct"]
    assert abs(estimate - 1000) < 100
    assert profile.distinct_counts(df, ["k"]).first()["distinct"] == 1000


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert {r["column"]: r.nulls for r in profile.null_counts(df).collect()} == {"a": 1, "b": 2}


def test_sketches_of_days_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 5).alias("day"), (F.col("id") % 7_000).alias("n"), F.when(F.col("id") % 3 > 0, "x").alias("s"), F.lit(None).cast("string").alias("none"))
    days = profile.distinct_sketches(df, ["n", "s", "none"], "day")
    found = {r["column"]: r["distinct"] for r in profile.merged_distinct(days).collect()}
    assert abs(found["n"] - 7_000) <= 7_000 * profile.SKETCH_ERROR and (found["s"], found["none"]) == (1, 0)
    # A day that comes later needs no other rows.
    more = profile.distinct_sketches(spark.range(7_000, 9_000).select(F.lit(9).cast("bigint").alias("day"), F.col("id").alias("n")), ["n"], "day")
    later = {r["column"]: r["distinct"] for r in profile.merged_distinct(days.unionByName(more)).collect()}
    assert abs(later["n"] - 9_000) <= 9_000 * profile.SKETCH_ERROR
    assert days.groupBy("day").count().count() == 5
