"""Report panels on awkward predictions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from opinara.operators import filters, panels, projections
from opinara.schema import PREDICTION

START = dt.datetime(2024, 1, 1, 23, 58)


def prediction(i, label="positive", seconds=0, **fields):
    row = {
        "asin": "A",
        "helpful": [0, 0],
        "overall": 4.0,
        "reviewText": "x" * 60,
        "reviewTime": "01 02, 2013",
        "reviewerID": f"R{i}",
        "reviewerName": "Ann",
        "summary": "s",
        "unixReviewTime": 0,
        "kafka_timestamp": None,
        "processed_ts": START + dt.timedelta(seconds=seconds),
        "label": label,
        "confidence": 0.5,
        "is_realtime": True,
    }
    row.update(fields)
    return tuple(row[f.name] for f in PREDICTION.fields)


def table(spark, rows):
    return spark.createDataFrame(rows, PREDICTION)


def test_empty_table(spark):
    df = table(spark, [])
    assert panels.headline(df).first().asDict() == {
        "total_reviews": 0,
        "positive": 0,
        "neutral": 0,
        "negative": 0,
        "avg_confidence": 0.0,
        "avg_rating": 0.0,
    }
    for panel in (panels.by_minute(df), panels.by_rating(df), panels.by_length(df), panels.top_by_key(df, "asin"), panels.all_panels(df)):
        assert panel.collect() == []


def test_headline_counts_missing_as_zero(spark):
    df = table(
        spark,
        [prediction(0, overall=None, confidence=None), prediction(1, "unknown", confidence=1.0), prediction(2, None, overall=2.0)],
    )
    row = panels.headline(df).first()
    assert (row.total_reviews, row.positive, row.neutral, row.negative) == (3, 1, 0, 0)
    assert row.avg_confidence == pytest.approx(0.5)
    assert row.avg_rating == pytest.approx(2.0)


def test_minutes_keep_their_order_over_midnight(spark):
    df = table(spark, [prediction(i, seconds=60 * i) for i in range(4)])
    assert [r.minute_label for r in panels.by_minute(df).collect()] == ["23:58", "23:59", "00:00", "00:01"]


def test_recent_rows(spark):
    df = table(spark, [prediction(0), prediction(1, seconds=100), prediction(2, seconds=400, is_realtime=False), prediction(3, seconds=400)])
    as_of = F.lit(START + dt.timedelta(seconds=400)).cast("timestamp")
    assert {r.reviewerID for r in filters.recent(df, as_of, "5 MINUTES").collect()} == {"R1", "R3"}


def test_missing_rating_comes_first(spark):
    df = table(spark, [prediction(0, overall=5.0), prediction(1, overall=None), prediction(2, overall=1.0), prediction(3, "unknown", overall=2.0)])
    assert [r.rating for r in panels.by_rating(df).collect()] == ["N/A", "1.0", "5.0"]


def test_top_keys_and_ties(spark):
    rows = [prediction(i, seconds=i, asin="A") for i in range(3)]
    rows += [prediction(i, seconds=i + 10, asin="B") for i in range(3)]
    rows += [prediction(i, seconds=i + 10, asin="C") for i in range(3)]
    rows += [prediction(9, seconds=99, asin=k) for k in (None, "")]
    rows += [prediction(9, "unknown", seconds=200, asin="A")]
    out = panels.top_by_key(table(spark, rows), "asin", 2).collect()
    assert [(r.asin, r.total) for r in out] == [("B", 3), ("C", 3)]


def test_length_classes_sort_as_text(spark):
    rows = [prediction(i, reviewText="x" * n) for i, n in enumerate((10, 60, 150, 300, 900))]
    rows += [prediction(7, reviewText=""), prediction(8, reviewText=None)]
    out = panels.by_length(table(spark, rows)).collect()
    assert [(r.length_bin, r.bin_no) for r in out] == [("100-199", 2), ("200-499", 3), ("50-99", 1), ("500+", 4), ("<50", 0)]


def test_one_scan_gives_the_same_panels(spark):
    rows = [
        prediction(
            i,
            ["positive", "neutral", "negative", "unknown"][i % 4],
            seconds=i * 7 % 50,
            asin=f"P{i % 13}" if i % 9 else None,
            reviewerName=f"N{i % 17}",
            overall=float(i % 5 + 1) if i % 11 else None,
            reviewText="x" * (i * 5),
            reviewTime=f"0{i % 3 + 1} 01, 2013",
        )
        for i in range(120)
    ]
    df = table(spark, rows)
    long = panels.all_panels(df).collect()

    def panel(name):
        return sorted((r.key, r.positive, r.neutral, r.negative) for r in long if r.panel == name)

    def single(out, key):
        return sorted((r[key], r.positive, r.neutral, r.negative) for r in out.collect())

    assert panel("day") == single(panels.by_key(df, "reviewTime"), "reviewTime")
    assert panel("rating") == single(panels.by_rating(df), "rating")
    assert panel("product") == single(panels.top_by_key(df, "asin"), "asin")
    assert panel("reviewer") == single(panels.top_by_key(df, "reviewerName"), "reviewerName")
    assert panel("length") == single(panels.by_length(df), "length_bin")


def test_cards_fill_what_is_missing(spark):
    df = table(spark, [prediction(0, None, reviewText=None, asin=None, reviewerName=None, summary=None, overall=None, confidence=None)])
    card = projections.review_cards(df).first()
    assert card.asDict() == {
        "review_text": "",
        "sentiment": "unknown",
        "confidence": 0.0,
        "timestamp": START,
        "product_id": "",
        "reviewer": "",
        "summary": "",
        "rating": 0.0,
    }


def test_text_falls_back_by_field(spark):
    df = spark.createDataFrame([("a", "b"), ("", "b"), (None, "b"), ("", ""), (None, None)], "reviewText string, text string")
    assert [r.reviewText for r in filters.coalesce_text(df).collect()] == ["a", "b", "b"]
    assert filters.coalesce_text(df.drop("reviewText", "text").withColumn("n", F.lit(1))).count() == 0
