"""The jobs one after the other: profile, train, send, score, report."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from opinara import jobs
from opinara.models import training
from opinara.operators.sampling import balanced_splits
from opinara.sources.tables import scan_json, scan_parquet, scan_predictions, scan_reviews

WORDS = {5.0: "great love perfect", 3.0: "okay fine average", 1.0: "broken bad awful"}


@pytest.fixture(scope="module")
def reviews(spark, tmp_path_factory):
    rng = random.Random(1)
    path = tmp_path_factory.mktemp("in") / "reviews.json"
    with path.open("w") as out:
        for i in range(300):
            stars = rng.choice([5.0, 5.0, 5.0, 3.0, 1.0])
            row = {
                "asin": f"B{i % 12}",
                "helpful": [i % 3, i % 3 + i % 2],
                "overall": stars,
                "reviewText": None if i % 60 == 59 else " ".join(rng.choices(WORDS[stars].split(), k=6)) + " cable",
                "reviewTime": f"0{i % 9 + 1} 0{i % 9 + 1}, 2013",
                "reviewerID": f"R{i}",
                "reviewerName": f"N{i % 20}",
                "summary": "s",
                "unixReviewTime": 1370000000 + i,
            }
            # Every fourth review is there twice.
            for _ in range(1 + (i % 4 == 0)):
                out.write(json.dumps(row) + "\n")
    return scan_json(spark, str(path))


@pytest.fixture(scope="module")
def trained(spark, reviews, tmp_path_factory):
    return jobs.train_models(reviews, str(tmp_path_factory.mktemp("models")), quick=True)


def test_profile(reviews):
    report = jobs.profile_reviews(reviews)
    assert report["shape"].first()[:] == (375, 11)
    assert all(table.count() > 0 for table in report.values())
    assert report["helpfulness_histogram"].agg(F.sum("n")).first()[0] == 375


def test_training_keeps_every_review(spark, reviews, trained):
    splits = scan_parquet(spark, trained["splits"])
    with_text = reviews.filter(F.col("reviewText").isNotNull()).count()
    assert splits.select(jobs.KEY).distinct().count() == with_text
    train = {r.label: r["count"] for r in splits.filter("split = 'train'").groupBy("label").count().collect()}
    assert len(set(train.values())) == 1 and len(train) == 3
    assert trained["accuracy"][trained["best"]] == max(trained["accuracy"].values()) > 0.9
    measured = scan_parquet(spark, trained["metrics"]).first()
    assert measured.model == trained["best"] and measured.accuracy > 0.9
    assert spark.read.json(trained["test"]).count() == splits.filter("split = 'test'").count()


def test_send_score_and_report(spark, reviews, trained, tmp_path):
    jobs.send_reviews(reviews, None, str(tmp_path / "messages"), rows=100)
    model = training.load_model(trained["model"])
    jobs.score_stream(spark, str(tmp_path / "messages"), model, str(tmp_path), trigger={"availableNow": True}).awaitTermination()
    predictions = scan_predictions(spark, str(tmp_path / "predictions"))
    rejected = scan_parquet(spark, str(tmp_path / "rejects")).filter("not scored").count()
    assert predictions.count() + rejected == 375
    assert rejected == reviews.filter(F.col("reviewText").isNull()).count()

    last = predictions.agg(F.max("processed_ts")).scalar()
    realtime = {n: t.collect() for n, t in jobs.realtime_report(jobs.with_tie(predictions), jobs.TIE, last).items()}
    assert realtime["totals"][0].total_reviews == predictions.count()
    assert len(realtime["recent_reviews"]) == 10
    offline = {n: t.collect() for n, t in jobs.offline_report(jobs.with_tie(predictions), jobs.TIE).items()}
    assert offline["totals"][0].total_reviews == predictions.count()
    assert len(offline["product"]) == len(offline["reviewer"]) == 10
    assert [r.key for r in offline["rating"]] == ["1.0", "3.0", "5.0"]
    assert [r.total for r in offline["product"]] == sorted((r.total for r in offline["product"]), reverse=True)
    assert sum(r.total for r in offline["length"]) == predictions.count()


def test_split_depends_on_the_reviews_alone(reviews):
    def homes(partitions):
        ready = jobs.numbered(reviews.repartition(partitions)).withColumn("label", F.col("overall").cast("string"))
        rows = balanced_splits(ready, jobs.KEY, split_key=jobs.HASH).collect()
        return sorted((r[jobs.KEY], r.split, r.copy) for r in rows), rows

    first, rows = homes(2)
    assert first == homes(5)[0]
    split_of = {}
    for r in rows:
        split_of.setdefault(r[jobs.HASH], set()).add(r.split)
    assert all(len(s) == 1 for s in split_of.values())
    assert len({r[jobs.KEY] for r in rows}) == 375


def test_votes_as_text_are_read(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text('{"helpful": "[1, 2]", "overall": 5.0}\n{"helpful": [3, 4], "overall": 5.0}\n{"overall": 5.0}\n')
    assert [r.helpful for r in scan_reviews(spark, str(path)).collect()] == [[1, 2], [3, 4], None]


def test_training_tells_how_many_terms_were_cut(trained):
    assert trained["cut_terms"] == 0
