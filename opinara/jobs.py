"""Whole jobs, from stored reviews to models, predictions and reports."""

from __future__ import annotations

import argparse
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from opinara.functions.ratings import helpful_votes, helpfulness_ratio, parse_helpful, total_votes
from opinara.functions.text import review_length
from opinara.models import training
from opinara.models.evaluation import METRICS, confusion, metrics
from opinara.models.features import class_names, cut_terms, feature_model
from opinara.operators import panels, profile
from opinara.operators.filters import recent, with_text
from opinara.operators.projections import with_cleaned, with_sentiment
from opinara.operators.sampling import balanced_splits, repeat_rows
from opinara.session import build_session, stored, work_scope
from opinara.sources.messages import file_stream, send_to_files, send_to_topic, to_messages, topic_stream
from opinara.sources.tables import scan_parquet, scan_predictions, scan_reviews, sink_json, sink_parquet
from opinara.streaming.replay import PAUSE
from opinara.streaming.scoring import start_scoring

KEY = "review_no"
HASH = "review_hash"
TIE = "row_hash"


def profile_reviews(reviews: DataFrame) -> dict[str, DataFrame]:
    """Every table of the exploration report."""
    reviews = reviews.withColumn("helpful", parse_helpful(reviews))
    votes = reviews.withColumns({"helpful_votes": helpful_votes(F.col("helpful")), "total_votes": total_votes(F.col("helpful"))})
    votes = votes.withColumn("ratio", helpfulness_ratio(F.col("helpful_votes"), F.col("total_votes")))
    words = review_length(F.col("reviewText"))
    return {
        "shape": profile.shape(reviews),
        "column_types": profile.column_types(reviews),
        "null_counts": profile.null_counts(reviews),
        "describe": profile.describe_numeric(reviews, ["overall", "unixReviewTime"]),
        "distinct": profile.distinct_counts(reviews, ["reviewerID", "asin", "reviewerName", "summary"]),
        "ratings": profile.rating_counts(reviews),
        "average_rating": profile.avg_rating(reviews),
        "helpfulness_histogram": profile.histogram(votes, F.col("ratio"), 20),
        "helpfulness_density": profile.density(votes, F.col("ratio")),
        "helpfulness_by_rating": profile.binned_scatter(votes, F.col("ratio"), "overall", 20),
        "length_histogram": profile.histogram(reviews, words, 30),
        "length_density": profile.density(reviews, words),
        "length_by_rating": profile.binned_scatter(reviews, words, "overall", 30),
    }


def numbered(reviews: DataFrame) -> DataFrame:
    """Reviews with ``review_hash``, which copies share, and the unique ``review_no``, both from their fields alone.

    So the same reviews get the same split and folds however they are partitioned. Reviews have no key of their own:
    exact copies are counted, and numbered within their hash.
    """
    counted = reviews.groupBy(*reviews.columns).agg(F.count(F.lit(1)).alias("_n"))
    content = F.to_json(F.struct(*reviews.columns), {"ignoreNullFields": "false"})
    hashed = counted.withColumn(HASH, F.md5(content.cast("binary")))
    copies = repeat_rows(hashed, F.col("_n"), HASH).withColumn(KEY, F.concat_ws("#", HASH, "copy"))
    return stored(copies.drop("_n", "copy"), "numbered")


def train_models(
    reviews: DataFrame, folder: str, leaky: bool = False, tune: bool = False, quick: bool = False
) -> dict[str, Any]:
    """Clean, label, balance and split the reviews; train, compare and save the models.

    Writes the splits, the best model, its text stages, the test rows as JSON and the
    test metrics below ``folder``, and returns the paths and accuracies, and how
    many terms the fixed-width features had no room for (``cut_terms``).
    """
    ready = with_cleaned(with_text(with_sentiment(numbered(reviews))))
    splits = scan_parquet(
        ready.sparkSession, sink_parquet(balanced_splits(ready, KEY, leaky=leaky, split_key=HASH), f"{folder}/splits", ["split"])
    )
    train, validation, test = (splits.filter(F.col("split") == s) for s in ("train", "val", "test"))
    models = training.quick_classifiers() if quick else training.classifiers()
    trained = training.train_all(train, validation, HASH, models, tune)
    best = trained.models[trained.best]

    names = F.array(*[F.lit(n) for n in class_names(best)])
    predicted = best.transform(test).withColumn("predicted", F.get(names, F.col("prediction").cast("int")))
    measured = metrics(confusion(predicted, "label", "predicted")).select(F.lit(trained.best).alias("model"), *METRICS)
    return {
        "best": trained.best,
        "accuracy": trained.accuracy,
        "cut_terms": cut_terms(best, train),
        "splits": f"{folder}/splits",
        "model": training.save_model(best, folder, "sentiment"),
        "features": training.save_model(feature_model(best), folder, "tfidf"),
        "metrics": sink_parquet(measured, f"{folder}/metrics"),
        "test": sink_json(test.drop("words"), f"{folder}/test_json"),
    }


def send_reviews(reviews: DataFrame, servers: str | None, target: str, rows: int | None = None) -> None:
    """Reviews as messages: to a topic where ``servers`` are given, else to a folder, with at most ``rows`` in a file."""
    messages = to_messages(reviews)
    if servers:
        send_to_topic(messages, servers, target)
    else:
        send_to_files(messages, target, rows)


def score_stream(
    spark: SparkSession,
    source: str,
    model: PipelineModel,
    folder: str,
    servers: str | None = None,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Score messages from a topic or a folder into ``folder``."""
    messages = topic_stream(spark, servers, source) if servers else file_stream(spark, source)
    paths = (f"{folder}/predictions", f"{folder}/rejects", f"{folder}/checkpoint")
    return start_scoring(messages, model, *paths, trigger or {"processingTime": PAUSE})


def with_tie(predictions: DataFrame) -> DataFrame:
    """``TIE`` orders predictions of one moment: a hash of all their fields, equal for equal rows only."""
    return predictions.withColumn(TIE, F.md5(F.to_json(F.struct(*predictions.columns)).cast("binary")))


def realtime_report(predictions: DataFrame, tie: str, as_of: Column | None = None) -> dict[str, DataFrame]:
    """The last five minutes in totals and cards, and the last hour by minute."""
    now = F.current_timestamp() if as_of is None else as_of
    last = recent(predictions, now, "5 MINUTES")
    return {
        "totals": panels.headline(last, rating=False),
        "minutes": panels.by_minute(recent(predictions, now, "1 HOUR")),
        "recent_reviews": panels.recent_cards(last, tie),
    }


def offline_report(predictions: DataFrame, tie: str) -> dict[str, DataFrame]:
    """Totals, cards and all panels over every prediction. The panels share one scan and are written once made."""
    shown = stored(panels.all_panels(predictions), "panels")

    def panel(name: str) -> DataFrame:
        return shown.filter(F.col("panel") == name).drop("panel", "newest", "rank")

    return {
        "totals": panels.headline(predictions),
        "labels": panels.label_totals(predictions),
        "recent_reviews": panels.recent_cards(predictions, tie),
        "time": panel("day").orderBy("key"),
        "rating": panel("rating").orderBy(F.coalesce(F.col("key").try_cast("double"), F.lit(-1.0))),
        "product": shown.filter(F.col("panel") == "product").orderBy("rank").drop("panel", "newest", "rank"),
        "reviewer": shown.filter(F.col("panel") == "reviewer").orderBy("rank").drop("panel", "newest", "rank"),
        "length": panel("length").orderBy("key"),
    }


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="opinara", description="Review analytics on Spark")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, text in (("profile", "profile JSON reviews"), ("train", "train on JSON reviews")):
        job = jobs.add_parser(name, help=text)
        job.add_argument("reviews")
        job.add_argument("folder")
    jobs.choices["train"].add_argument("--tune", action="store_true")
    jobs.choices["train"].add_argument("--quick", action="store_true")
    jobs.choices["train"].add_argument("--leaky", action="store_true")
    job = jobs.add_parser("send", help="send Parquet reviews as messages")
    job.add_argument("reviews")
    job.add_argument("target")
    job.add_argument("--servers")
    job.add_argument("--rows", type=int, help="most messages in a file")
    job = jobs.add_parser("score", help="score messages as they arrive")
    job.add_argument("source")
    job.add_argument("model")
    job.add_argument("folder")
    job.add_argument("--servers")
    job.add_argument("--once", action="store_true", help="read what is there and stop")
    job = jobs.add_parser("report", help="show the reports over the predictions")
    job.add_argument("predictions")
    chosen = parser.parse_args(arguments)

    spark = build_session()
    with work_scope(spark):
        run(spark, chosen)


def run(spark: SparkSession, chosen: argparse.Namespace) -> None:
    """One job; its intermediate tables go when it has ended."""
    if chosen.job == "profile":
        for name, table in profile_reviews(scan_reviews(spark, chosen.reviews)).items():
            sink_parquet(table, f"{chosen.folder}/{name}")
    elif chosen.job == "train":
        reviews = scan_reviews(spark, chosen.reviews)
        print(train_models(reviews, chosen.folder, chosen.leaky, chosen.tune, chosen.quick))
    elif chosen.job == "send":
        send_reviews(scan_parquet(spark, chosen.reviews), chosen.servers, chosen.target, chosen.rows)
    elif chosen.job == "score":
        trigger = {"availableNow": True} if chosen.once else None
        model = training.load_model(chosen.model)
        score_stream(spark, chosen.source, model, chosen.folder, chosen.servers, trigger).awaitTermination()
    else:
        predictions = scan_predictions(spark, chosen.predictions)
        for report in (realtime_report, offline_report):
            for name, table in report(with_tie(predictions), TIE).items():
                print(name)
                table.show(20, truncate=60)


if __name__ == "__main__":
    main()
