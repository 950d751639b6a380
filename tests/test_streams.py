"""Messages, sinks and streaming jobs."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from opinara.models import features, training
from opinara.models.scoring import score_reviews
from opinara.operators.panels import by_minute
from opinara.operators.projections import prediction_documents, with_cleaned
from opinara.schema import KEPT_FIELDS, MESSAGE_DEFAULTS, PREDICTION, REVIEW
from opinara.session import shared_folder, stored, work_folder, work_scope
from opinara.sources.messages import file_stream, normalised, parse_messages, send_to_files, to_messages
from opinara.sources.sinks import batch_sink, compact, document_store_sink, write_batch
from opinara.sources.tables import scan_predictions
from opinara.streaming import windows
from opinara.streaming.replay import replay
from opinara.streaming.scoring import dead_letters, read_messages, start_scoring

def clock():
    return F.lit("2024-05-01 10:00:00").cast("timestamp")


TEXTS = [("great love works", 2), ("bad broken awful", 0), ("okay fine plain", 1)] * 8


@pytest.fixture(scope="module")
def reviews(spark):
    rows = [(f"A{i}", [1, 2], float(s * 2 + 1), t, "01 01, 2013", f"R{i}", "N", "s", 1, s) for i, (t, s) in enumerate(TEXTS)]
    schema = "asin string, helpful array<int>, overall float, reviewText string, reviewTime string, reviewerID string, reviewerName string, summary string, unixReviewTime long, sentiment int"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def model(reviews):
    ready = with_cleaned(reviews).withColumn("label", F.element_at(F.array(*[F.lit(c) for c in ("negative", "neutral", "positive")]), F.col("sentiment") + 1))
    fitted = features.fit_features(ready)
    return features.with_classifier(fitted, training.classifiers()["Naive Bayes"].fit(fitted.transform(ready)))


def test_message_fields_and_defaults(spark):
    df = spark.createDataFrame([("A", None, "bad number")], "asin string, reviewText string, unixReviewTime string")
    record = json.loads(to_messages(df, F.lit("2024-01-01T00:00:00")).first().value)
    assert list(record) == [f.name for f in REVIEW.fields]
    assert record == {**MESSAGE_DEFAULTS, "asin": "A", "kafka_timestamp": "2024-01-01T00:00:00"}


def test_messages_survive_the_round_trip(spark, reviews):
    back = parse_messages(to_messages(reviews, F.lit("t")))
    assert sorted(back.drop("kafka_timestamp").collect()) == sorted(reviews.collect())


def test_times_become_text(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5), 1)], "t timestamp_ntz, n int")
    assert normalised(df).first().asDict() == {"t": "2024-01-01T05:00:00", "n": 1}


def test_bad_messages_give_null_rows_and_dead_letters(spark):
    good = json.dumps({"asin": "A", "reviewText": "fine", "overall": 3.0})
    values = [good, '{"asin": "B", "reviewText', "not json", None, json.dumps({"asin": "C", "reviewText": ""}), json.dumps({"asin": "D"})]
    messages = spark.createDataFrame([(v,) for v in values], "value string")
    assert parse_messages(messages).filter(F.col("asin").isNull() | F.col("asin").isin("A", "B", "C", "D")).count() == 6
    rejects = {(r.value, r.reason, r.scored) for r in dead_letters(messages).collect()}
    assert rejects == {
        (values[1], "malformed", False),
        (values[2], "malformed", False),
        (None, "no value", False),
        (values[4], "no text", False),
        (values[5], "no text", False),
    }


def test_fields_of_a_wrong_type_do_not_lose_a_message(spark):
    cases = [
        ({"overall": "5.0"}, "overall", 5.0, ""),
        ({"unixReviewTime": "abc"}, "unixReviewTime", None, "unixReviewTime"),
        ({"helpful": "[1, 2]"}, "helpful", [1, 2], ""),
        ({"helpful": [3, 4]}, "helpful", [3, 4], ""),
        ({"sentiment": 2.0}, "sentiment", 2, ""),
        ({"overall": [1], "helpful": 7}, "overall", None, "helpful, overall"),
    ]
    for fields, name, value, bad in cases:
        row = read_messages(spark.createDataFrame([(json.dumps({"reviewText": "fine", **fields}),)], "value string")).first()
        assert (row.reviewText, row.reason, row[name], row.bad_fields) == ("fine", None, value, bad)


def test_votes_as_text_become_messages(spark):
    df = spark.createDataFrame([("[1, 2]",), (None,), ("x",)], "helpful string")
    assert [json.loads(r.value)["helpful"] for r in to_messages(df, F.lit("t")).collect()] == [[1, 2], [0, 0], [0, 0]]


def test_documents(spark):
    df = spark.createDataFrame([("A", None, None)], "asin string, label string, confidence double")
    out = prediction_documents(df, clock())
    assert out.schema == PREDICTION or [f.name for f in out.schema] == [f.name for f in PREDICTION]
    row = out.first()
    assert (row.asin, row.label, row.confidence, row.is_realtime) == ("A", "unknown", 0.0, True)
    assert row.processed_ts == dt.datetime(2024, 5, 1, 10)
    assert [f.name for f in out.schema][: len(KEPT_FIELDS)] == KEPT_FIELDS


def test_repeated_batches_do_not_duplicate(spark):
    path = work_folder(spark, "test-sink")
    write_batch(spark.range(5), path, 3)
    write_batch(spark.range(7), path, 4)
    write_batch(spark.range(5), path, 3)
    write_batch(spark.range(0), path, 5)
    assert scan_predictions(spark, path).count() == 12
    write_batch(spark.range(2), path, 3, "other")
    assert scan_predictions(spark, path).count() == 14
    write_batch(spark.range(0), path, 4)
    assert scan_predictions(spark, path).count() == 7
    copy = compact(spark, path, work_folder(spark, "compacted"))
    assert sorted(r.id for r in scan_predictions(spark, copy).collect()) == [0, 0, 1, 1, 2, 3, 4]


def test_the_document_store_needs_an_id(spark):
    with pytest.raises(ValueError, match="idFieldList"):
        document_store_sink({"database": "d"})


def test_stream_equals_batch_and_restart_adds_nothing(spark, reviews, model):
    paths = [work_folder(spark, n) for n in ("m", "p", "r", "c")]

    def run():
        start_scoring(file_stream(spark, paths[0]), model, *paths[1:], {"availableNow": True}, clock()).awaitTermination()

    def stored():
        return sorted((r.asin, r.label, round(r.confidence, 9)) for r in scan_predictions(spark, paths[1]).collect())

    messages = to_messages(reviews, F.lit("t"))
    send_to_files(messages.limit(10), paths[0])
    run()
    assert len(stored()) == 10
    send_to_files(messages.subtract(messages.limit(10)), paths[0])
    run()
    run()
    assert len(stored()) == len(TEXTS)
    batch = score_reviews(reviews.drop("sentiment"), model)
    assert stored() == sorted((r.asin, r.label, round(r.confidence, 9)) for r in batch.collect())
    one = scan_predictions(spark, paths[1]).first()
    assert one.processed_ts == dt.datetime(2024, 5, 1, 10)


def test_replay_takes_one_file_per_batch(spark, reviews):
    out = work_folder(spark, "replayed")
    paced = replay(reviews.coalesce(1), work_folder(spark, "paced"), rows=10, sent_at=F.lit("t"))
    query = paced.writeStream.foreachBatch(batch_sink(out)).option("checkpointLocation", work_folder(spark, "c"))
    query.trigger(availableNow=True).start().awaitTermination()
    sizes = [r["count"] for r in spark.read.parquet(out).groupBy("batch_id").count().collect()]
    assert sorted(sizes) == [4, 10, 10]


SCHEMA = "processed_ts timestamp_ntz, label string, confidence double"


def test_live_minutes_equal_the_batch_over_several_files(spark):
    folder, out, late, checkpoint = (work_folder(spark, n) for n in ("in", "out", "late", "c"))
    start = dt.datetime(2024, 1, 1, 23, 50)
    rows = [(start + dt.timedelta(seconds=37 * i), ("positive", "neutral", "negative", "unknown")[i % 4], 0.5) for i in range(90)]
    for part in (rows[::3], rows[1::3], rows[2::3]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    windows.start_minutes(stream, out, late, checkpoint, availableNow=True).awaitTermination()
    assert spark.read.parquet(out).select("batch_id").distinct().count() > 1
    live = windows.by_minute(windows.current(spark, out)).select("minute", "positive", "neutral", "negative")
    batch = by_minute(spark.createDataFrame(rows, SCHEMA)).drop("minute_label")
    assert sorted(live.collect()) == sorted(batch.select(live.columns).collect())
    headline = windows.sliding_headline(windows.current(spark, out)).agg(F.sum("total_reviews"), F.max("avg_confidence")).first()
    assert tuple(headline) == (5 * 90, 0.5)


def test_late_rows_count_and_are_noted(spark):
    folder, out, late, checkpoint = (work_folder(spark, n) for n in ("in", "out", "late", "c"))
    base = dt.datetime(2024, 1, 10)

    def send(*days):
        rows = [(base + dt.timedelta(days=d), "positive", 0.5) for d in days]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(SCHEMA).parquet(folder)
        windows.start_minutes(stream, out, late, checkpoint, availableNow=True).awaitTermination()

    send(0, -3)
    send(-8, -0.5)
    send(1, -9, -10)
    counted = {r.minute: r.positive for r in windows.by_minute(windows.current(spark, out)).collect()}
    assert counted == {base + dt.timedelta(days=d): 1 for d in (0, -3, -8, -0.5, 1, -9, -10)}
    assert {r.batch_id: r.late_rows for r in spark.read.parquet(late).collect()} == {0: 0, 1: 1, 2: 2}


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark, "x") != work_folder(spark, "x")


def test_no_machine_local_folder_on_a_cluster(monkeypatch):
    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        shared_folder(Session())


def test_a_scope_deletes_its_tables(spark):
    with work_scope(spark):
        kept = stored(spark.range(3), "scoped")
        path = kept.inputFiles()[0]
        assert kept.count() == 3
    assert not os.path.exists(path.removeprefix("file://"))
