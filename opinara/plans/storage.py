"""Sources, sinks and message forms."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.operators.projections import prediction_documents, with_cleaned
from opinara.operators.sampling import split_hash
from opinara.plans.fixtures import predictions, reviews, sql
from opinara.plans.registry import Registry
from opinara.schema import REVIEW
from opinara.session import work_folder
from opinara.sources.messages import (
    file_stream,
    normalised,
    parse_messages,
    send_to_files,
    to_json_value,
    to_messages,
)
from opinara.sources.sinks import batch_sink, write_batch
from opinara.sources.tables import scan_json, scan_parquet, scan_predictions, sink_json, sink_parquet

QUERIES = Registry()

SENT_AT = "2024-02-01T00:00:00"
JSON_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), *REVIEW.fields])
REVIEW_FIELDS = [
    "asin",
    "overall",
    "reviewText",
    "reviewTime",
    "reviewerID",
    "reviewerName",
    "summary",
    "unixReviewTime",
]
REVIEW_ROWS_SQL = """
select doc_id, asin, helpful_votes, total_votes, overall, "reviewText", "reviewTime", "reviewerID", "reviewerName",
  summary, "unixReviewTime" from reviews
"""
CLEAN_SQL = r"""trim(lower(regexp_replace("reviewText", '[^a-zA-Z\s\x0B]', ' ', 'g')))"""
SPLIT_SQL = """
case when ('0x' || substr(md5(cast(doc_id as varchar)), 1, 8))::bigint % 100 < 80 then 'train'
     when ('0x' || substr(md5(cast(doc_id as varchar)), 1, 8))::bigint % 100 < 90 then 'val' else 'test' end
"""


def _votes_flat(df):
    votes = [F.get("helpful", F.lit(i)).alias(n) for i, n in enumerate(("helpful_votes", "total_votes"))]
    return df.select("doc_id", *REVIEW_FIELDS, *votes)


def _json_reviews(spark, sf_dir, name):
    df = reviews(spark, sf_dir, "doc_id", "helpful", *REVIEW_FIELDS, "sentiment")
    return sink_json(df, work_folder(spark, name), drop=["sentiment"])


@QUERIES.add("scan_json", sql(REVIEW_ROWS_SQL))
def scan_json_query(spark, sf_dir):
    return _votes_flat(scan_json(spark, _json_reviews(spark, sf_dir, "reviews-json"), JSON_SCHEMA))


@QUERIES.add("sink_json", sql(REVIEW_ROWS_SQL))
def sink_json_query(spark, sf_dir):
    written = scan_json(spark, _json_reviews(spark, sf_dir, "cleaned-json"), None)
    assert "sentiment" not in written.columns
    votes = {c: F.col(c).cast("int") for c in ("helpful_votes", "total_votes")}
    return _votes_flat(written).withColumns({"overall": F.col("overall").cast("float"), **votes})


@QUERIES.add("scan_parquet", sql(REVIEW_ROWS_SQL))
def scan_parquet_query(spark, sf_dir):
    df = reviews(spark, sf_dir, "doc_id", "helpful_votes", "total_votes", *REVIEW_FIELDS)
    return scan_parquet(spark, sink_parquet(df, work_folder(spark, "reviews")))


@QUERIES.add(
    "sink_parquet",
    sql(f'select doc_id, {CLEAN_SQL} as cleaned_reviews, label, {SPLIT_SQL} as split from reviews where "reviewText" is not null'),
)
def sink_parquet_query(spark, sf_dir):
    df = with_cleaned(reviews(spark, sf_dir, "doc_id", "reviewText", "label").filter(F.col("reviewText").isNotNull()))
    parts = split_hash(df, "doc_id").select("doc_id", "cleaned_reviews", "label", "split")
    return scan_parquet(spark, sink_parquet(parts, work_folder(spark, "splits"), ["split"]))


@QUERIES.add(
    "export_json",
    sql(
        f"select doc_id, {CLEAN_SQL} as cleaned_reviews, label from reviews "
        f"where \"reviewText\" is not null and {SPLIT_SQL} = 'test'"
    ),
)
def export_json_query(spark, sf_dir):
    df = with_cleaned(reviews(spark, sf_dir, "doc_id", "reviewText", "label").filter(F.col("reviewText").isNotNull()))
    test = split_hash(df, "doc_id").filter(F.col("split") == "test").select("doc_id", "cleaned_reviews", "label")
    path = sink_json(test, work_folder(spark, "test-json"))
    return scan_json(spark, path, test.schema)


@QUERIES.add(
    "stream_source",
    sql("""
select asin, count(*) as n, sum(coalesce(length("reviewText"), 0)) as characters, sum(helpful_votes) as votes,
  sum(overall::double) as stars, count(distinct "reviewerID") as reviewers, min("reviewTime") as first_time
from reviews group by asin
"""),
)
def stream_source_query(spark, sf_dir):
    path = work_folder(spark, "messages")
    send_to_files(to_messages(reviews(spark, sf_dir, "helpful", *REVIEW_FIELDS, "sentiment"), F.lit(SENT_AT)), path)
    out = work_folder(spark, "parsed")
    query = (
        parse_messages(file_stream(spark, path))
        .writeStream.foreachBatch(batch_sink(out))
        .option("checkpointLocation", work_folder(spark, "source-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return scan_parquet(spark, out).groupBy("asin").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("reviewText")).alias("characters"),
        F.sum(F.get("helpful", F.lit(0))).alias("votes"),
        F.sum(F.col("overall").cast("double")).alias("stars"),
        F.count_distinct("reviewerID").alias("reviewers"),
        F.min("reviewTime").alias("first_time"),
    )


@QUERIES.add(
    "to_messages",
    sql(f"""
select to_json({{'asin': asin, 'helpful': [helpful_votes, total_votes], 'overall': overall,
  'reviewText': coalesce("reviewText", ''), 'reviewTime': "reviewTime", 'reviewerID': "reviewerID",
  'reviewerName': coalesce("reviewerName", ''), 'summary': summary, 'unixReviewTime': "unixReviewTime",
  'sentiment': sentiment, 'kafka_timestamp': '{SENT_AT}'}})::varchar as value from reviews
"""),
)
def to_messages_query(spark, sf_dir):
    return to_messages(reviews(spark, sf_dir, "helpful", *REVIEW_FIELDS, "sentiment"), F.lit(SENT_AT))


@QUERIES.add(
    "normalise_record",
    sql("""
select doc_id, to_json({'helpful': [helpful_votes, total_votes], 'overall': overall, 'confidence': confidence,
  'unixReviewTime': "unixReviewTime", 'reviewerName': "reviewerName", 'is_realtime': is_realtime,
  'processed_ts': strftime(processed_ts, '%Y-%m-%dT%H:%M:%S')})::varchar as value from predictions
"""),
)
def normalise_record_query(spark, sf_dir):
    fields = ["helpful", "overall", "confidence", "unixReviewTime", "reviewerName", "is_realtime", "processed_ts"]
    df = normalised(predictions(spark, sf_dir, "doc_id", *fields))
    return df.select("doc_id", to_json_value(df.select(*fields)))


@QUERIES.add("parse_messages", sql("""
select asin, helpful_votes, total_votes, overall, coalesce("reviewText", '') as "reviewText", "reviewTime", "reviewerID",
  coalesce("reviewerName", '') as "reviewerName", summary, "unixReviewTime", sentiment from reviews
"""))
def parse_messages_query(spark, sf_dir):
    messages = to_messages(reviews(spark, sf_dir, "helpful", *REVIEW_FIELDS, "sentiment"), F.lit(SENT_AT))
    votes = [F.get("helpful", F.lit(i)).alias(n) for i, n in enumerate(("helpful_votes", "total_votes"))]
    return parse_messages(messages).select(*REVIEW_FIELDS, "sentiment", *votes)


@QUERIES.add(
    "sink_batch",
    sql("""
select doc_id % 2 as writer, doc_id % 3 as batch_id, count(*) as n from predictions
where not (doc_id % 2 = 1 and doc_id % 3 = 2) group by 1, 2
"""),
)
def sink_batch_query(spark, sf_dir):
    """Two queries write to one table, both from batch 0 on; batches are repeated, and one is empty the second time."""
    path = work_folder(spark, "batches")
    df = predictions(spark, sf_dir, "doc_id", "asin", "label", "confidence", "processed_ts")
    for writer in (0, 1):
        rows = df.filter(F.col("doc_id") % 2 == writer)
        for batch_id in (0, 1, 1, 2, 0, 2):
            write_batch(rows.filter(F.col("doc_id") % 3 == batch_id), path, batch_id, f"w{writer}", "processed_ts")
    write_batch(df.limit(0), path, 2, "w1", "processed_ts")
    out = scan_parquet(spark, path).groupBy(F.substring("query", 2, 1).cast("bigint").alias("writer"), "batch_id")
    return out.agg(F.count(F.lit(1)).alias("n")).withColumn("batch_id", F.col("batch_id").cast("bigint"))


DOCUMENTS_SQL = """
select asin, helpful_votes, total_votes, overall, "reviewText", "reviewTime", "reviewerID", "reviewerName",
  summary, "unixReviewTime", processed_ts, label, confidence, true as is_realtime from predictions
"""


def _flat_documents(df):
    votes = [F.get("helpful", F.lit(i)).alias(n) for i, n in enumerate(("helpful_votes", "total_votes"))]
    flat = df.select(*[c for c in df.columns if c not in ("helpful", "kafka_timestamp")], *votes)
    return flat.withColumn("processed_ts", F.col("processed_ts").cast("timestamp_ntz"))


@QUERIES.add("enrich_predictions", sql(DOCUMENTS_SQL))
def enrich_predictions_query(spark, sf_dir):
    df = predictions(spark, sf_dir, "helpful", *REVIEW_FIELDS, "processed_ts", "label", "confidence")
    return _flat_documents(prediction_documents(df, F.col("processed_ts")))


@QUERIES.add("sink_predictions", sql(DOCUMENTS_SQL))
def sink_predictions_query(spark, sf_dir):
    df = predictions(spark, sf_dir, "helpful", *REVIEW_FIELDS, "processed_ts", "label", "confidence")
    path = work_folder(spark, "predictions")
    for _ in range(2):
        write_batch(prediction_documents(df, F.col("processed_ts")), path, 0, time="processed_ts")
    return _flat_documents(scan_predictions(spark, path).drop("date"))


@QUERIES.add(
    "scan_predictions",
    sql("select doc_id, asin, overall, processed_ts, label, confidence, is_realtime from predictions"),
)
def scan_predictions_query(spark, sf_dir):
    path = work_folder(spark, "stored-predictions")
    columns = ["doc_id", "asin", "overall", "processed_ts", "label", "confidence", "is_realtime"]
    write_batch(predictions(spark, sf_dir, *columns), path, 0, time="processed_ts")
    return scan_predictions(spark, path).drop("date")
