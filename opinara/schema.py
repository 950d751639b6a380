"""Declared schemas and class names shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# Class names by code 0, 1, 2.
CLASSES = ("negative", "neutral", "positive")
CLASSES_FR = ("negatif", "neutre", "positif")
UNKNOWN = "unknown"

# The fields of a review message.
REVIEW = T.StructType(
    [
        T.StructField("asin", T.StringType()),
        T.StructField("helpful", T.ArrayType(T.IntegerType())),
        T.StructField("overall", T.FloatType()),
        T.StructField("reviewText", T.StringType()),
        T.StructField("reviewTime", T.StringType()),
        T.StructField("reviewerID", T.StringType()),
        T.StructField("reviewerName", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("unixReviewTime", T.LongType()),
        T.StructField("sentiment", T.IntegerType()),
        T.StructField("kafka_timestamp", T.StringType()),
    ]
)

# What a message carries when the review has no such field.
MESSAGE_DEFAULTS = {
    "asin": None,
    "helpful": [0, 0],
    "overall": 0.0,
    "reviewText": "",
    "reviewTime": "",
    "reviewerID": "",
    "reviewerName": "",
    "summary": "",
    "unixReviewTime": 0,
    "sentiment": 0,
}

# Review fields that a stored prediction keeps: all but the ground truth.
KEPT_FIELDS = [f.name for f in REVIEW.fields if f.name != "sentiment"]

PREDICTION = T.StructType(
    [f for f in REVIEW.fields if f.name != "sentiment"]
    + [
        # With a zone: only such times are compared within Parquet files, so that
        # a filter on recent rows skips the others.
        T.StructField("processed_ts", T.TimestampType()),
        T.StructField("label", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("is_realtime", T.BooleanType()),
    ]
)
