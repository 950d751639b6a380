"""Column projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.records import field_or
from opinara.functions.ratings import sentiment_code, sentiment_text
from opinara.functions.text import clean_train, snippet
from opinara.schema import KEPT_FIELDS, REVIEW, UNKNOWN

# Columns that the feature and model stages add; fixed values: the names stored tables may carry.
MODEL_COLUMNS = [
    "words",
    "filtered_words",
    "raw_features",
    "text_tokens",
    "kept_tokens",
    "token_counts",
    "rawFeatures",
    "features",
    "rawPrediction",
    "probability",
    "prediction",
]

# Card field, source column, value where that is missing.
CARD_FIELDS = [
    ("review_text", "reviewText", ""),
    ("sentiment", "label", UNKNOWN),
    ("confidence", "confidence", 0.0),
    ("timestamp", "processed_ts", None),
    ("product_id", "asin", ""),
    ("reviewer", "reviewerName", ""),
    ("summary", "summary", ""),
    ("rating", "overall", 0.0),
]


def with_cleaned(df: DataFrame, column: str = "reviewText") -> DataFrame:
    """Add ``cleaned_reviews``; the review columns stay."""
    return df.withColumn("cleaned_reviews", clean_train(F.col(column)))


def with_sentiment(df: DataFrame, null_rating: str = "positive") -> DataFrame:
    """Add ``sentiment`` and ``label`` from the rating.

    A missing rating counts as positive, or its row goes with ``null_rating="drop"``.
    """
    if null_rating not in ("positive", "drop"):
        raise ValueError("null_rating is positive or drop")
    rated = df.filter(F.col("overall").isNotNull()) if null_rating == "drop" else df
    coded = rated.withColumn("sentiment", sentiment_code(F.col("overall")))
    return coded.withColumn("label", sentiment_text(F.col("sentiment")))


def training_columns(df: DataFrame) -> DataFrame:
    return df.select("cleaned_reviews", "label")


def without_model_columns(df: DataFrame) -> DataFrame:
    return df.drop(*MODEL_COLUMNS)


def prediction_documents(df: DataFrame, processed_ts: Column | None = None, is_realtime: bool = True) -> DataFrame:
    """The stored form of scored reviews. ``processed_ts`` stands in for the clock."""
    clock = F.current_timestamp() if processed_ts is None else processed_ts
    kept = [field_or(df, name, None).cast(REVIEW[name].dataType).alias(name) for name in KEPT_FIELDS]
    return df.select(
        *kept,
        clock.cast("timestamp").alias("processed_ts"),
        F.coalesce("label", F.lit(UNKNOWN)).alias("label"),
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
        F.lit(is_realtime).alias("is_realtime"),
    )


def review_cards(df: DataFrame) -> DataFrame:
    """The eight fields shown for one review."""
    return df.select(*[field_or(df, source, default).alias(name) for name, source, default in CARD_FIELDS])


def preview(df: DataFrame, order: str, rows: int = 5) -> DataFrame:
    """The first rows by a unique column."""
    return df.orderBy(order).limit(rows)


def snippets(df: DataFrame) -> DataFrame:
    return df.select(snippet(F.col("reviewText")).alias("snippet"), "label", "confidence", "processed_ts")
