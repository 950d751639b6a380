"""Files in, files out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from opinara.functions.ratings import parse_helpful
from opinara.schema import REVIEW


def scan_json(spark: SparkSession, path: str, schema: T.StructType | None = REVIEW) -> DataFrame:
    """JSON lines. A declared schema saves the pass that inference would take;
    pass ``None`` to infer."""
    reader = spark.read
    return (reader.schema(schema) if schema else reader).json(path)


def scan_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Reviews as JSON lines; votes may be an array or an array written as text."""
    as_text = [T.StructField(f.name, T.StringType()) if f.name == "helpful" else f for f in REVIEW.fields]
    reviews = spark.read.schema(T.StructType(as_text)).json(path)
    return reviews.withColumn("helpful", parse_helpful(reviews))


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    return (reader.schema(schema) if schema else reader).parquet(path)


def sink_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Replace the table at ``path``."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def sink_json(df: DataFrame, path: str, drop: Sequence[str] = (), keep_nulls: bool = True) -> str:
    """Replace the JSON-lines folder at ``path``, without the dropped columns."""
    df.drop(*drop).write.mode("overwrite").option("ignoreNullFields", not keep_nulls).json(path)
    return path


def scan_predictions(spark: SparkSession, path: str) -> DataFrame:
    """The prediction table as written by the streaming sink.

    Of the folders' columns ``date`` stays, so that ``recent`` reads the folders of its days only.
    """
    return spark.read.option("basePath", path).parquet(path).drop("query", "batch_id")
