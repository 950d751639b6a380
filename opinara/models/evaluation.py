"""Metrics from a confusion table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ("accuracy", "f1", "weightedPrecision", "weightedRecall")


def confusion(df: DataFrame, truth: str, predicted: str, *keys: str) -> DataFrame:
    """Rows per true and predicted class."""
    cells = df.groupBy(*keys, F.col(truth).alias("truth"), F.col(predicted).alias("predicted"))
    return cells.agg(F.count(F.lit(1)).alias("n"))


def metrics(cells: DataFrame, *keys: str) -> DataFrame:
    """Accuracy and class-weighted F1, precision and recall, one row per key.

    The table has one row per pair of classes, so all steps after ``confusion``
    are small whatever the number of predictions.
    """
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)
    true_side = cells.groupBy(*keys, F.col("truth").alias("class")).agg(F.sum("n").alias("actual"), F.sum(hit).alias("hits"))
    predicted_side = cells.groupBy(*keys, F.col("predicted").alias("class")).agg(F.sum("n").alias("guessed"))
    per_class = true_side.join(predicted_side, [*keys, "class"], "left")
    precision = F.coalesce(F.try_divide("hits", "guessed"), F.lit(0.0))
    recall = F.col("hits") / F.col("actual")
    per_class = per_class.withColumns({"precision": precision, "recall": recall})
    f1 = F.coalesce(
        F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)
    )
    total = F.sum("actual")
    return per_class.withColumn("f1", f1).groupBy(*keys).agg(
        (F.sum("hits") / total).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("actual")) / total).alias("f1"),
        (F.sum(F.col("precision") * F.col("actual")) / total).alias("weightedPrecision"),
        (F.sum(F.col("recall") * F.col("actual")) / total).alias("weightedRecall"),
    )


def select_best(results: DataFrame, order: str = "model_order") -> DataFrame:
    """The model with the highest accuracy; the first wins among equals."""
    return results.orderBy(F.desc("accuracy"), order).limit(1)
