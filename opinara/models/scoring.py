"""Labels and confidence from a fitted model, for batches and streams alike."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.text import clean_train
from opinara.models.features import COUNTS, class_names
from opinara.operators.bayes import TermModel
from opinara.operators.filters import coalesce_text
from opinara.operators.projections import without_model_columns
from opinara.operators.words import vectors
from opinara.schema import UNKNOWN


def score_reviews(
    df: DataFrame, model: PipelineModel, clean: Callable[[Column], Column] = clean_train
) -> DataFrame:
    """Add ``label`` and ``confidence`` to every row that has text.

    One ``transform`` serves all rows. The label is looked up among the names the
    model was trained with, so it never depends on the order of class sizes. The
    text is cleaned as for training; ``clean`` may name another cleaner.
    """
    ready = coalesce_text(df).withColumn("cleaned_reviews", clean(F.col("reviewText"))).drop("label")
    return _named(model.transform(ready), model).drop("cleaned_reviews", "indexedLabel")


def score_counted(df: DataFrame, model: PipelineModel | TermModel, *keys: str) -> DataFrame:
    """The keys, ``label`` and ``confidence`` of every row that has text, equal to those of ``score_reviews``.

    For batches: words are cleaned, cut and counted in Arrow batches, and only the model's stages after its counts are run.
    Of a naive Bayes model in tables no term is on the driver.
    """
    if isinstance(model, TermModel):
        return model.score(coalesce_text(df), *keys)
    at = next(i for i, stage in enumerate(model.stages) if isinstance(stage, CountVectorizerModel))
    counts = vectors(coalesce_text(df), *keys, column="reviewText", vocabulary=model.stages[at].vocabulary, name=COUNTS)
    return _named(PipelineModel(stages=model.stages[at + 1 :]).transform(counts), model).select(*keys, "label", "confidence")


def _named(scored: DataFrame, model: PipelineModel) -> DataFrame:
    """With the label's name and the confidence in place of the model's columns."""
    names = F.array(*[F.lit(n) for n in class_names(model)])
    label = F.coalesce(F.get(names, F.col("prediction").cast("int")), F.lit(UNKNOWN))
    confidence = F.coalesce(F.array_max(vector_to_array("probability")), F.lit(0.0))
    out = scored.withColumns({"label": label, "confidence": confidence})
    return without_model_columns(out)
