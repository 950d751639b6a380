"""Scoring reviews as they arrive."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from opinara.models.scoring import score_reviews
from opinara.operators.filters import first_text
from opinara.operators.projections import prediction_documents
from opinara.sources.messages import decoded
from opinara.sources.sinks import query_id, write_batch
from opinara.streaming.store import start_store


def read_messages(messages: DataFrame) -> DataFrame:
    """Parsed messages with the raw value, the reason why one cannot be scored, if any, and its ``bad_fields``.

    Whatever has a text is scored: a field of a wrong type is null, and the message is noted.
    """
    parsed = decoded(messages).select("value", "data.*", "corrupt", "bad_fields")
    reason = F.when(
        first_text(parsed).isNull(),
        F.when(F.col("value").isNull(), "no value").when(F.col("corrupt"), "malformed").otherwise("no text"),
    )
    return parsed.withColumn("reason", reason).drop("corrupt")


def dead_letters(messages: DataFrame) -> DataFrame:
    """``value, reason, scored`` of the messages that cannot be scored, and of those that were scored without some fields."""
    read = read_messages(messages)
    noted = F.when(F.col("bad_fields") != "", F.concat(F.lit("bad fields: "), "bad_fields"))
    rows = read.select("value", F.coalesce("reason", noted).alias("reason"), F.col("reason").isNull().alias("scored"))
    return rows.filter(F.col("reason").isNotNull())


def scored_documents(messages: DataFrame, model: PipelineModel, processed_ts: Column | None = None) -> DataFrame:
    """Prediction documents of the messages that can be scored."""
    good = read_messages(messages).filter(F.col("reason").isNull()).drop("value", "reason", "bad_fields", "sentiment")
    return prediction_documents(score_reviews(good, model), processed_ts)


def scoring_sink(
    model: PipelineModel, predictions: str, rejects: str, checkpoint: str, processed_ts: Column | None = None
) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: score a batch of messages and write documents and rejects."""

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            query = query_id(batch.sparkSession, checkpoint)
            write_batch(scored_documents(held, model, processed_ts), predictions, batch_id, query, "processed_ts")
            write_batch(dead_letters(held), rejects, batch_id, query)
        finally:
            held.unpersist()

    return write


def start_scoring(
    messages: DataFrame,
    model: PipelineModel,
    predictions: str,
    rejects: str,
    checkpoint: str,
    trigger: dict[str, Any],
    processed_ts: Column | None = None,
) -> StreamingQuery:
    """Start the scoring query. ``trigger`` is ``{"availableNow": True}`` or ``{"processingTime": ...}``.

    A batch that is repeated after a failure replaces what its first attempt wrote.
    """
    writer = messages.select(F.col("value").cast("string").alias("value")).writeStream
    writer = writer.foreachBatch(scoring_sink(model, predictions, rejects, checkpoint, processed_ts))
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_scoring_store(
    messages: DataFrame,
    model: PipelineModel,
    predictions: str,
    rejects: str,
    checkpoint: str,
    trigger: dict[str, Any],
    processed_ts: Column | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Score into the prediction store, and set rejects aside in a table of the same kind.

    Two queries read the messages, each with its own checkpoint below ``checkpoint``, so either can be started anew
    without the other; both write each row once.
    """
    values = messages.select(F.col("value").cast("string").alias("value"))
    documents = scored_documents(values, model, processed_ts)
    return (
        start_store(documents, predictions, f"{checkpoint.rstrip('/')}/predictions", trigger),
        start_store(dead_letters(values), rejects, f"{checkpoint.rstrip('/')}/rejects", trigger, time=None),
    )
