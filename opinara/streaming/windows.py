"""Live counts by event-time window.

Each micro-batch adds up its own rows by window, with no state beyond the batch,
and writes the partial sums; ``current`` adds them up. A row counts whenever it
comes, so none is too late. Rows that come later than ``LATENESS`` after the
newest one of the batches before are counted in a side table as well.

``closing_minutes`` and ``closing_headlines`` are the form with watermark and
state, for displays that need finished windows at once: what is open is held in
the state store, what is finished is appended once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from opinara.operators.panels import label_counts
from opinara.schema import CLASSES
from opinara.sources.sinks import query_id, summed, write_batch

# From when on a row is noted as late.
LATENESS = "1 day"
MINUTE = "minute"
SUMS = ["total_reviews", *reversed(CLASSES), "confidence_sum"]


def minute_sums(predictions: DataFrame) -> DataFrame:
    """Rows, labels and the sum of confidence per minute."""
    minute = F.date_trunc("minute", F.col("processed_ts").cast("timestamp_ntz")).alias(MINUTE)
    confidence = F.sum(F.coalesce("confidence", F.lit(0.0))).alias("confidence_sum")
    return predictions.groupBy(minute).agg(F.count(F.lit(1)).alias("total_reviews"), *label_counts(), confidence)


def by_minute(sums: DataFrame) -> DataFrame:
    """Label counts per minute, from summed minutes."""
    return sums.select(MINUTE, *reversed(CLASSES))


def sliding_headline(sums: DataFrame, minutes: int = 5) -> DataFrame:
    """Totals, label counts and mean confidence of each sliding window, from summed minutes.

    Minutes, not rows, are repeated for the windows they lie in.
    """
    back = F.explode(F.sequence(F.lit(0), F.lit(minutes - 1)))
    spread = sums.filter(F.col(MINUTE).isNotNull()).withColumn("back", back)
    start = F.col(MINUTE) - F.make_dt_interval(mins=F.col("back"))
    grouped = spread.groupBy(start.alias("window_start")).agg(*[F.sum(c).alias(c) for c in SUMS])
    return grouped.select(
        "window_start",
        (F.col("window_start") + F.make_dt_interval(mins=F.lit(minutes))).alias("window_end"),
        "total_reviews",
        *reversed(CLASSES),
        (F.col("confidence_sum") / F.col("total_reviews")).alias("avg_confidence"),
    )


def current(spark: SparkSession, path: str) -> DataFrame:
    """The sums by minute over all batches so far."""
    return summed(spark.read.parquet(path), [MINUTE])


def _minute_sink(path: str, late: str, checkpoint: str, lateness: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = query_id(spark, checkpoint)
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(minute_sums(held), path, batch_id, query, MINUTE)
            # One row per batch: the newest time in it, and how many of its rows came late.
            newest = F.max(F.col("processed_ts").cast("timestamp_ntz"))
            last = None
            if batch_id:
                told = spark.read.parquet(late).filter((F.col("query") == query) & (F.col("batch_id") < batch_id))
                last = told.agg(F.max("newest")).first()[0]
            bound = F.lit(last).cast("timestamp_ntz") - F.expr(f"INTERVAL {lateness}")
            too_late = F.count_if(F.col("processed_ts").cast("timestamp_ntz") < bound)
            write_batch(held.agg(newest.alias("newest"), too_late.alias("late_rows")), late, batch_id, query)
        finally:
            held.unpersist()

    return write


def start_minutes(
    predictions: DataFrame, path: str, late: str, checkpoint: str, lateness: str = LATENESS, **trigger
) -> StreamingQuery:
    """Write each batch's sums by minute to ``path``, and to ``late`` how many of its rows came late."""
    writer = predictions.writeStream.foreachBatch(_minute_sink(path, late, checkpoint, lateness))
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


# Live windows with bounded state: a minute is closed and written once when the watermark passes its end, and its state
# goes. Rows that come later are set aside as rows, see ``start_late_rows``.


def closing_minutes(predictions: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Totals per minute of a stream; in append mode each minute comes once, when no more rows are waited for.

    State holds one row per open minute, however many rows arrive.
    """
    times = predictions.withColumn("processed_ts", F.col("processed_ts").cast("timestamp"))
    minute = F.window("processed_ts", "1 minute").alias("window")
    confidence = F.sum(F.coalesce("confidence", F.lit(0.0))).alias("confidence_sum")
    counts = [F.count(F.lit(1)).alias("total_reviews"), *label_counts(), confidence]
    return times.withWatermark("processed_ts", lateness).groupBy(minute).agg(*counts)


def flat_minutes(minutes: DataFrame) -> DataFrame:
    """``closing_minutes`` with the start of the minute in place of the window."""
    start = F.col("window.start").cast("timestamp_ntz").alias(MINUTE)
    return minutes.select(start, *SUMS)


def closing_headlines(predictions: DataFrame, lateness: str = LATENESS, minutes: int = 5) -> DataFrame:
    """Totals, label counts and mean confidence of each sliding window, when it is closed.

    A second stateful operator over the closed minutes, tied by their event time: minutes, not rows, are repeated for
    the windows they lie in, and both states are bounded by the watermark.
    """
    closed = closing_minutes(predictions, lateness).withColumn("minute_end", F.window_time("window"))
    sliding = F.window("minute_end", f"{minutes} minutes", "1 minute").alias("sliding")
    found = closed.groupBy(sliding).agg(*[F.sum(c).alias(c) for c in SUMS])
    return found.select(
        F.col("sliding.start").cast("timestamp_ntz").alias("window_start"),
        F.col("sliding.end").cast("timestamp_ntz").alias("window_end"),
        "total_reviews",
        *reversed(CLASSES),
        (F.col("confidence_sum") / F.col("total_reviews")).alias("avg_confidence"),
    )


def _late_sink(path: str, bounds: str, checkpoint: str, lateness: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = query_id(spark, checkpoint)
        # Only the batch before is read: it carries the newest time of all batches up to it.
        last = None
        if batch_id:
            last = spark.read.parquet(f"{bounds.rstrip('/')}/query={query}/batch_id={batch_id - 1}").first()["newest"]
        time = F.col("processed_ts").cast("timestamp_ntz")
        end = F.date_trunc("minute", time).cast("timestamp_ntz") + F.make_dt_interval(mins=F.lit(1))
        too_late = end <= F.lit(last).cast("timestamp_ntz") - F.expr(f"INTERVAL {lateness}")
        # Newest time and counts are gathered while the late rows are written: the batch is read once.
        seen = Observation(f"late-{batch_id}")
        marked = batch.withColumn("_late", F.coalesce(too_late, F.lit(False)))
        marked = marked.observe(seen, F.max(time).alias("newest"), F.count_if("_late").alias("late_rows"), F.count(F.lit(1)).alias("rows"))
        write_batch(marked.filter("_late").drop("_late"), path, batch_id, query, "processed_ts")
        told = seen.get
        newest = max((t for t in (last, told.get("newest")) if t is not None), default=None)
        row = [(newest, told.get("late_rows") or 0, told.get("rows") or 0)]
        note = spark.createDataFrame(row, "newest timestamp_ntz, late_rows bigint, rows bigint")
        write_batch(note.coalesce(1), bounds, batch_id, query)

    return write


def start_late_rows(
    predictions: DataFrame, path: str, bounds: str, checkpoint: str, lateness: str = LATENESS, **trigger
) -> StreamingQuery:
    """Set aside, as they are, the rows whose minute had ended ``lateness`` before the newest row of earlier batches.

    ``path`` gets the rows, ``bounds`` for each batch the newest time so far and the numbers of its rows and late rows.
    These are the rows that ``closing_minutes`` no longer counts, where both queries see the same batches and are
    idle between them. Under load Spark closes a minute up to a batch later, so it may still count a row that is here.
    """
    writer = predictions.writeStream.foreachBatch(_late_sink(path, bounds, checkpoint, lateness))
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def state_rows(query: StreamingQuery) -> int:
    """The most rows that a query's stateful operators held after any of its last batches."""
    return max((sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in query.recentProgress), default=0)
