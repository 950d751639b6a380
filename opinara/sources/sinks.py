"""Micro-batch sinks that may be repeated without duplicating rows.

A table of batches lies in folders ``query=<id>/batch_id=<n>/date=<day>``. Each
query has folders of its own, so one that starts again at batch 0 with a new
checkpoint leaves the older rows; a batch that is repeated replaces its whole
folder, also where it has become empty; and a report on recent days reads only
their folders.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The columns that the folders add.
FOLDERS = ("query", "batch_id", "date")


def write_batch(df: DataFrame, path: str, batch_id: int, query: str = "0", time: str | None = None) -> None:
    """Put one micro-batch in its own folder, replacing an earlier attempt at it.

    ``time`` names the column that gives a row's day.
    """
    day = F.date_format(time, "yyyy-MM-dd") if time else F.lit("all")
    rows = df.withColumn("date", F.coalesce(day, F.lit("none")))
    rows.write.mode("overwrite").partitionBy("date").parquet(f"{path.rstrip('/')}/query={query}/batch_id={batch_id}")


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query that a checkpoint belongs to; it stays over restarts."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def batch_sink(path: str, checkpoint: str | None = None, time: str | None = None) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: the whole batch in one columnar write, below the query's own id."""

    def write(df: DataFrame, batch_id: int) -> None:
        write_batch(df, path, batch_id, query_id(df.sparkSession, checkpoint) if checkpoint else "0", time)

    return write


def document_store_sink(options: Mapping[str, str]) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: write to a MongoDB collection, replacing documents with the same id.

    Needs the MongoDB Spark connector. ``idFieldList`` has to name the fields that
    identify a document; without it a repeated batch would be there twice.
    """
    if not options.get("idFieldList"):
        raise ValueError("name the id fields in idFieldList, so that a repeated batch replaces its documents")

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.format("mongodb").mode("append").options(**{"operationType": "replace", **options}).save()

    return write


def compact(spark: SparkSession, path: str, target: str, files_per_day: int = 1) -> str:
    """Copy a table of batches to ``target`` with few files a day, as one batch.

    Micro-batches leave many small files; run this over a table that is no longer written, then read the copy.
    """
    rows = spark.read.parquet(path).drop("query", "batch_id")
    salt = F.floor(F.rand(0) * files_per_day)
    folder = f"{target.rstrip('/')}/query=compacted/batch_id=0"
    rows.repartition("date", salt).write.mode("overwrite").partitionBy("date").parquet(folder)
    return target


def summed(table: DataFrame, keys: list[str]) -> DataFrame:
    """A table of partial sums by batch, added up over all batches."""
    values = [c for c in table.columns if c not in (*keys, *FOLDERS)]
    return table.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in values])
