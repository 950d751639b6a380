"""The prediction store: exactly-once file sink, day folders, compaction beside a running stream."""

from __future__ import annotations

import datetime as dt
import os
import re

import pytest
from plan_text import plan
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.session import work_folder
from opinara.streaming.store import compact_store, scan_store, start_store

SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("label", T.StringType()), T.StructField("processed_ts", T.TimestampType())])
START = dt.datetime(2024, 3, 1, 22)


def rows(first, last):
    return [(i, "positive", None if i == 5 else START + dt.timedelta(minutes=30 * i)) for i in range(first, last)]


class Stream:
    """A folder that grows, and a query that is started anew over it each time."""

    def __init__(self, spark):
        self.spark = spark
        self.source, self.path, self.checkpoint, self.copy = (work_folder(spark, f"store-{n}") for n in ("in", "out", "c", "copy"))

    def send(self, first, last):
        self.spark.createDataFrame(rows(first, last), SCHEMA).coalesce(2).write.mode("append").parquet(self.source)
        return self

    def run(self):
        stream = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(self.source)
        start_store(stream, self.path, self.checkpoint, {"availableNow": True}).awaitTermination()
        return self

    def scan(self, **how):
        return scan_store(self.spark, self.path, SCHEMA, **how)

    def numbers(self, **how):
        return sorted(r.n for r in self.scan(**how).collect())


@pytest.fixture
def stream(spark):
    return Stream(spark)


def test_restarts_add_each_row_once(stream):
    stream.send(0, 10).run().run().send(10, 20).run()
    assert stream.numbers() == list(range(20))


def test_files_that_no_batch_committed_are_not_read(stream, spark):
    stream.send(0, 10).run()
    spark.createDataFrame(rows(90, 95), SCHEMA).write.mode("append").parquet(f"{stream.path}/date=2024-03-01")
    assert stream.numbers() == list(range(10))


def test_days_prune_files(stream):
    stream.send(0, 60).run()
    text = plan(stream.scan().filter(F.col("date") >= "2024-03-02"))
    assert re.search(r"PartitionFilters: \[[^]]*date", text)
    assert {r.date for r in stream.scan(date="2024-03-02").collect()} == {"2024-03-02", "2024-03-03", "none"}


def test_compaction_beside_a_running_stream(stream, spark):
    stream.send(0, 10).run()
    copy = {"copy": stream.copy}
    assert stream.numbers(**copy) == list(range(10))
    # Rows come in, of days that are copied already, between two compactions and after the last.
    assert compact_store(spark, stream.path, SCHEMA, stream.copy) > 0
    stream.send(10, 20).run()
    assert stream.numbers(**copy) == list(range(20))
    assert compact_store(spark, stream.path, SCHEMA, stream.copy, files_per_day=2) > 0
    assert compact_store(spark, stream.path, SCHEMA, stream.copy) == 0
    assert stream.numbers(**copy) == list(range(20))
    assert all(stream.copy in f for f in stream.scan(**copy).inputFiles())
    stream.send(20, 25).run()
    assert stream.numbers(**copy) == stream.numbers() == list(range(25))
    assert stream.numbers(date="2024-03-02", **copy) == [*range(4, 25)]


def test_a_compaction_that_fails_changes_nothing(stream, spark):
    stream.send(0, 10).run()
    # What it leaves before its note is written.
    spark.createDataFrame(rows(0, 10), SCHEMA).withColumn("date", F.lit("2024-03-01")).write.partitionBy("date").parquet(f"{stream.copy}/rows/generation=lost")
    assert stream.numbers(copy=stream.copy) == list(range(10))
    compact_store(spark, stream.path, SCHEMA, stream.copy)
    assert stream.numbers(copy=stream.copy) == list(range(10))


def test_an_empty_stream_has_an_empty_table(stream, spark):
    os.makedirs(stream.source.removeprefix("file:"), exist_ok=True)
    stream.run()
    spark.createDataFrame([], SCHEMA).write.mode("append").parquet(stream.source)
    stream.run()
    assert stream.numbers() == []
