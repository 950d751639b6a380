"""The prediction store: an append-only table that a stream writes exactly once.

Spark's own file sink writes it, in folders by ``date``, and keeps a log of the
files that each micro-batch committed. Readers take the log's list, so files of a
batch that failed or is repeated are never read, no folder is listed, and a report
on a few days opens the files of those days only.

Micro-batches leave many small files. ``compact_store`` copies what is committed
into few files while the stream goes on, and notes the copied files; from then on
``scan_store`` reads the copy and, of the stream's files, those that came later.
A note appears in one step, after the rows it stands for, so readers see a file
or its copy, never both. A job that fails before leaves a copy that no note names.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

DAY = "date"
NONE = "none"
NOTES = "file string, generation string"
#: Names that readers pass over begin so; a generation is read by its full path.
ROWS, NOTED = "rows", "notes"


def with_day(df: DataFrame, time: str) -> DataFrame:
    """Add the folder column: the day of ``time``, or ``none``."""
    return df.withColumn(DAY, F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.lit(NONE)))


def start_store(
    rows: DataFrame, path: str, checkpoint: str, trigger: dict[str, Any], time: str | None = "processed_ts"
) -> StreamingQuery:
    """Append a stream to the table at ``path``, each row once over failures and restarts from ``checkpoint``.

    One query writes one table; without ``time`` it has no folders by day.
    """
    writer = (with_day(rows, time) if time else rows).writeStream.format("parquet").outputMode("append")
    if time:
        writer = writer.partitionBy(DAY)
    return writer.option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _schema(schema: T.StructType) -> T.StructType:
    """The rows' schema with the folder column as text; Spark would guess a date from it."""
    return T.StructType([*[f for f in schema.fields if f.name != DAY], T.StructField(DAY, T.StringType())])


def _committed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(_schema(schema)).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _notes(spark: SparkSession, copy: str) -> DataFrame:
    if not _exists(spark, f"{copy}/{NOTED}"):
        return spark.createDataFrame([], NOTES)
    return spark.read.schema(NOTES).parquet(f"{copy}/{NOTED}")


def scan_store(spark: SparkSession, path: str, schema: T.StructType, copy: str | None = None, date: str | None = None) -> DataFrame:
    """All committed rows with their ``date``; ``date`` names the first day that is wanted.

    The schema is the declared one, so no file is opened to find it. Which files are left is worked out from their
    names, as Spark itself does for any table.
    """
    wanted = F.lit(True) if date is None else (F.col(DAY) >= date) | (F.col(DAY) == NONE)
    live = _committed(spark, path, schema).filter(wanted)
    notes = [] if copy is None else _notes(spark, copy).collect()
    if not notes:
        return live
    noted = {n.file for n in notes}
    later = [f for f in live.inputFiles() if f not in noted]
    generations = sorted({n.generation for n in notes})
    copied = spark.read.schema(_schema(schema)).option("basePath", f"{copy}/{ROWS}")
    copied = copied.parquet(*[f"{copy}/{ROWS}/generation={g}" for g in generations]).filter(wanted)
    if not later:
        return copied
    rest = spark.read.schema(_schema(schema)).option("basePath", path).parquet(*later).filter(wanted)
    return copied.select(*live.columns).unionByName(rest.select(*live.columns))


def compact_store(spark: SparkSession, path: str, schema: T.StructType, copy: str, files_per_day: int = 1) -> int:
    """Copy the committed files that have no copy yet; how many they were. Safe while the stream runs.

    One compaction at a time; each adds a generation of at most ``files_per_day`` files a day.
    """
    noted = {n.file for n in _notes(spark, copy).collect()}
    files = [f for f in _committed(spark, path, schema).inputFiles() if f not in noted]
    if not files:
        return 0
    generation = uuid.uuid4().hex
    rows = spark.read.schema(_schema(schema)).option("basePath", path).parquet(*files)
    salt = F.pmod(F.xxhash64(*[c for c in rows.columns if c != DAY]), F.lit(files_per_day))
    target = f"{copy}/{ROWS}/generation={generation}"
    rows.repartition(DAY, salt).write.partitionBy(DAY).parquet(target)
    # One file, which Spark renames into place: the notes of a generation appear together.
    spark.createDataFrame([(f, generation) for f in files], NOTES).coalesce(1).write.mode("append").parquet(f"{copy}/{NOTED}")
    return len(files)
