"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: The folder that holds the package.
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def build_session(app: str = "opinara", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every query here assumes.

    Partition counts are left to adaptive execution on a cluster; pass
    ``spark.sql.shuffle.partitions`` in ``conf`` to start from another number.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Times with statistics, which the older default form lacks.
        "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
        # Window state beyond the heap goes to local disk, backed by the checkpoint.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a session in a single process may go without: it gets a temporary
    folder. On a cluster a machine-local folder would be lost with its executor;
    a ``file:`` path there has to be a mount that all machines share.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="opinara-"))
    return context.getCheckpointDir()


def work_folder(spark: SparkSession, name: str) -> str:
    """A path not used before, below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/opinara/{name}-{uuid.uuid4().hex}"


#: Tables written since the innermost ``work_scope`` began.
_WRITTEN: list[list[str]] = []


def on_workers(df: DataFrame) -> DataFrame:
    """``df``, with this package's place known to Python workers on the same machine.

    On a cluster the package is deployed to the executors, as any other; this covers sessions that were started
    without it on their Python path.
    """
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return df


def stored(df: DataFrame, name: str, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, with its own schema or one of the same stored form.

    This cuts the lineage, survives lost executors, and tells the planner the
    true size, so that Spark broadcasts it in a join only where it is small. The
    table stays unless a ``work_scope`` ends.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    if _WRITTEN:
        _WRITTEN[-1].append(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables written inside when it ends.

    Use it around work whose results are written or collected inside.
    """
    _WRITTEN.append([])
    try:
        yield
    finally:
        for path in _WRITTEN.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
