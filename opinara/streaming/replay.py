"""Sending a table as messages at a set pace."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from opinara.sources.messages import file_stream, send_to_files, to_messages

# Rows sent together and the pause between sends.
ROWS = 4
PAUSE = "10 seconds"


def replay(reviews: DataFrame, path: str, rows: int, sent_at: Column | None = None) -> DataFrame:
    """A message stream that takes one file of at most ``rows`` messages per trigger.

    Start it with ``trigger(processingTime=PAUSE)`` for the pace. Choose ``rows``
    by the size of the table: each of them makes a file. From a topic, a pace of
    few rows needs no files: ``topic_stream(..., max_per_trigger=ROWS)``.
    """
    send_to_files(to_messages(reviews, sent_at), path, rows)
    return file_stream(reviews.sparkSession, path, files_per_trigger=1)
