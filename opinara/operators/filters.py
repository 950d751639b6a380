"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.schema import CLASSES

TEXT_FIELDS = ("reviewText", "review_text", "text")


def with_text(df: DataFrame, column: str = "reviewText") -> DataFrame:
    """Rows whose text is not null; empty text passes."""
    return df.filter(F.col(column).isNotNull())


def first_text(df: DataFrame, fields: Sequence[str] = TEXT_FIELDS) -> Column:
    """The first non-empty text among the fields the table has."""
    present = [F.nullif(F.col(f), F.lit("")) for f in fields if f in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def coalesce_text(df: DataFrame, fields: Sequence[str] = TEXT_FIELDS) -> DataFrame:
    """Rows with any text, which becomes ``reviewText``; empty text counts as none."""
    return df.withColumn("reviewText", first_text(df, fields)).filter(F.col("reviewText").isNotNull())


def recent(df: DataFrame, as_of: Column, interval: str, ts: str = "processed_ts") -> DataFrame:
    """Realtime rows since ``as_of`` minus an interval such as ``5 MINUTES``.

    A table in folders by ``date`` is read from the first day on.
    """
    since = as_of - F.expr(f"INTERVAL {interval}")
    rows = df.filter(F.col("is_realtime") & (F.col(ts) >= since))
    return rows.filter(F.col("date").cast("string") >= F.date_format(since, "yyyy-MM-dd")) if "date" in df.columns else rows


def of_class(df: DataFrame, label: str | None, column: str = "label") -> DataFrame:
    """Rows of one class; null is one as well."""
    return df.filter(F.col(column).isNull() if label is None else F.col(column) == label)


def known_labels(df: DataFrame, key: str) -> DataFrame:
    """Rows with one of the three labels and a key that is neither null nor empty."""
    return df.filter(F.col("label").isin(*CLASSES) & (F.col(key) != ""))
