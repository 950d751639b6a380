"""Ratings, classes and helpfulness votes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from opinara.schema import CLASSES, UNKNOWN


def sentiment_code(overall: Column) -> Column:
    """0 below three stars, 1 at three, else 2. A missing rating counts as 2."""
    return F.when(overall < 3, 0).when(overall == 3, 1).otherwise(2)


def sentiment_text(code: Column, names: Sequence[str] = CLASSES) -> Column:
    """Name of a class code; the last name takes every other code."""
    return F.when(code == 0, names[0]).when(code == 1, names[1]).otherwise(names[2])


def label_display(label: Column) -> Column:
    """The label as shown to a reader."""
    return F.when(label.isin(*CLASSES), F.initcap(label)).otherwise(UNKNOWN.capitalize())


def parse_helpful(df: DataFrame, column: str = "helpful") -> Column:
    """The vote pair as an array, also where it was stored as text such as ``[1, 2]``."""
    if isinstance(df.schema[column].dataType, StringType):
        return F.from_json(F.col(column), "array<int>")
    return F.col(column)


def helpful_votes(helpful: Column) -> Column:
    return F.get(helpful, F.lit(0))


def total_votes(helpful: Column) -> Column:
    return F.get(helpful, F.lit(1))


def helpfulness_ratio(votes: Column, total: Column) -> Column:
    """Share of helpful votes; 0 where nobody voted."""
    return F.when(total > 0, votes / total).otherwise(F.lit(0.0))
