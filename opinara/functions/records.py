"""Typed and defaulted fields."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def literal(value: Any) -> Column:
    return F.array(*[F.lit(v) for v in value]) if isinstance(value, list) else F.lit(value)


def field_or(df: DataFrame, name: str, default: Any) -> Column:
    """The field, or the default where the value or the whole column is missing."""
    if name not in df.columns:
        return literal(default).alias(name)
    if default is None:
        return F.col(name)
    return F.coalesce(F.col(name), literal(default)).alias(name)


def default_fields(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Fill the named fields, adding those that the table lacks."""
    rest = [c for c in df.columns if c not in defaults]
    return df.select(*rest, *[field_or(df, name, value) for name, value in defaults.items()])


def typed(column: Column, to: str, default: Any) -> Column:
    """A cast that gives the default for what cannot be cast."""
    return F.coalesce(column.try_cast(to), F.lit(default).cast(to))
