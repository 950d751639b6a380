"""How a query is registered."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


class Registry(dict[str, Query]):
    """Queries by name, filled by decorators."""

    def add(self, name: str, sql: str | None = None):
        def register(run: Callable[[SparkSession, str], DataFrame]):
            if name in self:
                raise ValueError(f"query {name} is registered twice")
            self[name] = Query(run, sql)
            return run

        return register


def sql_list(words: list[str]) -> str:
    """A list of SQL string literals."""
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)
