"""Physical plans as text."""

from __future__ import annotations


def plan(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
