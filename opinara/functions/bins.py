"""Equal-width bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bin_range(low: Column, high: Column) -> tuple[Column, Column]:
    """The range to bin; a single value gets half a unit on both sides."""
    flat = low == high
    return F.when(flat, low - 0.5).otherwise(low), F.when(flat, high + 0.5).otherwise(high)


def bin_edge(no: Column, low: Column, high: Column, bins: int) -> Column:
    """Left edge of bin ``no``."""
    return no * ((high - low) / bins) + low


def bin_no(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin of a value, from 0. Bins are closed on the left, the last on both sides.

    The guess by division can be one off where a value lies on an edge, so it
    is checked against the edges themselves.
    """
    guess = F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1))
    return (
        F.when(value < bin_edge(guess, low, high, bins), guess - 1)
        .when((guess < bins - 1) & (value >= bin_edge(guess + 1, low, high, bins)), guess + 1)
        .otherwise(guess)
        .cast("int")
    )
