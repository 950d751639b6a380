"""Times and numbers in the forms that messages and reports carry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_iso(text: Column) -> Column:
    """ISO text to a time without zone; null where it is no time."""
    return text.try_cast("timestamp_ntz")


def iso(ts: Column) -> Column:
    """ISO text; the fraction appears only where there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, "SSSSSS")
    return F.when(fraction == "000000", whole).otherwise(F.concat(whole, F.lit("."), fraction))


def minute(ts: Column) -> Column:
    """The time cut to the minute."""
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def minute_label(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm")


def percent(share: Column) -> Column:
    """A share as a percentage with two decimals."""
    return F.format_string("%.2f", share * 100)
