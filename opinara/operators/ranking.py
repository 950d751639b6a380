"""Exact "first n of each group" without sorting a group in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.session import stored

HEX_DIGITS = 4  # 65,536 hash buckets


def hash_order(key: str) -> Column:
    """A reproducible pseudo-random order, whatever the partitioning."""
    return F.md5(F.col(key).cast("string"))


def group_cuts(
    df: DataFrame,
    group: str,
    key: str,
    quota: Callable[[Column, Column], Column],
    hex_digits: int = HEX_DIGITS,
) -> DataFrame:
    """Where in hash order each group's first ``quota`` rows end, one row per group.

    ``quota`` gets the group's row count and the largest group's row count.
    ``key`` must be unique, and ``group`` must have few values, as class labels
    have. Rows fall into buckets by the first digits of their hash, and bucket
    counts show which bucket the quota ends in; only that one, of 65,536, is
    sorted. All this reads only the two columns. The result is written, so the
    planner broadcasts it by its true size.
    """
    # Everything before the last step reads this narrow table, not the input.
    bucket = F.substring(hash_order(key), 1, hex_digits).alias("_bucket")
    narrow = stored(df.select(F.col(group).alias("_group"), F.col(key).alias("_key"), hash_order(key).alias("_hash"), bucket), "hashes")
    per_bucket = stored(narrow.groupBy("_group", "_bucket").agg(F.count(F.lit(1)).alias("_rows")), "bucket-counts")
    whole = Window.partitionBy("_group")
    edges = per_bucket.select(
        "_group",
        "_bucket",
        "_rows",
        (F.sum("_rows").over(whole.orderBy("_bucket")) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(whole).alias("group_rows"),
    )
    largest = per_bucket.groupBy("_group").agg(F.sum("_rows").alias("n")).agg(F.max("n")).scalar()
    edges = edges.withColumn("largest_rows", largest)
    edges = edges.withColumn("_quota", quota(F.col("group_rows"), F.col("largest_rows")).cast("bigint"))
    ends_here = (F.col("_before") <= F.col("_quota")) & (F.col("_quota") < F.col("_before") + F.col("_rows"))
    cuts = edges.groupBy("_group", "group_rows", "largest_rows").agg(
        F.max(F.when(ends_here, F.col("_bucket"))).alias("_cut"),
        F.max(F.when(ends_here, F.col("_quota") - F.col("_before"))).alias("_left"),
    )
    cuts = stored(cuts, "group-cuts")

    wanted = cuts.filter(F.col("_left") > 0).select(F.col("_group").alias("_cut_group"), "_cut", "_left")
    inside = narrow.join(wanted, F.col("_group").eqNullSafe(F.col("_cut_group")) & (F.col("_bucket") == F.col("_cut")))
    place = F.row_number().over(Window.partitionBy("_group").orderBy("_hash", "_key"))
    last = inside.withColumn("_place", place).filter(F.col("_place") == F.col("_left"))
    last = last.select(F.col("_group").alias("_last_group"), F.col("_hash").alias("_last"), F.col("_key").alias("_last_key"))
    # Where the bucket gives no row, its own digits come before all hashes in it.
    upto = F.coalesce("_last", "_cut").alias("_upto")
    joined = cuts.join(last, F.col("_group").eqNullSafe(F.col("_last_group")), "left")
    return stored(joined.select("_group", "group_rows", "largest_rows", upto, "_last_key"), "cuts")


def mark_first(df: DataFrame, group: str, key: str, cuts: DataFrame) -> DataFrame:
    """Add ``chosen`` (is the row among its group's first?), ``group_rows`` and ``largest_rows``.

    One pass: each row is compared with its group's last chosen row. Null is a group as any other.
    """
    order = hash_order(key)
    before = (order < F.col("_upto")) | ((order == F.col("_upto")) & (F.col(key) <= F.col("_last_key")))
    chosen = F.col("_upto").isNull() | F.coalesce(before, F.lit(False))
    joined = df.join(cuts, F.col(group).eqNullSafe(F.col("_group")))
    return joined.withColumn("chosen", chosen).drop("_upto", "_last_key", "_group")


def first_of_group(df: DataFrame, group: str, key: str, quota: Callable[[Column, Column], Column]) -> DataFrame:
    """The first ``quota`` rows of each group in hash order."""
    marked = mark_first(df, group, key, group_cuts(df, group, key, quota))
    return marked.filter("chosen").select(*df.columns)
