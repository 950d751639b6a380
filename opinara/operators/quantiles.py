"""Exact quantiles of large columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.session import stored

BUCKETS = 200
#: A range of at most so many distinct values is sorted; a larger one is cut again.
SMALL = 20_000


def long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column and non-null value."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())


def count_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, value, n`` as a written table: a hot value is one row."""
    return stored(long_form(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")), "value-counts")


def exact_quantiles(counts: DataFrame, shares: Sequence[float], small: int = SMALL) -> DataFrame:
    """``column, share, value`` from ``count_values``, with linear interpolation between neighbours.

    A sketch cuts the distinct values into ranges of like size, and sums per range
    show which of them hold a wanted rank; only those are kept, and cut again until
    each is small enough to sort. The sketch decides balance alone, never the
    result. What reaches the driver is bounded by the number of columns and shares.
    """
    spark = counts.sparkSession
    totals = {r["column"]: r["n"] for r in counts.groupBy("column").agg(F.sum("n").alias("n")).collect()}
    places = [(c, float(s), s * (n - 1)) for c, n in totals.items() for s in shares]
    ranks = {c: sorted({f(p) for name, _, p in places if name == c for f in (math.floor, math.ceil)}) for c in totals}

    rows = counts.select("column", "value", "n", F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("before"))
    largest = None
    while True:
        sizes = rows.groupBy("column", "part").agg(F.count(F.lit(1)).alias("values")).agg(F.max("values")).first()[0] or 0
        if sizes <= small or sizes == largest:
            break
        largest = sizes
        rows = _narrowed(spark, rows, ranks)

    upto = F.sum("n").over(Window.partitionBy("column", "part").orderBy("value"))
    ranked = rows.withColumn("last", F.col("before") + upto - 1).withColumn("first", F.col("last") - F.col("n") + 1)
    wanted = spark.createDataFrame(places, "column string, share double, place double")
    wanted = wanted.withColumn("low_rank", F.floor("place")).withColumn("high_rank", F.ceil("place"))
    # One row per column and share.
    both = ranked.join(F.broadcast(wanted), "column")
    at = [F.when(F.col(r).between(F.col("first"), F.col("last")), F.col("value")) for r in ("low_rank", "high_rank")]
    ends = both.groupBy("column", "share", "place").agg(F.max(at[0]).alias("low"), F.max(at[1]).alias("high"))
    share = F.col("place") - F.floor("place")
    return ends.select("column", "share", (F.col("low") + (F.col("high") - F.col("low")) * share).alias("value"))


def _narrowed(spark, rows: DataFrame, ranks: dict[str, list[int]]) -> DataFrame:
    """The rows of the ranges that hold a wanted rank, after one more cut."""
    steps = [i / BUCKETS for i in range(1, BUCKETS)]
    # At most two parts per column and share.
    splits = rows.groupBy("column", "part").agg(F.percentile_approx("value", steps, 20 * BUCKETS).alias("splits"))
    inside = F.size(F.filter("splits", lambda s: s < F.col("value"))).alias("range")
    placed = stored(rows.join(F.broadcast(splits), ["column", "part"]).select("column", "value", "n", "part", "before", inside), "ranges")
    sums = placed.groupBy("column", "part", "before", "range").agg(F.sum("n").alias("rows")).collect()
    kept, before = [], {}
    for r in sorted(sums, key=lambda r: (r["column"], r.part, r.range)):
        start = before.get((r["column"], r.part), r.before)
        before[r["column"], r.part] = start + r.rows
        if any(start <= rank < start + r.rows for rank in ranks[r["column"]]):
            kept.append((r["column"], r.part, r.range, len(kept), start))
    chosen = spark.createDataFrame(kept, "column string, part int, range int, next int, start bigint")
    found = placed.drop("before").join(F.broadcast(chosen), ["column", "part", "range"])
    return stored(found.select("column", "value", "n", F.col("next").alias("part"), F.col("start").alias("before")), "narrowed")
