"""Profiles of a review table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.bins import bin_edge, bin_no, bin_range
from opinara.operators.quantiles import count_values, exact_quantiles

GRID = 200


def unpivoted(row: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    """A one-row table of ``columns`` as rows ``column, value``."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias(value)) for c in columns]
    return row.select(F.inline(F.array(*pairs)))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(df.columns)).alias("n_columns"))


def column_types(df: DataFrame) -> DataFrame:
    """Each column's place and type, and how many rows have it filled."""
    filled = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"`{c}`").alias("filled"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return filled.select(F.inline(F.array(*rows)))


def null_counts(df: DataFrame) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return unpivoted(counts, df.columns, "nulls")


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles, one row per column."""
    counts = count_values(df, columns)
    n = F.sum("n")
    sums = counts.groupBy("column").agg(
        n.alias("count"), (F.sum(F.col("n") * F.col("value")) / n).alias("mean"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    # One row per column name given.
    apart = counts.join(F.broadcast(sums.select("column", "mean")), "column")
    squares = apart.groupBy("column").agg(F.sum(F.col("n") * F.pow(F.col("value") - F.col("mean"), F.lit(2))).alias("squares"))
    deviation = F.when(F.col("count") > 1, F.sqrt(F.col("squares") / (F.col("count") - 1))).alias("std")
    moments = sums.join(squares, "column").select("column", "count", "mean", deviation, "min", "max")
    quartiles = exact_quantiles(counts, [0.25, 0.5, 0.75])
    named = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    wide = quartiles.groupBy("column").agg(
        *[F.max(F.when(F.col("share") == s, F.col("value"))).alias(name) for s, name in named.items()]
    )
    return moments.join(wide, "column")


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Spark's own summary: count, mean, stddev, min and max of text columns."""
    return df.describe(*columns)


def distinct_counts(df: DataFrame, columns: Sequence[str], relative_error: float | None = None) -> DataFrame:
    """Distinct non-null values; with ``relative_error``, a one-pass estimate."""
    if relative_error is None:
        counts = df.agg(*[F.count_distinct(F.col(c)).alias(c) for c in columns])
    else:
        counts = df.agg(*[F.approx_count_distinct(c, relative_error).alias(c) for c in columns])
    return unpivoted(counts, columns, "distinct")


#: Base-2 logarithm of a sketch's cells, and how far an estimate may be off: three standard errors of 1.04 / sqrt(cells).
SKETCH_CELLS = 12
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_CELLS / 2)


def distinct_sketches(df: DataFrame, columns: Sequence[str], *by: str, cells: int = SKETCH_CELLS) -> DataFrame:
    """``by, column, sketch``: one sketch of the distinct values per group and column, of a fixed largest size.

    Store them by day, say: new rows need only their own sketches, and ``merged_distinct`` counts over any of them.
    """
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    values = df.select(*by, F.inline(F.array(*pairs)))
    return values.groupBy(*by, "column").agg(F.hll_sketch_agg("value", F.lit(cells)).alias("sketch"))


def merged_distinct(sketches: DataFrame, *by: str) -> DataFrame:
    """``by, column, distinct``: estimates over all given sketches, within ``SKETCH_ERROR`` nearly always."""
    merged = sketches.groupBy(*by, "column").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*by, "column", F.hll_sketch_estimate("sketch").alias("distinct"))


def rating_counts(df: DataFrame) -> DataFrame:
    return df.filter(F.col("overall").isNotNull()).groupBy("overall").agg(F.count(F.lit(1)).alias("n")).orderBy("overall")


def avg_rating(df: DataFrame) -> DataFrame:
    return df.agg(F.round(F.avg(F.col("overall").cast("double")), 2).alias("avg_rating"))


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per class, largest first."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), label)


def value_counts(df: DataFrame, value: Column, *keys: str) -> DataFrame:
    """Rows per distinct value: the value, costly or not, is worked out once per row."""
    values = df.select(value.cast("double").alias("value"), *keys).groupBy("value", *keys)
    return values.agg(F.count(F.lit(1)).alias("n")).filter(F.col("value").isNotNull())


def with_bins(counts: DataFrame, bins: int) -> DataFrame:
    """Add the range to bin, ``low`` and ``high``, and the value's ``bin``."""
    ends = counts.agg(F.struct(F.min("value").alias("low"), F.max("value").alias("high"))).scalar()
    ranged = counts.withColumn("_ends", ends)
    low, high = bin_range(F.col("_ends.low"), F.col("_ends.high"))
    ranged = ranged.withColumns({"low": low, "high": high}).drop("_ends")
    return ranged.withColumn("bin", bin_no(F.col("value"), F.col("low"), F.col("high"), bins))


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """Equal-width bins over the value range, empty ones included."""
    counts = with_bins(value_counts(df, value), bins).groupBy("low", "high", "bin").agg(F.sum("n").alias("n"))
    by_bin = counts.groupBy("low", "high").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("n_of"))
    filled = by_bin.select("low", "high", "n_of", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    low, high, bin_ = F.col("low"), F.col("high"), F.col("bin")
    right = F.when(bin_ == bins - 1, high).otherwise(bin_edge(bin_ + 1, low, high, bins))
    n = F.coalesce(F.try_element_at("n_of", bin_), F.lit(0)).cast("bigint")
    return filled.select("bin", bin_edge(bin_, low, high, bins).alias("left"), right.alias("right"), n.alias("n"))


def density(df: DataFrame, value: Column, points: int = GRID, cells: int | None = None) -> DataFrame:
    """Gaussian kernel density over a grid from the least to the largest value.

    The bandwidth follows Scott's rule. Equal values are counted first, so the
    work is distinct values times grid points, summed within tasks. Shares of votes
    and word counts have few distinct values. For a column that has many, ``cells``
    bounds the work: values in one of so many equal cells count at their mean, no
    farther from it than the width of a cell.
    """
    counts = value_counts(df, value)
    if cells:
        merged = with_bins(counts, cells).groupBy("bin")
        counts = merged.agg((F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("value"), F.sum("n").alias("n"))
    mean = counts.agg(F.sum(F.col("n") * F.col("value")) / F.sum("n")).scalar()
    off = counts.withColumn("off", F.col("value") - mean)
    deviation = F.sqrt(F.sum(F.col("n") * F.col("off") * F.col("off")) / (F.sum("n") - 1))
    summary = off.agg(
        F.struct(
            F.sum("n").alias("rows"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            (deviation * F.pow(F.sum("n").cast("double"), F.lit(-0.2))).alias("width"),
        )
    ).scalar()
    spread = counts.withColumn("s", summary).withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    x = F.col("s.low") + F.col("point") * ((F.col("s.high") - F.col("s.low")) / (points - 1))
    z = (x - F.col("value")) / F.col("s.width")
    kernel = F.col("n") * F.exp(z * z * -0.5) / (F.col("s.rows") * F.col("s.width") * F.sqrt(F.lit(2.0) * F.pi()))
    return spread.groupBy("point", x.alias("x")).agg(F.sum(kernel).alias("density"))


def binned_scatter(df: DataFrame, value: Column, against: str, bins: int) -> DataFrame:
    """Rows per bin and value of the other column."""
    return with_bins(value_counts(df, value, against), bins).groupBy("bin", against).agg(F.sum("n").alias("n"))
