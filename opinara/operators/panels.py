"""Report panels over the prediction table.

Every panel is one aggregation whose counts are combined before the shuffle,
so a hot product or reviewer costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.display import minute, minute_label
from opinara.functions.text import length_bin, length_bin_no
from opinara.operators.filters import known_labels
from opinara.operators.projections import review_cards
from opinara.schema import CLASSES, UNKNOWN


def label_counts() -> list[Column]:
    """Rows of each known label, as columns named after it."""
    return [F.count_if(F.coalesce(F.col("label") == c, F.lit(False))).alias(c) for c in reversed(CLASSES)]


def mean_or_zero(column: str) -> Column:
    """Mean over all rows; missing values count as 0, and so does an empty table."""
    total = F.sum(F.coalesce(F.col(column), F.lit(0)).cast("double"))
    return F.coalesce(F.try_divide(total, F.count(F.lit(1))), F.lit(0.0))


def headline(df: DataFrame, rating: bool = True) -> DataFrame:
    """Totals and averages in one row."""
    averages = [mean_or_zero("confidence").alias("avg_confidence")]
    if rating:
        averages.append(mean_or_zero("overall").alias("avg_rating"))
    return df.agg(F.count(F.lit(1)).alias("total_reviews"), *label_counts(), *averages)


def by_minute(df: DataFrame) -> DataFrame:
    """Label counts per minute, with the short label shown on the axis."""
    out = df.groupBy(minute(F.col("processed_ts")).alias("minute")).agg(*label_counts())
    return out.select("minute", minute_label(F.col("minute")).alias("minute_label"), *reversed(CLASSES)).orderBy("minute")


def by_key(df: DataFrame, key: str) -> DataFrame:
    """Label counts per non-empty key, in key order."""
    return known_labels(df, key).groupBy(key).agg(*label_counts()).orderBy(key)


def rating_key(overall: Column) -> Column:
    return F.coalesce(overall.cast("string"), F.lit("N/A"))


def by_rating(df: DataFrame) -> DataFrame:
    """Label counts per rating, lowest first; missing ratings come before."""
    rated = df.filter(F.col("label").isin(*CLASSES))
    out = rated.groupBy("overall").agg(*label_counts())
    return out.orderBy(F.coalesce("overall", F.lit(-1.0))).select(
        rating_key(F.col("overall")).alias("rating"), *reversed(CLASSES)
    )


def top_by_key(df: DataFrame, key: str, rows: int = 10) -> DataFrame:
    """The keys with the most known-label rows; among equals, the one seen last."""
    out = known_labels(df, key).groupBy(key)
    out = out.agg(*label_counts(), F.count(F.lit(1)).alias("total"), F.max("processed_ts").alias("newest"))
    return out.orderBy(F.desc("total"), F.desc("newest"), key).limit(rows)


def by_length(df: DataFrame) -> DataFrame:
    """Label counts per length class, in the order of the class names as text."""
    text = F.col("reviewText")
    binned = known_labels(df, "reviewText").select(
        "label", length_bin(text).alias("length_bin"), length_bin_no(text).alias("bin_no")
    )
    return binned.groupBy("length_bin", "bin_no").agg(*label_counts()).orderBy("length_bin")


def newest_first(df: DataFrame, tie: str) -> DataFrame:
    return df.orderBy(F.desc("processed_ts"), tie)


def recent_cards(df: DataFrame, tie: str, rows: int = 10) -> DataFrame:
    """Cards of the newest reviews."""
    return review_cards(newest_first(df, tie).limit(rows))


def label_totals(df: DataFrame) -> DataFrame:
    """Rows per label next to the number of all rows."""
    counts = df.groupBy(F.coalesce("label", F.lit(UNKNOWN)).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("label", "n", F.sum("n").over(Window.partitionBy()).alias("total_count"))


def all_panels(df: DataFrame, rows: int = 10) -> DataFrame:
    """Every offline panel from a single scan, in long form.

    ``panel`` names the grouping and ``key`` its value. Product and reviewer keep
    their top rows: Spark cuts each task's share to that many before it ranks them.
    """
    text = F.col("reviewText")
    narrow = df.select(
        "label",
        "processed_ts",
        F.nullif(F.col("reviewTime"), F.lit("")).alias("day"),
        rating_key(F.col("overall")).alias("rating"),
        F.nullif(F.col("asin"), F.lit("")).alias("product"),
        F.nullif(F.col("reviewerName"), F.lit("")).alias("reviewer"),
        length_bin(F.nullif(text, F.lit(""))).alias("length"),
    ).filter(F.col("label").isin(*CLASSES))
    panels = ["day", "rating", "product", "reviewer", "length"]
    cols = [F.col(p) for p in panels]
    counts = narrow.groupingSets([[c] for c in cols], *cols).agg(
        *label_counts(),
        F.count(F.lit(1)).alias("total"),
        F.max("processed_ts").alias("newest"),
        F.grouping_id().alias("gid"),
    )
    # Bit i of the grouping id is 0 for the one column that a row is grouped by.
    every = 2 ** len(panels) - 1
    which = F.lit(None)
    for i, p in enumerate(panels):
        which = F.when(F.col("gid") == every - 2 ** (len(panels) - 1 - i), p).otherwise(which)
    long = counts.select(which.alias("panel"), F.coalesce(*cols).alias("key"), *reversed(CLASSES), "total", "newest")
    # A key of a whole panel is a group of its own, so the limit keeps all of them.
    limited = F.col("panel").isin("product", "reviewer")
    group = Window.partitionBy("panel", F.when(~limited, F.col("key")))
    rank = F.row_number().over(group.orderBy(F.desc("total"), F.desc("newest"), "key"))
    ranked = long.filter(F.col("key").isNotNull()).withColumn("rank", rank).filter(F.col("rank") <= rows)
    return ranked.withColumn("rank", F.when(limited, F.col("rank")))
