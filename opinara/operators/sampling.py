"""Balancing, cutting and splitting training data."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.operators.filters import of_class
from opinara.operators.ranking import first_of_group, group_cuts, hash_order, mark_first
from opinara.schema import CLASSES
from opinara.session import stored

SEED = 42
CHUNK = 10_000
SPLITS = (("train", 80), ("val", 90), ("test", 100))  # name, upper bound in hundredths


def union_classes(df: DataFrame, classes: Sequence[str] = CLASSES, label: str = "label") -> DataFrame:
    """The table put together from its classes; rows of any other label, or none, come last."""
    rest = df.filter(F.col(label).isNull() | ~F.col(label).isin(*classes))
    return reduce(DataFrame.unionByName, [*[of_class(df, c, label) for c in classes], rest])


def limit_class(
    df: DataFrame, rows: int | Callable[[Column, Column], Column], key: str, label: str = "label"
) -> DataFrame:
    """At most so many rows of each class, the first in hash order.

    ``rows`` may be a function of the class's and the largest class's row count.
    """
    quota = rows if callable(rows) else lambda n, largest: F.lit(rows)
    return first_of_group(df, label, key, quota)


def repeat_rows(df: DataFrame, copies: Column, key: str) -> DataFrame:
    """Each row ``copies`` times, numbered by ``copy`` from 1.

    A row with more than CHUNK copies is first spread over tasks in parts of CHUNK,
    so a tiny class does not hang on a few tasks; the others stay where they are.
    """
    counted = df.withColumn("_copies", copies.cast("bigint"))
    parts = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / CHUNK))
    spread = counted.filter(F.col("_copies") > CHUNK).withColumn("_part", F.explode(parts)).repartition(key, "_part")
    single = counted.filter(F.col("_copies").between(1, CHUNK)).withColumn("_part", F.lit(0).cast("bigint"))
    first = F.col("_part") * CHUNK + 1
    last = F.least(F.col("_copies"), F.col("_part") * CHUNK + CHUNK)
    numbers = F.explode(F.sequence(first, last))
    return single.unionByName(spread).withColumn("copy", numbers).drop("_copies", "_part")


def balance_exact(df: DataFrame, key: str, label: str = "label") -> DataFrame:
    """Repeat rows until every class has as many as the largest.

    Each row appears ``largest // n`` times; the first ``largest % n`` rows in hash
    order appear once more.
    """
    cuts = group_cuts(df, label, key, lambda n, largest: largest % n)
    marked = mark_first(df, label, key, cuts)
    copies = F.floor(F.col("largest_rows") / F.col("group_rows")) + F.when(F.col("chosen"), 1).otherwise(0)
    return repeat_rows(marked, copies, key).select(*df.columns, "copy")


def balance_sampled(df: DataFrame, key: str, label: str = "label", seed: int = SEED) -> DataFrame:
    """Oversample the smaller classes with replacement, at most to the largest class.

    Sampling may fall short of the largest class; it is cut where it goes beyond.
    Every label found is a class, null too. ``copy`` tells rows with one key apart.
    """
    # One count per class, and there are few.
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    largest = max(counts.values(), default=0)
    smaller = {c: n for c, n in counts.items() if n < largest}
    full = [of_class(df, c, label) for c in counts if c not in smaller] or [df]
    kept = reduce(DataFrame.unionByName, full).withColumn("copy", F.lit(1).cast("bigint"))
    if not smaller:
        return kept
    drawn = []
    for c, n in smaller.items():
        # A row that is to be drawn very often is spread over tasks first.
        parts = math.ceil(largest / n / CHUNK)
        spread = of_class(df, c, label).withColumn("_part", F.explode(F.sequence(F.lit(1), F.lit(parts))))
        spread = spread.repartition(key, "_part") if parts > 1 else spread
        drawn.append(spread.drop("_part").sample(True, largest / n / parts, seed))
    # Written once: a sample drawn anew after a lost task could differ.
    numbered = reduce(DataFrame.unionByName, drawn).withColumn("copy", F.monotonically_increasing_id() + 1)
    copy_key = F.concat_ws("#", F.col(key).cast("string"), F.col("copy").cast("string"))
    numbered = stored(numbered.withColumn("_copy_key", copy_key), "sampled")
    cut = first_of_group(numbered, label, "_copy_key", lambda n, _: F.lit(largest)).drop("_copy_key")
    return kept.unionByName(cut)


#: A row's draws have at most this mean; a row with a larger one is drawn in parts, whose draws add up.
MEAN = 8.0
#: Draws of a part beyond this number are less likely than the smallest step of its hash.
MOST = 50


def poisson_steps(mean: Column) -> Column:
    """The chances of at most 0, 1, ... ``MOST`` draws with that mean."""
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), F.array(first).alias("upto"))

    def add(done: Column, k: Column) -> Column:
        p = done["p"] * mean / k
        return F.struct(p.alias("p"), F.array_append(done["upto"], F.element_at(done["upto"], -1) + p).alias("upto"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(MOST)), start, add, lambda done: done["upto"])


def balance_hashed(df: DataFrame, key: str, label: str = "label", seed: int = SEED, cut: bool = True) -> DataFrame:
    """Oversample the smaller classes with replacement, the same rows on every run, cluster and partitioning.

    Sampling with replacement gives each row a Poisson number of copies. Here that number is the Poisson distribution
    inverted at a hash of seed and key, so no row's draw depends on another's, and a lost task draws the same again.
    One pass over the rows: the class sizes, one row per class, are joined to them; nothing reaches the driver.
    ``key`` must be unique; every label found is a class, null too. ``copy`` tells rows with one key apart, and the
    largest class is kept as it is. With ``cut`` no class gets more rows than the largest; it may get fewer.
    """
    sizes = df.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    rate = F.max("_n").over(Window.partitionBy()) / F.col("_n")
    parts = F.ceil(rate / MEAN)
    rates = sizes.select("_label", (rate <= 1).alias("_whole"), F.max("_n").over(Window.partitionBy()).alias("_largest"), rate.alias("_rate"), parts.alias("_parts"))
    rates = stored(rates.withColumn("_steps", poisson_steps(F.col("_rate") / F.col("_parts"))), "class-rates")
    named = df.join(rates, F.col(label).eqNullSafe(F.col("_label")))

    kept = named.filter("_whole").select(*df.columns, F.lit(1).cast("bigint").alias("copy"))
    drawn = repeat_rows(named.filter("not _whole"), F.col("_parts"), key).withColumnRenamed("copy", "_part_no")
    hashed = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"), F.col("_part_no").cast("string")))
    u = F.conv(F.substring(hashed, 1, 13), 16, 10).cast("double") / float(16**13)
    copies = F.size(F.filter("_steps", lambda c: c <= u))
    numbers = F.explode(F.sequence(F.lit(1), copies))
    drawn = drawn.filter(copies > 0).withColumn("_copy", numbers)
    drawn = drawn.withColumn("copy", ((F.col("_part_no") - 1) * (MOST + 1) + F.col("_copy")).cast("bigint"))
    if cut:
        copy_key = F.concat_ws("#", F.col(key).cast("string"), F.col("copy").cast("string"))
        drawn = drawn.withColumn("_copy_key", copy_key)
        largest = F.lit(rates.agg(F.max("_largest")).first()[0] or 0)
        drawn = first_of_group(drawn, label, "_copy_key", lambda n, _: largest)
    return kept.unionByName(drawn.select(*kept.columns))


def downsample(
    df: DataFrame, of: str, key: str, rows: int | None = None, share: float | None = None, label: str = "label"
) -> DataFrame:
    """Drop so many ``rows`` of one class, or a ``share`` of it (0 to 1), the first in hash order."""
    if (rows is None) == (share is None):
        raise ValueError("name either rows or share")

    def quota(n: Column, largest: Column) -> Column:
        return F.floor(n * share) if rows is None else F.lit(rows)

    named = of_class(df, of, label)
    marked = mark_first(named, label, key, group_cuts(named, label, key, quota))
    kept = marked.filter(~F.col("chosen")).select(*df.columns)
    return df.filter(~F.col(label).eqNullSafe(of)).unionByName(kept)


def split_random(df: DataFrame, seed: int = SEED) -> dict[str, DataFrame]:
    """80/10/10 by Spark's random split. The result depends on the partitioning, so
    the rows are written first: every part then draws from the same partitions."""
    train, rest = stored(df, "to-split").randomSplit([0.8, 0.2], seed)
    val, test = rest.randomSplit([0.5, 0.5], seed)
    return {"train": train, "val": val, "test": test}


def split_name(key: str) -> Column:
    """80/10/10 from the hash of the key: the same rows on every run and cluster."""
    hundredth = F.conv(F.substring(hash_order(key), 1, 8), 16, 10).cast("bigint") % 100
    out = F.when(hundredth < SPLITS[0][1], SPLITS[0][0])
    return out.when(hundredth < SPLITS[1][1], SPLITS[1][0]).otherwise(SPLITS[2][0])


def split_hash(df: DataFrame, key: str) -> DataFrame:
    """Add ``split``."""
    return df.withColumn("split", split_name(key))


def balanced_splits(
    df: DataFrame, key: str, label: str = "label", leaky: bool = False, split_key: str | None = None
) -> DataFrame:
    """Split, with balanced training rows.

    By default only the training rows are balanced, after the split. ``leaky``
    balances first, which puts copies of one review on both sides of the split.
    ``split_key`` may be shared by rows that have to stay together.
    """
    if leaky:
        balanced = balance_exact(df, key, label)
        copy_key = F.concat_ws("#", F.col(key).cast("string"), F.col("copy").cast("string"))
        return split_hash(balanced.withColumn("_copy_key", copy_key), "_copy_key").drop("_copy_key")
    parts = split_hash(df, split_key or key)
    train = balance_exact(parts.filter(F.col("split") == "train"), key, label)
    return train.unionByName(parts.filter(F.col("split") != "train").withColumn("copy", F.lit(1).cast("bigint")))
