"""Balancing, sampling and splitting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.operators import sampling
from opinara.plans.fixtures import reviews, sql
from opinara.plans.profiles import _balanced_sql, balanced
from opinara.plans.registry import Registry
from opinara.plans.storage import SPLIT_SQL

QUERIES = Registry()

PLACE_SQL = "row_number() over (partition by label order by md5(cast(doc_id as varchar)), doc_id)"
DROPPED_SHARE = 0.25


def _labelled(spark, sf_dir) -> DataFrame:
    return reviews(spark, sf_dir, "doc_id", "label")


@QUERIES.add("union_classes", sql("select doc_id, label from reviews"))
def union_classes(spark, sf_dir):
    return sampling.union_classes(_labelled(spark, sf_dir))


@QUERIES.add("balance_exact", sql("select doc_id, cleaned_reviews, label, copy from balanced", **_balanced_sql()))
def balance_exact(spark, sf_dir):
    return balanced(spark, sf_dir)


@QUERIES.add(
    "balance_sampled",
    sql("""
select label, count(*) as originals, count(*) as known_keys, true as within_bounds, true as copies_told_apart
from reviews group by label
"""),
)
def balance_sampled(spark, sf_dir):
    """What holds for any draw: keys of the class only, never more rows than the largest class has and not far fewer."""
    df = _labelled(spark, sf_dir)
    drawn = sampling.balance_sampled(df, "doc_id")
    found = drawn.groupBy("label").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("doc_id", "copy").alias("apart"), F.count_distinct("doc_id").alias("keys")
    )
    known = df.select("label", "doc_id").join(drawn.select("label", "doc_id").distinct(), ["label", "doc_id"], "left_semi")
    known = known.groupBy("label").agg(F.count(F.lit(1)).alias("drawn_keys"))
    sizes = df.groupBy("label").agg(F.count(F.lit(1)).alias("originals"))
    largest = sizes.agg(F.max("originals")).scalar()
    out = sizes.withColumn("largest", largest).join(found, "label").join(known, "label")
    # A draw of n rows has a spread of about the root of n; ten times that never comes by chance.
    close = F.col("rows") >= F.col("largest") - 10 * F.sqrt("largest")
    return out.select(
        "label",
        "originals",
        F.when(F.col("drawn_keys") == F.col("keys"), F.col("originals")).alias("known_keys"),
        ((F.col("rows") <= F.col("largest")) & close).alias("within_bounds"),
        (F.col("apart") == F.col("rows")).alias("copies_told_apart"),
    )


@QUERIES.add(
    "balance_hashed",
    sql(
        """
select label, doc_id, copy from (
  select *, row_number() over (partition by label order by md5(doc_id || '#' || copy), doc_id || '#' || copy) as place
  from drawn) where place <= (select max(n) from sizes)
union all select label, doc_id, 1 as copy from reviews join sizes using (label) where n = (select max(n) from sizes)
""",
        sizes="select label, count(*) as n from reviews group by label",
        rates="""select label, (select max(n) from sizes) / n::double as rate, ceil((select max(n) from sizes) / n::double / 8) as parts
          from sizes where n < (select max(n) from sizes)""",
        steps="""with recursive walk as (
            select label, 0 as k, exp(-rate / parts) as p, exp(-rate / parts) as upto, rate / parts as mean from rates
            union all select label, k + 1, p * mean / (k + 1), upto + p * mean / (k + 1), mean from walk where k < 50)
          select label, upto from walk""",
        hashed="""select label, doc_id, part, ('0x' || substr(md5('42:' || doc_id || ':' || part), 1, 13))::bigint / 4503599627370496::double as u
          from (select label, doc_id, unnest(range(1, parts::bigint + 1)) as part from reviews join rates using (label))""",
        copies="select label, doc_id, part, count(*) as n from hashed join steps using (label) where upto <= u group by all",
        drawn="select label, doc_id, (part - 1) * 51 + unnest(range(1, n + 1)) as copy from copies",
    ),
)
def balance_hashed(spark, sf_dir):
    return sampling.balance_hashed(_labelled(spark, sf_dir), "doc_id").select("label", "doc_id", "copy")


@QUERIES.add(
    "limit_class",
    sql(f"""
select doc_id, label from (
  select doc_id, label, {PLACE_SQL} as place, count(*) over (partition by label) as n from reviews)
where place <= (select max(c) from (select count(*) as c from reviews group by label)) // 2
"""),
)
def limit_class(spark, sf_dir):
    """No class keeps more rows than half the largest has."""
    return sampling.limit_class(_labelled(spark, sf_dir), lambda n, largest: F.floor(largest / 2), "doc_id")


@QUERIES.add(
    "downsample",
    sql(f"""
select doc_id, label from (
  select doc_id, label, {PLACE_SQL} as place, count(*) over (partition by label) as n from reviews)
where label <> 'positive' or place > floor(n * {DROPPED_SHARE}::double)
"""),
)
def downsample(spark, sf_dir):
    return sampling.downsample(_labelled(spark, sf_dir), "positive", "doc_id", share=DROPPED_SHARE)


@QUERIES.add(
    "split_random",
    sql("""
select count(*) as n, count(distinct doc_id) as keys, true as train_share, true as val_share, true as test_share from reviews
"""),
)
def split_random(spark, sf_dir):
    """What holds for any split: every row once, and shares within ten times their spread."""
    parts = sampling.split_random(_labelled(spark, sf_dir))
    rows = reduce(DataFrame.unionByName, [part.select("doc_id", F.lit(name).alias("split")) for name, part in parts.items()])

    def near(name: str, share: float):
        found, total = F.count_if(F.col("split") == name), F.count(F.lit(1))
        return (F.abs(found - share * total) <= 10 * F.sqrt(total * share * (1 - share))).alias(f"{name}_share")

    shares = [near("train", 0.8), near("val", 0.1), near("test", 0.1)]
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("keys"), *shares)


@QUERIES.add("split_hash", sql(f"select doc_id, label, {SPLIT_SQL} as split from reviews"))
def split_hash(spark, sf_dir):
    return sampling.split_hash(_labelled(spark, sf_dir), "doc_id")


@QUERIES.add(
    "balanced_splits",
    sql(
        f"""
select doc_id, label, copy, 'train' as split from balanced
union all select doc_id, label, 1 as copy, {SPLIT_SQL} as split from reviews
where "reviewText" is not null and {SPLIT_SQL} <> 'train'
""",
        **_balanced_sql(f"{SPLIT_SQL} = 'train'"),
    ),
)
def balanced_splits(spark, sf_dir):
    df = reviews(spark, sf_dir, "doc_id", "reviewText", "label").filter(F.col("reviewText").isNotNull())
    return sampling.balanced_splits(df.select("doc_id", "label"), "doc_id")
