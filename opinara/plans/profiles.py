"""Profiles of the review table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions.ratings import helpfulness_ratio
from opinara.functions.text import review_length
from opinara.operators import profile
from opinara.operators.filters import with_text
from opinara.operators.projections import with_cleaned
from opinara.operators.sampling import balance_exact
from opinara.plans.fixtures import REVIEW_COLUMNS, predictions, reviews, sql
from opinara.session import stored
from opinara.plans.registry import Registry
from opinara.plans.scalars import RATIO_SQL, WHITE_SQL
from opinara.plans.storage import CLEAN_SQL

QUERIES = Registry()

RATIO_BINS = 20
LENGTH_BINS = 30
WORDS_SQL = (
    f"""coalesce(len(list_filter(string_split_regex("reviewText", '[{WHITE_SQL}]+'), lambda t: t <> '')), 0)::double"""
)

# Column types of the review table, in its order.
REVIEW_TYPES = {
    "doc_id": "bigint",
    "asin": "string",
    "helpful_votes": "int",
    "total_votes": "int",
    "overall": "float",
    "reviewText": "string",
    "reviewTime": "string",
    "reviewerID": "string",
    "reviewerName": "string",
    "summary": "string",
    "unixReviewTime": "bigint",
}


def _ratio(spark, sf_dir, *columns: str) -> DataFrame:
    df = predictions(spark, sf_dir, "helpful_votes", "total_votes", *columns)
    return df.withColumn("ratio", helpfulness_ratio(F.col("helpful_votes"), F.col("total_votes")))


def _length(spark, sf_dir, *columns: str) -> DataFrame:
    df = predictions(spark, sf_dir, "reviewText", *columns)
    return df.withColumn("words", review_length(F.col("reviewText")))


@QUERIES.add("shape", sql("select count(*) as n_rows, 11::int as n_columns from reviews"))
def shape(spark, sf_dir):
    return profile.shape(reviews(spark, sf_dir, *REVIEW_COLUMNS))


@QUERIES.add(
    "column_types",
    sql(
        " union all ".join(
            f"""select {i}::int as position, '{c}' as "column", '{t}' as type, count("{c}") as filled from reviews"""
            for i, (c, t) in enumerate(REVIEW_TYPES.items())
        )
    ),
)
def column_types(spark, sf_dir):
    return profile.column_types(reviews(spark, sf_dir, *REVIEW_COLUMNS))


@QUERIES.add(
    "null_counts",
    sql(
        " union all ".join(
            f"""select '{c}' as "column", count(*) - count("{c}") as nulls from reviews""" for c in REVIEW_COLUMNS
        )
    ),
)
def null_counts(spark, sf_dir):
    return profile.null_counts(reviews(spark, sf_dir, *REVIEW_COLUMNS))


NUMERIC = ["helpful_votes", "total_votes", "overall", "unixReviewTime", "confidence"]


@QUERIES.add(
    "describe_numeric",
    sql(
        " union all ".join(
            f"""select '{c}' as "column", count("{c}") as "count", round(avg("{c}"::double), 6) as mean,
            round(stddev_samp("{c}"::double), 4) as std, min("{c}"::double) as "min",
            round(quantile_cont("{c}"::double, 0.25), 6) as p25, round(quantile_cont("{c}"::double, 0.5), 6) as p50,
            round(quantile_cont("{c}"::double, 0.75), 6) as p75, max("{c}"::double) as "max" from predictions"""
            for c in NUMERIC
        )
    ),
)
def describe_numeric(spark, sf_dir):
    out = profile.describe_numeric(predictions(spark, sf_dir, *NUMERIC), NUMERIC)
    places = {"mean": 6, "std": 4, "p25": 6, "p50": 6, "p75": 6}
    return out.withColumns({c: F.round(c, p) for c, p in places.items()})


def _balanced_sql(where: str = "true") -> dict[str, str]:
    return {
        "base": f'select doc_id, {CLEAN_SQL} as cleaned_reviews, label from reviews where "reviewText" is not null and {where}',
        "sized": """select *, row_number() over (partition by label order by md5(cast(doc_id as varchar)), doc_id) as place,
          count(*) over (partition by label) as n from base""",
        "counted": "select *, (select max(n) from sized) as largest from sized",
        "balanced": """select doc_id, cleaned_reviews, label,
          unnest(range(1, largest // n + case when place <= largest % n then 2 else 1 end)) as copy from counted""",
    }


def balanced(spark, sf_dir) -> DataFrame:
    df = with_cleaned(with_text(reviews(spark, sf_dir, "doc_id", "reviewText", "label")))
    return balance_exact(df.select("doc_id", "cleaned_reviews", "label"), "doc_id")


@QUERIES.add(
    "describe_text",
    sql(
        """
select 'count' as summary, count(cleaned_reviews)::varchar as cleaned_reviews, count(label)::varchar as label from balanced
union all select 'mean', null, null
union all select 'stddev', null, null
union all select 'min', min(cleaned_reviews), min(label) from balanced
union all select 'max', max(cleaned_reviews), max(label) from balanced
""",
        **_balanced_sql(),
    ),
)
def describe_text(spark, sf_dir):
    return profile.describe_text(balanced(spark, sf_dir), ["cleaned_reviews", "label"])


NAMES = ["reviewerID", "asin", "reviewerName", "summary"]


@QUERIES.add(
    "distinct_counts",
    sql(" union all ".join(f"""select '{c}' as "column", count(distinct "{c}") as "distinct" from reviews""" for c in NAMES)),
)
def distinct_counts(spark, sf_dir):
    return profile.distinct_counts(reviews(spark, sf_dir, *NAMES), NAMES)


@QUERIES.add(
    "distinct_sketched",
    sql(" union all ".join(f"""select '{c}' as "column", count(distinct "{c}") as exact, true as near from reviews""" for c in NAMES)),
)
def distinct_sketched(spark, sf_dir):
    """Estimates from sketches that were stored day by day and merged, against the exact counts."""
    rows = reviews(spark, sf_dir, *dict.fromkeys(["reviewTime", *NAMES]))
    days = stored(profile.distinct_sketches(rows, NAMES, "reviewTime"), "distinct-sketches")
    both = profile.distinct_counts(rows, NAMES).join(profile.merged_distinct(days).withColumnRenamed("distinct", "guess"), "column")
    near = F.abs(F.col("guess") - F.col("distinct")) <= F.col("distinct") * profile.SKETCH_ERROR
    return both.select("column", F.col("distinct").alias("exact"), near.alias("near"))


@QUERIES.add("rating_counts", sql("select overall, count(*) as n from reviews where overall is not null group by overall"))
def rating_counts(spark, sf_dir):
    return profile.rating_counts(reviews(spark, sf_dir, "overall"))


@QUERIES.add("avg_rating", sql("select round(avg(overall::double), 2) as avg_rating from reviews"))
def avg_rating(spark, sf_dir):
    return profile.avg_rating(reviews(spark, sf_dir, "overall"))


@QUERIES.add("class_counts", sql("select label, count(*) as n from reviews group by label"))
def class_counts(spark, sf_dir):
    return profile.class_counts(reviews(spark, sf_dir, "label"))


def _binned_sql(value: str, bins: int) -> dict[str, str]:
    """Views for the value range and for each row's bin."""
    step = f"((high - low) / {bins})"
    return {
        "valued": f"select {value} as value, overall from reviews",
        "ends": """select case when lo = hi then lo - 0.5 else lo end as low, case when lo = hi then hi + 0.5 else hi end as high
          from (select min(value) as lo, max(value) as hi from valued)""",
        "guessed": f"""select value, overall, low, high,
          least(floor((value - low) / (high - low) * {bins}), {bins - 1}) as g from valued, ends""",
        "binned": f"""select overall, cast(case when value < g * {step} + low then g - 1
          when g < {bins - 1} and value >= (g + 1) * {step} + low then g + 1 else g end as int) as bin from guessed""",
    }


def _histogram_sql(value: str, bins: int) -> str:
    return sql(
        f"""
select b.bin::int as bin, round(b.bin * ((high - low) / {bins}) + low, 9) as "left",
  round(case when b.bin = {bins - 1} then high else (b.bin + 1) * ((high - low) / {bins}) + low end, 9) as "right",
  coalesce(n, 0)::bigint as n
from range(0, {bins}) b(bin) cross join ends left join (select bin, count(*) as n from binned group by bin) c on c.bin = b.bin
""",
        **_binned_sql(value, bins),
    )


def _edges_rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in ("left", "right")})


@QUERIES.add("hist_helpful", _histogram_sql(RATIO_SQL, RATIO_BINS))
def hist_helpful(spark, sf_dir):
    return _edges_rounded(profile.histogram(_ratio(spark, sf_dir), F.col("ratio"), RATIO_BINS))


@QUERIES.add("hist_length", _histogram_sql(WORDS_SQL, LENGTH_BINS))
def hist_length(spark, sf_dir):
    return _edges_rounded(profile.histogram(_length(spark, sf_dir), F.col("words"), LENGTH_BINS))


def _density_sql(value: str) -> str:
    return sql(
        f"""
select p.point::int as point, round(low + p.point * ((high - low) / {profile.GRID - 1}), 6) as x,
  round(sum(n * exp(-0.5 * pow((low + p.point * ((high - low) / {profile.GRID - 1}) - value) / width, 2)))
    / (any_value(total) * any_value(width) * sqrt(2 * pi())), 6) as density
from range(0, {profile.GRID}) p(point) cross join shape cross join counts
group by p.point, low, high
""",
        valued=f"select {value} as value from reviews",
        shape="""select min(value) as low, max(value) as high, count(*) as total,
          stddev_samp(value) * pow(count(*), -0.2) as width from valued""",
        counts="select value, count(*) as n from valued group by value",
    )


def _density_rounded(df: DataFrame) -> DataFrame:
    return df.select("point", F.round("x", 6).alias("x"), F.round("density", 6).alias("density"))


@QUERIES.add("kde_helpful", _density_sql(RATIO_SQL))
def kde_helpful(spark, sf_dir):
    return _density_rounded(profile.density(_ratio(spark, sf_dir), F.col("ratio")))


@QUERIES.add("kde_length", _density_sql(WORDS_SQL))
def kde_length(spark, sf_dir):
    return _density_rounded(profile.density(_length(spark, sf_dir), F.col("words")))


@QUERIES.add(
    "scatter_helpful",
    sql("select bin, overall, count(*) as n from binned group by bin, overall", **_binned_sql(RATIO_SQL, RATIO_BINS)),
)
def scatter_helpful(spark, sf_dir):
    return profile.binned_scatter(_ratio(spark, sf_dir, "overall"), F.col("ratio"), "overall", RATIO_BINS)


@QUERIES.add(
    "scatter_length",
    sql("select bin, overall, count(*) as n from binned group by bin, overall", **_binned_sql(WORDS_SQL, LENGTH_BINS)),
)
def scatter_length(spark, sf_dir):
    return profile.binned_scatter(_length(spark, sf_dir, "overall"), F.col("words"), "overall", LENGTH_BINS)
