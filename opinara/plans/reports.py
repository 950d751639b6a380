"""Report panels over the predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.operators import panels
from opinara.operators.filters import recent
from opinara.operators.projections import snippets
from opinara.plans.fixtures import predictions, sql, table
from opinara.plans.registry import Registry
from opinara.plans.scalars import BIN_NO_SQL, CARD_COLUMNS, CARD_SQL, LENGTH_BIN_SQL

QUERIES = Registry()

COUNTS_SQL = """count(*) filter (where label = 'positive') as positive,
  count(*) filter (where label = 'neutral') as neutral, count(*) filter (where label = 'negative') as negative"""
KNOWN_SQL = "label in ('positive', 'neutral', 'negative')"
RECENT_SQL = "is_realtime and processed_ts >= (select max(processed_ts) from predictions) - interval"


def latest(df: DataFrame):
    """The newest processing time, standing in for the clock."""
    return df.agg(F.max("processed_ts")).scalar()


def _rounded(df: DataFrame) -> DataFrame:
    """Averages at six decimals: engines add in different orders."""
    return df.withColumns({c: F.round(c, 6) for c in df.columns if c.startswith("avg_")})


def _realtime(spark, sf_dir, interval: str, *columns: str) -> DataFrame:
    df = predictions(spark, sf_dir, *dict.fromkeys([*columns, "processed_ts", "is_realtime"]))
    return recent(df, latest(predictions(spark, sf_dir, "processed_ts")), interval)


@QUERIES.add(
    "recent_filter",
    sql(f"select doc_id, processed_ts, label from predictions where {RECENT_SQL} 5 minutes"),
)
def recent_filter(spark, sf_dir):
    return _realtime(spark, sf_dir, "5 MINUTES", "doc_id", "label").drop("is_realtime")


@QUERIES.add(
    "kpi_totals",
    sql(f"""
select count(*) as total_reviews, {COUNTS_SQL},
  round(coalesce(sum(coalesce(confidence, 0)) / nullif(count(*), 0), 0), 6) as avg_confidence,
  round(coalesce(sum(coalesce(overall, 0)::double) / nullif(count(*), 0), 0), 6) as avg_rating from predictions
"""),
)
def kpi_totals(spark, sf_dir):
    return _rounded(panels.headline(predictions(spark, sf_dir, "label", "confidence", "overall")))


@QUERIES.add(
    "kpi_recent",
    sql(f"""
select count(*) as total_reviews, {COUNTS_SQL},
  round(coalesce(sum(coalesce(confidence, 0)) / nullif(count(*), 0), 0), 6) as avg_confidence
from predictions where {RECENT_SQL} 5 minutes
"""),
)
def kpi_recent(spark, sf_dir):
    return _rounded(panels.headline(_realtime(spark, sf_dir, "5 MINUTES", "label", "confidence"), rating=False))


@QUERIES.add(
    "sentiment_by_minute",
    sql(f"""
select date_trunc('minute', processed_ts)::timestamp as minute, strftime(date_trunc('minute', processed_ts), '%H:%M') as minute_label,
  {COUNTS_SQL} from predictions where {RECENT_SQL} 1 hour group by 1, 2
"""),
)
def sentiment_by_minute(spark, sf_dir):
    return panels.by_minute(_realtime(spark, sf_dir, "1 HOUR", "label"))


@QUERIES.add(
    "sentiment_by_day",
    sql(f"""
select "reviewTime", {COUNTS_SQL} from predictions where {KNOWN_SQL} and "reviewTime" <> '' group by 1
"""),
)
def sentiment_by_day(spark, sf_dir):
    return panels.by_key(predictions(spark, sf_dir, "label", "reviewTime"), "reviewTime")


@QUERIES.add(
    "sentiment_by_rating",
    sql(f"""
select coalesce(cast(overall as varchar), 'N/A') as rating, {COUNTS_SQL} from predictions where {KNOWN_SQL} group by 1
"""),
)
def sentiment_by_rating(spark, sf_dir):
    return panels.by_rating(predictions(spark, sf_dir, "label", "overall"))


def _top_sql(key: str) -> str:
    return sql(f"""
select "{key}", {COUNTS_SQL}, count(*) as total, max(processed_ts) as newest from predictions
where {KNOWN_SQL} and "{key}" <> '' group by 1 order by total desc, newest desc, 1 limit 10
""")


@QUERIES.add("sentiment_by_product", _top_sql("asin"))
def sentiment_by_product(spark, sf_dir):
    return panels.top_by_key(predictions(spark, sf_dir, "label", "asin", "processed_ts"), "asin")


@QUERIES.add("sentiment_by_reviewer", _top_sql("reviewerName"))
def sentiment_by_reviewer(spark, sf_dir):
    return panels.top_by_key(predictions(spark, sf_dir, "label", "reviewerName", "processed_ts"), "reviewerName")


@QUERIES.add(
    "sentiment_by_customer",
    sql(
        f"""
select customer, {COUNTS_SQL}, count(*) as total, max(processed_ts) as newest from by_order
where {KNOWN_SQL} and customer <> '' group by 1 order by total desc, newest desc, 1 limit 10
""",
        by_order="""select 'C' || o_custkey as customer, o_orderdate::timestamp as processed_ts, case substr(o_orderpriority, 1, 1)
          when '1' then 'negative' when '2' then 'negative' when '3' then 'neutral' when '5' then 'unknown'
          else 'positive' end as label from orders""",
    ),
)
def sentiment_by_customer(spark, sf_dir):
    """The same over orders seen as reviews, whose number of keys grows with the table."""
    rank = F.substring("o_orderpriority", 1, 1)
    label = F.when(rank.isin("1", "2"), "negative").when(rank == "3", "neutral").when(rank == "5", "unknown").otherwise("positive")
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("processed_ts"),
        label.alias("label"),
    )
    return panels.top_by_key(rows, "customer")


@QUERIES.add("top_products", sql(f"""
select asin, total from (select asin, count(*) as total, max(processed_ts) as newest from predictions
where {KNOWN_SQL} and asin <> '' group by 1 order by total desc, newest desc, asin limit 10)
"""))
def top_products(spark, sf_dir):
    return sentiment_by_product(spark, sf_dir).select("asin", "total")


@QUERIES.add("top_reviewers", sql(f"""
select "reviewerName", total from (select "reviewerName", count(*) as total, max(processed_ts) as newest from predictions
where {KNOWN_SQL} and "reviewerName" <> '' group by 1 order by total desc, newest desc, 1 limit 10)
"""))
def top_reviewers(spark, sf_dir):
    return sentiment_by_reviewer(spark, sf_dir).select("reviewerName", "total")


@QUERIES.add(
    "sentiment_by_length",
    sql(f"""
select {LENGTH_BIN_SQL} as length_bin, {BIN_NO_SQL} as bin_no, {COUNTS_SQL}
from predictions where {KNOWN_SQL} and "reviewText" <> '' group by 1, 2
"""),
)
def sentiment_by_length(spark, sf_dir):
    return panels.by_length(predictions(spark, sf_dir, "label", "reviewText"))


@QUERIES.add(
    "ordered_panels",
    sql(f"""
select 'day' as panel, 0.0::double as sort_no, "reviewTime" as key, {COUNTS_SQL}
from predictions where {KNOWN_SQL} and "reviewTime" <> '' group by 3
union all select 'length', 0.0::double, {LENGTH_BIN_SQL}, {COUNTS_SQL}
from predictions where {KNOWN_SQL} and "reviewText" <> '' group by 3
union all select 'rating', coalesce(overall, -1)::double, coalesce(cast(overall as varchar), 'N/A'), {COUNTS_SQL}
from predictions where {KNOWN_SQL} group by 2, 3
order by 1, 2, 3
"""),
)
def ordered_panels(spark, sf_dir):
    """The key-ordered panels from one scan: ratings by number, the others as text."""
    df = predictions(spark, sf_dir, "label", "processed_ts", "reviewTime", "overall", "asin", "reviewerName", "reviewText")
    shown = panels.all_panels(df).filter(F.col("panel").isin("day", "length", "rating"))
    number = F.when(F.col("panel") == "rating", F.coalesce(F.col("key").try_cast("double"), F.lit(-1.0))).otherwise(0.0)
    shown = shown.select("panel", number.alias("sort_no"), "key", "positive", "neutral", "negative")
    return shown.orderBy("panel", "sort_no", "key")


@QUERIES.add(
    "offline_panels",
    sql(f"""
select * exclude (kept) from (
  select 'day' as panel, "reviewTime" as key, {COUNTS_SQL}, count(*) as total, max(processed_ts) as newest, 0 as rank,
    true as kept from predictions where {KNOWN_SQL} and "reviewTime" <> '' group by 2
  union all select 'length', {LENGTH_BIN_SQL}, {COUNTS_SQL}, count(*), max(processed_ts), 0, true
  from predictions where {KNOWN_SQL} and "reviewText" <> '' group by 2
  union all select 'rating', coalesce(cast(overall as varchar), 'N/A'), {COUNTS_SQL}, count(*), max(processed_ts), 0, true
  from predictions where {KNOWN_SQL} group by 2
  union all select 'product', asin, {COUNTS_SQL}, count(*), max(processed_ts),
    row_number() over (order by count(*) desc, max(processed_ts) desc, asin),
    row_number() over (order by count(*) desc, max(processed_ts) desc, asin) <= 10
  from predictions where {KNOWN_SQL} and asin <> '' group by 2
  union all select 'reviewer', "reviewerName", {COUNTS_SQL}, count(*), max(processed_ts),
    row_number() over (order by count(*) desc, max(processed_ts) desc, "reviewerName"),
    row_number() over (order by count(*) desc, max(processed_ts) desc, "reviewerName") <= 10
  from predictions where {KNOWN_SQL} and "reviewerName" <> '' group by 2)
where kept
"""),
)
def offline_panels(spark, sf_dir):
    """All keyed panels of the offline report from one scan."""
    df = predictions(spark, sf_dir, "label", "processed_ts", "reviewTime", "overall", "asin", "reviewerName", "reviewText")
    return panels.all_panels(df).withColumn("rank", F.coalesce("rank", F.lit(0)).cast("bigint"))


@QUERIES.add("stats_overview", sql("""
select label, count(*) as n, (select count(*) from predictions) as total_count from predictions group by label
"""))
def stats_overview(spark, sf_dir):
    return panels.label_totals(predictions(spark, sf_dir, "label"))


@QUERIES.add("newest", sql("select doc_id, processed_ts, label from predictions order by processed_ts desc, doc_id"))
def newest(spark, sf_dir):
    """The whole table, newest first: sorted by ranges, so no task holds all of it."""
    return panels.newest_first(predictions(spark, sf_dir, "doc_id", "processed_ts", "label"), "doc_id")


@QUERIES.add(
    "recent_reviews",
    sql(f"select {CARD_SQL} from (select * from predictions order by processed_ts desc, doc_id limit 10)"),
)
def recent_reviews(spark, sf_dir):
    return _cards(predictions(spark, sf_dir, "doc_id", *CARD_COLUMNS))


@QUERIES.add(
    "recent_realtime",
    sql(f"""
select {CARD_SQL} from (
  select * from predictions where {RECENT_SQL} 5 minutes order by processed_ts desc, doc_id limit 10)
"""),
)
def recent_realtime(spark, sf_dir):
    return _cards(_realtime(spark, sf_dir, "5 MINUTES", "doc_id", *CARD_COLUMNS))


def _cards(df: DataFrame) -> DataFrame:
    return panels.recent_cards(df, "doc_id").withColumn("rating", F.col("rating").cast("float"))
