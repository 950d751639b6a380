"""Review and prediction tables derived from the given tables.

Only the joins that the wanted columns need are made: a report that reads no
rating neither touches ``labels`` nor shuffles the texts.
"""

from __future__ import annotations

import json
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opinara.functions.ratings import sentiment_code, sentiment_text

DAY = 86400
FIRST_DAY = 1356998400
REVIEWERS = 150


@cache
def _schema(sf_dir: str, name: str) -> str:
    """The declared schema of a table, read from its files once."""
    return SparkSession.active().read.parquet(f"{sf_dir}/{name}.parquet").schema.json()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = StructType.fromJson(json.loads(_schema(sf_dir, name)))
    return spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")


def _unix_time(doc_id: Column) -> Column:
    return F.lit(FIRST_DAY).cast("bigint") + (doc_id % 730) * DAY


def _after(start: str, seconds: Column) -> Column:
    """A time without zone, so the session's zone cannot change it."""
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    return F.expr(f"timestamp_ntz'{start}'") + step


def _prediction_columns() -> dict[str, Column]:
    doc_id, text = F.col("doc_id"), F.col("text")
    quality, toxic = F.col("quality"), F.col("toxic")
    stars = (
        F.when(quality == 0, 1 + doc_id % 2)
        .when(toxic == 1, 3)
        .when(quality == 1, 4 + doc_id % 2)
        .otherwise(1 + doc_id % 5)
    )
    label = (
        F.when(doc_id % 41 == 0, "unknown")
        .when(doc_id % 3 == 0, "negative")
        .when(doc_id % 7 == 0, "neutral")
        .otherwise("positive")
    )
    helpful_votes = (doc_id % 5).cast("int")
    total_votes = (doc_id % 5 + doc_id % 4).cast("int")
    return {
        "doc_id": doc_id,
        "asin": F.concat(F.lit("B"), F.lpad(((doc_id * 7) % 53).cast("string"), 8, "0")),
        "helpful_votes": helpful_votes,
        "total_votes": total_votes,
        "helpful": F.array(helpful_votes, total_votes),
        "overall": stars.cast("float"),
        "reviewText": F.when(doc_id % 50 == 49, None).when(doc_id % 50 == 48, "").otherwise(text),
        "reviewTime": F.date_format(_after("1970-01-01 00:00:00", _unix_time(doc_id)), "MM dd, yyyy"),
        "reviewerID": F.concat(F.lit("R"), ((doc_id * 13) % REVIEWERS).cast("string")),
        "reviewerName": F.col("c_name"),
        "summary": F.concat_ws(" ", F.col("source"), F.col("lang")),
        "unixReviewTime": _unix_time(doc_id),
        "processed_ts": _after("2024-01-01 00:00:00", doc_id * 37),
        "label": label,
        "confidence": F.lit(0.34) + (doc_id % 66) / F.lit(100.0),
        "is_realtime": doc_id % 10 != 9,
    }


REVIEW_COLUMNS = [
    "doc_id",
    "asin",
    "helpful_votes",
    "total_votes",
    "overall",
    "reviewText",
    "reviewTime",
    "reviewerID",
    "reviewerName",
    "summary",
    "unixReviewTime",
]


def predictions(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The stored predictions; with ``columns``, only those."""
    made = _prediction_columns()
    wanted = list(columns) or [c for c in made if c != "helpful"]
    docs = table(spark, sf_dir, "documents")
    if "overall" in wanted:
        docs = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    if "reviewerName" in wanted:
        # One row per customer key below the bound, so at most REVIEWERS rows.
        names = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
        names = names.filter(F.col("c_custkey").between(0, REVIEWERS - 1))
        docs = docs.join(F.broadcast(names), F.col("c_custkey") == (F.col("doc_id") * 13) % REVIEWERS, "left")
    return docs.select(*[made[c].alias(c) for c in wanted])


def reviews(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The reviews before scoring; ``sentiment`` and ``label`` follow from the rating."""
    wanted = list(columns) or [*REVIEW_COLUMNS, "sentiment"]
    derived = {"sentiment", "label"} & set(wanted)
    base = [c for c in wanted if c not in derived]
    out = predictions(spark, sf_dir, *dict.fromkeys([*base, *(["overall"] if derived else [])]))
    code = sentiment_code(F.col("overall"))
    made = {"sentiment": code.alias("sentiment"), "label": sentiment_text(code).alias("label")}
    return out.select(*[made.get(c, F.col(c)) for c in wanted])


def event_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_event_predictions(table(spark, sf_dir, "events"))


def as_event_predictions(events: DataFrame) -> DataFrame:
    """Events seen as predictions; works on a stream as well."""
    kind = F.col("event_type")
    label = (
        F.when(kind.isin("purchase", "view"), "positive")
        .when(kind == "click", "neutral")
        .when(kind == "error", "negative")
        .otherwise("unknown")
    )
    return events.select(
        "event_id",
        F.col("ts").alias("processed_ts"),
        "user_id",
        label.alias("label"),
        (F.col("value") / (1 + F.col("value"))).alias("confidence"),
        F.lit(True).alias("is_realtime"),
    )


PREDICTIONS_SQL = """
  select d.doc_id,
    concat('B', lpad(cast((d.doc_id * 7) % 53 as varchar), 8, '0')) as asin,
    cast(d.doc_id % 5 as int) as helpful_votes,
    cast(d.doc_id % 5 + d.doc_id % 4 as int) as total_votes,
    cast(case when l.quality = 0 then 1 + d.doc_id % 2 when l.toxic = 1 then 3
              when l.quality = 1 then 4 + d.doc_id % 2 else 1 + d.doc_id % 5 end as float) as overall,
    case when d.doc_id % 50 = 49 then null when d.doc_id % 50 = 48 then '' else d.text end as "reviewText",
    strftime(make_timestamp((1356998400 + (d.doc_id % 730) * 86400) * 1000000), '%m %d, %Y') as "reviewTime",
    concat('R', cast((d.doc_id * 13) % 150 as varchar)) as "reviewerID",
    c.c_name as "reviewerName",
    concat_ws(' ', d.source, d.lang) as summary,
    1356998400 + (d.doc_id % 730) * 86400 as "unixReviewTime",
    timestamp '2024-01-01 00:00:00' + to_seconds(d.doc_id * 37) as processed_ts,
    case when d.doc_id % 41 = 0 then 'unknown' when d.doc_id % 3 = 0 then 'negative'
         when d.doc_id % 7 = 0 then 'neutral' else 'positive' end as label,
    0.34::double + (d.doc_id % 66) / 100.0::double as confidence,
    d.doc_id % 10 <> 9 as is_realtime
  from documents d left join labels l on d.doc_id = l.doc_id
  left join customer c on c.c_custkey = (d.doc_id * 13) % 150
"""

REVIEWS_SQL = """
  select * exclude (processed_ts, label, confidence, is_realtime),
    case when overall < 3 then 0 when overall = 3 then 1 else 2 end as sentiment,
    case when overall < 3 then 'negative' when overall = 3 then 'neutral' else 'positive' end as label
  from predictions
"""

EVENT_PREDICTIONS_SQL = """
  select event_id, ts as processed_ts, user_id,
    case event_type when 'purchase' then 'positive' when 'view' then 'positive' when 'click' then 'neutral'
         when 'error' then 'negative' else 'unknown' end as label,
    value / (1 + value) as confidence, true as is_realtime
  from events
"""


def sql(body: str, **views: str) -> str:
    """A query with the fixture tables, and further named views, in front."""
    named = {
        "predictions": PREDICTIONS_SQL,
        "reviews": REVIEWS_SQL,
        "event_predictions": EVENT_PREDICTIONS_SQL,
        **views,
    }
    return "with " + ",\n".join(f"{name} as ({text})" for name, text in named.items()) + "\n" + body.strip()
