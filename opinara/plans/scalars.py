"""Scalar functions, filters and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.functions import display, ratings, text
from opinara.functions.records import default_fields, typed
from opinara.operators import filters, projections
from opinara.operators.lemma import NOUN_EXCEPTIONS, NOUN_RULES, by_rule, fold_lemmas, noun_lemmas
from opinara.operators.filters import known_labels
from opinara.plans.fixtures import event_predictions, predictions, reviews, sql
from opinara.plans.registry import Registry, sql_list
from opinara.plans.storage import CLEAN_SQL
from opinara.schema import CLASSES_FR
from opinara.session import stored

QUERIES = Registry()

TOKENS_SQL = r"""list_filter(string_split_regex(lower("reviewText"), '[\s\x0B]+'), lambda t: t <> '')"""
# Python's white space, one by one.
WHITE_SQL = (
    r"\s\x0B\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def _serve_tokens_sql() -> str:
    out = rf"""regexp_replace(lower("reviewText"), '[^a-zA-Z{WHITE_SQL}]', '', 'g')"""
    for first, second in text.SPLIT_WORDS:
        out = rf"""regexp_replace({out}, '\b({first})({second})\b', '\1 \2', 'g')"""
    stop = sql_list(text.SERVING_STOP_WORDS)
    return f"list_filter(string_split_regex({out}, '[{WHITE_SQL}]+'), lambda t: t <> '' and t not in ({stop}))"


SERVE_TOKENS_SQL = _serve_tokens_sql()


@QUERIES.add("sentiment_code", sql("select doc_id, overall, sentiment from reviews"))
def sentiment_code(spark, sf_dir):
    df = predictions(spark, sf_dir, "doc_id", "overall")
    return df.select("doc_id", "overall", ratings.sentiment_code(F.col("overall")).alias("sentiment"))


@QUERIES.add(
    "sentiment_text",
    sql("""
select doc_id, label,
  case sentiment when 0 then 'negatif' when 1 then 'neutre' else 'positif' end as label_fr from reviews
"""),
)
def sentiment_text(spark, sf_dir):
    code = ratings.sentiment_code(F.col("overall"))
    return predictions(spark, sf_dir, "doc_id", "overall").select(
        "doc_id",
        ratings.sentiment_text(code).alias("label"),
        ratings.sentiment_text(code, CLASSES_FR).alias("label_fr"),
    )


@QUERIES.add("clean_train", sql(f'select doc_id, {CLEAN_SQL} as cleaned_reviews from reviews where "reviewText" is not null'))
def clean_train(spark, sf_dir):
    df = filters.with_text(reviews(spark, sf_dir, "doc_id", "reviewText"))
    return projections.with_cleaned(df).drop("reviewText")


@QUERIES.add(
    "clean_serve",
    sql(f"select doc_id, coalesce(array_to_string({SERVE_TOKENS_SQL}, ' '), '') as cleaned from reviews"),
)
def clean_serve(spark, sf_dir):
    return reviews(spark, sf_dir, "doc_id", "reviewText").select(
        "doc_id", text.clean_serve(F.col("reviewText")).alias("cleaned")
    )


@QUERIES.add(
    "lemma_fold",
    sql(
        """
select w.doc_id, coalesce(string_agg(coalesce(l.lemma, w.token), ' ' order by w.place), '') as folded
from words w left join lemmas l on l.token = w.token group by w.doc_id
union all
select doc_id, '' as folded from served where len(coalesce(tokens, [])) = 0
""",
        served=f"select doc_id, {SERVE_TOKENS_SQL} as tokens from reviews",
        words="select doc_id, unnest(tokens) as token, generate_subscripts(tokens, 1) as place from served",
        vocabulary="select distinct token from words",
        exceptions="select * from (values " + ", ".join(f"('{t}', '{x}')" for t, x in NOUN_EXCEPTIONS.items()) + ") e(token, lemma)",
        candidates=" union all ".join(
            f"select token, token[:-{len(ending) + 1}] || '{instead}' as lemma from vocabulary where suffix(token, '{ending}')"
            for ending, instead in NOUN_RULES
        ),
        held="""select token, lemma from candidates where lemma in (select token from vocabulary)
          and token not in (select token from exceptions) union all select token, lemma from exceptions""",
        lemmas="select token, arg_min(lemma, (length(lemma), lemma)) as lemma from held group by token",
    ),
)
def lemma_fold(spark, sf_dir):
    df = reviews(spark, sf_dir, "doc_id", "reviewText")
    served = df.select("doc_id", F.coalesce(text.serve_tokens(F.col("reviewText")), F.array().cast("array<string>")).alias("tokens"))
    served = stored(served, "served")
    lemmas = stored(noun_lemmas(served), "noun-lemmas")
    folded = fold_lemmas(served, "doc_id", lemmas, candidate=lambda t: by_rule(t) | t.isin(list(NOUN_EXCEPTIONS)))
    return folded.select("doc_id", F.array_join("tokens", " ").alias("folded"))


@QUERIES.add("tokens", sql(f"select doc_id, array_to_string({TOKENS_SQL}, '|') as tokens from reviews"))
def tokens(spark, sf_dir):
    df = reviews(spark, sf_dir, "doc_id", "reviewText")
    return df.select("doc_id", F.array_join(text.tokens(F.col("reviewText")), "|").alias("tokens"))


@QUERIES.add(
    "stopwords",
    sql(f"""
select doc_id, array_to_string(list_filter({TOKENS_SQL}, lambda t: t not in ({sql_list(text.STOP_WORDS)})), '|') as kept
from reviews
"""),
)
def stopwords(spark, sf_dir):
    df = reviews(spark, sf_dir, "doc_id", "reviewText")
    kept = text.drop_stop_words(text.tokens(F.col("reviewText")))
    return df.select("doc_id", F.array_join(kept, "|").alias("kept"))


@QUERIES.add(
    "review_length",
    sql(f"""
select doc_id, cast(coalesce(len(list_filter(string_split_regex("reviewText", '[{WHITE_SQL}]+'),
  lambda t: t <> '')), 0) as int) as review_length from reviews
"""),
)
def review_length(spark, sf_dir):
    df = reviews(spark, sf_dir, "doc_id", "reviewText")
    return df.select("doc_id", text.review_length(F.col("reviewText")).alias("review_length"))


LENGTH_BIN_SQL = """case when length("reviewText") < 50 then '<50' when length("reviewText") < 100 then '50-99'
  when length("reviewText") < 200 then '100-199' when length("reviewText") < 500 then '200-499'
  when "reviewText" is not null then '500+' end"""
BIN_NO_SQL = """case when length("reviewText") < 50 then 0 when length("reviewText") < 100 then 1
  when length("reviewText") < 200 then 2 when length("reviewText") < 500 then 3
  when "reviewText" is not null then 4 end"""


@QUERIES.add(
    "length_bin",
    sql(f"""
select doc_id, {LENGTH_BIN_SQL} as length_bin, {BIN_NO_SQL} as bin_no from reviews where "reviewText" is not null
"""),
)
def length_bin(spark, sf_dir):
    column = F.col("reviewText")
    return filters.with_text(reviews(spark, sf_dir, "doc_id", "reviewText")).select(
        "doc_id", text.length_bin(column).alias("length_bin"), text.length_bin_no(column).alias("bin_no")
    )


@QUERIES.add("parse_helpful", sql("select doc_id, helpful_votes, total_votes from reviews"))
def parse_helpful(spark, sf_dir):
    df = predictions(spark, sf_dir, "doc_id", "helpful_votes", "total_votes")
    texts = df.select("doc_id", F.format_string("[%d, %d]", "helpful_votes", "total_votes").alias("helpful"))
    votes = ratings.parse_helpful(texts)
    return texts.select(
        "doc_id", ratings.helpful_votes(votes).alias("helpful_votes"), ratings.total_votes(votes).alias("total_votes")
    )


@QUERIES.add("helpful_votes", sql("select doc_id, helpful_votes, total_votes from reviews"))
def helpful_votes(spark, sf_dir):
    df = predictions(spark, sf_dir, "doc_id", "helpful")
    votes = ratings.parse_helpful(df)
    return df.select(
        "doc_id", ratings.helpful_votes(votes).alias("helpful_votes"), ratings.total_votes(votes).alias("total_votes")
    )


RATIO_SQL = "case when total_votes > 0 then helpful_votes / total_votes::double else 0.0::double end"


@QUERIES.add("helpful_ratio", sql(f"select doc_id, {RATIO_SQL} as helpfulness_ratio from reviews"))
def helpful_ratio(spark, sf_dir):
    ratio = ratings.helpfulness_ratio(F.col("helpful_votes"), F.col("total_votes"))
    return predictions(spark, sf_dir, "doc_id", "helpful_votes", "total_votes").select(
        "doc_id", ratio.alias("helpfulness_ratio")
    )


@QUERIES.add("minute_label", sql("select event_id, strftime(processed_ts, '%H:%M') as minute_label from event_predictions"))
def minute_label(spark, sf_dir):
    df = event_predictions(spark, sf_dir).select("event_id", display.iso(F.col("processed_ts")).alias("text"))
    return df.select("event_id", display.minute_label(display.parse_iso(F.col("text"))).alias("minute_label"))


@QUERIES.add(
    "iso_timestamps",
    sql("""
select event_id, strftime(processed_ts, '%Y-%m-%dT%H:%M:%S')
  || case when microsecond(processed_ts) % 1000000 = 0 then '' else strftime(processed_ts, '.%f') end as iso
from event_predictions
"""),
)
def iso_timestamps(spark, sf_dir):
    return event_predictions(spark, sf_dir).select("event_id", display.iso(F.col("processed_ts")).alias("iso"))


@QUERIES.add(
    "typed_record",
    sql("""
select doc_id, coalesce(try_cast(cast(overall as varchar) as float), 0)::float as overall,
  coalesce(try_cast(cast("unixReviewTime" as varchar) as bigint), 0)::bigint as "unixReviewTime",
  coalesce(try_cast(summary as int), 0)::int as sentiment from reviews
"""),
)
def typed_record(spark, sf_dir):
    """Fields that arrive as text; the summary stands for one that is no number."""
    df = reviews(spark, sf_dir, "doc_id", "overall", "unixReviewTime", "summary")
    return df.select(
        "doc_id",
        typed(F.col("overall").cast("string"), "float", 0.0).alias("overall"),
        typed(F.col("unixReviewTime").cast("string"), "bigint", 0).alias("unixReviewTime"),
        typed(F.col("summary"), "int", 0).alias("sentiment"),
    )


@QUERIES.add("confidence_pct", sql("select doc_id, printf('%.2f', confidence * 100) as confidence_pct from predictions"))
def confidence_pct(spark, sf_dir):
    df = predictions(spark, sf_dir, "doc_id", "confidence")
    return df.select("doc_id", display.percent(F.col("confidence")).alias("confidence_pct"))


@QUERIES.add(
    "label_display",
    sql("""
select doc_id, case label when 'positive' then 'Positive' when 'neutral' then 'Neutral' when 'negative' then 'Negative'
  else 'Unknown' end as label_display from predictions
"""),
)
def label_display(spark, sf_dir):
    df = predictions(spark, sf_dir, "doc_id", "label")
    return df.select("doc_id", ratings.label_display(F.col("label")).alias("label_display"))


@QUERIES.add("filter_text", sql('select doc_id, "reviewText" from reviews where "reviewText" is not null'))
def filter_text(spark, sf_dir):
    return filters.with_text(reviews(spark, sf_dir, "doc_id", "reviewText"))


@QUERIES.add(
    "coalesce_text",
    sql("""
select doc_id, coalesce(nullif("reviewText", ''), nullif(summary, '')) as "reviewText" from reviews
where coalesce(nullif("reviewText", ''), nullif(summary, '')) is not null
"""),
)
def coalesce_text(spark, sf_dir):
    df = reviews(spark, sf_dir, "doc_id", "reviewText", "summary").withColumnRenamed("summary", "text")
    return filters.coalesce_text(df).select("doc_id", "reviewText")


@QUERIES.add(
    "project_training",
    sql(f'select {CLEAN_SQL} as cleaned_reviews, label from reviews where "reviewText" is not null'),
)
def project_training(spark, sf_dir):
    df = filters.with_text(reviews(spark, sf_dir, "reviewText", "label"))
    return projections.training_columns(projections.with_cleaned(df))


@QUERIES.add("drop_cols", sql("select * exclude (sentiment, label) from reviews"))
def drop_cols(spark, sf_dir):
    """The ground truth and the columns of the feature stages go."""
    df = reviews(spark, sf_dir).withColumn("words", F.lit(None).cast("array<string>"))
    return projections.without_model_columns(df.drop("sentiment"))


@QUERIES.add("filter_class", sql("select doc_id, label from reviews where label = 'neutral'"))
def filter_class(spark, sf_dir):
    return filters.of_class(reviews(spark, sf_dir, "doc_id", "label"), "neutral")


@QUERIES.add(
    "known_labels",
    sql("""
select doc_id, "reviewerName", label from predictions
where label in ('positive', 'neutral', 'negative') and "reviewerName" <> ''
"""),
)
def known_labels_query(spark, sf_dir):
    return known_labels(predictions(spark, sf_dir, "doc_id", "reviewerName", "label"), "reviewerName")


CARD_SQL = """coalesce("reviewText", '') as review_text, coalesce(label, 'unknown') as sentiment,
  coalesce(confidence, 0.0) as confidence, processed_ts as timestamp, coalesce(asin, '') as product_id,
  coalesce("reviewerName", '') as reviewer, coalesce(summary, '') as summary, coalesce(overall, 0.0)::float as rating"""
CARD_COLUMNS = ["reviewText", "label", "confidence", "processed_ts", "asin", "reviewerName", "summary", "overall"]


@QUERIES.add("review_cards", sql(f"select {CARD_SQL} from predictions"))
def review_cards(spark, sf_dir):
    cards = projections.review_cards(predictions(spark, sf_dir, *CARD_COLUMNS))
    return cards.withColumn("rating", F.col("rating").cast("float"))


@QUERIES.add(
    "default_fields",
    sql("""
select doc_id, coalesce("reviewText", '') as "reviewText", coalesce("reviewerName", '') as "reviewerName",
  '' as review_text from reviews
"""),
)
def default_fields_query(spark, sf_dir):
    df = reviews(spark, sf_dir, "doc_id", "reviewText", "reviewerName")
    return default_fields(df, {"reviewText": "", "reviewerName": "", "review_text": ""})


@QUERIES.add("preview", sql("select doc_id, asin, overall, label from reviews order by doc_id limit 5"))
def preview(spark, sf_dir):
    return projections.preview(reviews(spark, sf_dir, "doc_id", "asin", "overall", "label"), "doc_id")


@QUERIES.add(
    "recent_snippets",
    sql("""
select substring(coalesce("reviewText", ''), 1, 100) || '...' as snippet, label, confidence, processed_ts
from predictions
"""),
)
def recent_snippets(spark, sf_dir):
    return projections.snippets(predictions(spark, sf_dir, "reviewText", "label", "confidence", "processed_ts"))
