"""Words of texts, cut and counted in Arrow batches, against Spark's expressions and stages."""

from __future__ import annotations

import random

import pytest
from plan_text import plan
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from opinara.functions.text import STOP_WORDS, train_tokens
from opinara.models import features, training
from opinara.operators import bayes, terms, words
from opinara.operators.projections import with_cleaned
from opinara.schema import CLASSES
from opinara.streaming.scoring import dead_letters

ODD = ["", None, " ", "\n", " \n ", "\n a", "a\n", "the", "the ", "é", "..", ".\n.", "cable  the cable"]
PARTS = [*"aBz \t\n\x0b\f\r\x1c\x85é日😀ſKİ.,0", "the", "and ", "cable", " "]


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choices(PARTS, k=rng.randrange(14))) for _ in range(2000)]
    return spark.createDataFrame(list(enumerate(texts)), "id long, reviewText string").repartition(3).cache()


def tuples(df):
    return sorted((r.id, r.term is not None, r.term or "", r.tf) for r in df.collect())


def test_counts_equal_the_expressions(odd):
    found = odd.select("id", F.explode(F.array_append(train_tokens(F.col("reviewText")), F.lit(None).cast("string"))).alias("term"))
    kept = found.filter(F.col("term").isNull() | ~F.col("term").isin(STOP_WORDS))
    assert tuples(terms.count_words(odd, "id")) == tuples(kept.groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf")))


def test_no_word_is_shuffled_to_be_counted(odd):
    assert "Exchange" not in plan(words.count_rows(odd.select("id", "reviewText"), "id", column="reviewText")).split("InMemoryRelation")[0]


def test_rows_that_share_their_key_are_added_up(spark):
    df = spark.createDataFrame([(1, "cable cable"), (1, "cable sound"), (2, "sound")], "id long, reviewText string")
    assert {(r.id, r.term): r.tf for r in terms.count_words(df, "id").collect()} == {
        (1, "cable"): 3, (1, "sound"): 1, (1, None): 2, (2, "sound"): 1, (2, None): 1,
    }


def test_pieces_of_a_batch_make_the_whole(odd, monkeypatch):
    whole = tuples(words.count_rows(odd, "id", column="reviewText"))
    monkeypatch.setattr(words, "PIECE", 64)
    batch = odd.select("id", F.col("reviewText").alias("_text")).toArrow().combine_chunks().to_batches()[0]
    pieces = list(words._pieces(iter([batch]), "_text"))
    assert len(pieces) > 10
    assert sum(len(p) for p in pieces) == len({r[0] for r in whole})


def test_fitted_features_equal_the_stages(odd):
    """The training rows' vectors, made beside the stages, are those that the fitted stages give."""
    train = with_cleaned(odd.filter(F.col("reviewText").isNotNull())).withColumn("label", F.when(F.col("id") % 3 == 0, "a").otherwise("b"))
    model, featured = features.fit_featured(train, "id")
    theirs = {r.id: r.features for r in PipelineModel(stages=model.stages[:4]).transform(train).select("id", "features").collect()}
    assert {r.id: r.features for r in featured.collect()} == theirs
    found = terms.vocabulary(terms.count_words(odd, "id"))
    assert sorted(model.stages[2].vocabulary) == sorted(r.term for r in found.collect())
    assert model.stages[2].getMinDF() == features.MIN_DF


def test_a_message_is_parsed_once(spark, tmp_path):
    """A filter on what was read is not moved below the parser, where it would parse again."""
    spark.createDataFrame([("{}",)], "value string").write.text(f"{tmp_path}/messages")
    text = dead_letters(spark.read.text(f"{tmp_path}/messages"))._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(StructField(asin") == 1


def test_regression_works_on_large_blocks(spark):
    """At the default block size most of an iteration fills matrices of one number per term and class."""
    for settings in (training.classifiers, training.quick_classifiers):
        assert settings()["Logistic Regression"].getMaxBlockSizeInMB() == training.BLOCK


def test_batch_scores_need_no_terms_on_the_driver(spark, small, monkeypatch):
    """They come from class sums in long form, whole counts times the term's idf, as in the SQL."""
    from opinara.plans import text_models

    monkeypatch.setattr(text_models, "fitted", lambda *_: pytest.fail("fitted a model"))
    assert text_models.score_batch(spark, small).count() > 0


def flagged(df):
    return df.withColumns({"label": F.element_at(F.array(*map(F.lit, CLASSES)), (F.col("id") % 3 + 1).cast("int")),
                           "train": F.col("id") % 5 > 0, "scored": F.col("reviewText") != ""})


def scores(df):
    return {r.id: (r.label, r.confidence) for r in df.collect()}


@pytest.mark.parametrize("shared", [False, True])
def test_packed_scores_equal_the_long_form(odd, shared, monkeypatch):
    """Also where several rows share a key and are one document."""
    monkeypatch.setattr(words, "PIECE", 1 << 12)
    df = flagged(odd.filter("reviewText is not null"))
    if shared:
        df = df.union(df.filter("id % 7 = 0"))
    counts = terms.count_words(df, "id", "label", "train", "scored")
    train = counts.filter("train")
    priors = bayes.class_priors(terms.documents(train, "label"))
    theirs = scores(bayes.score(counts.filter("scored"), bayes.class_weights(train), priors, "id"))
    ours = scores(bayes.score_texts(df, "id"))
    assert {i: x[0] for i, x in ours.items()} == {i: x[0] for i, x in theirs.items()}
    assert {i: x[1] for i, x in ours.items()} == pytest.approx({i: x[1] for i, x in theirs.items()}, abs=1e-12)


def test_scores_do_not_depend_on_the_order_of_sums(spark, small, monkeypatch):
    """Unrounded, over rows dealt in two ways."""
    from opinara.plans import text_models

    texts, found = text_models._texts, []
    monkeypatch.setattr(F, "round", lambda c, _: F.col(c))
    for parts in (1, 7):
        monkeypatch.setattr(text_models, "_texts", lambda *a, n=parts: texts(*a).repartition(n, F.hash("doc_id")))
        found.append({r.doc_id: (r.label, r.confidence) for r in text_models.score_batch(spark, small).collect()})
    assert found[0] == found[1]


def test_counted_scores_equal_the_stages(odd, monkeypatch):
    """A batch is scored from counts made in Arrow batches; the text stages of the model are not run."""
    from opinara.models import scoring

    train = with_cleaned(flagged(odd.filter("reviewText is not null")))
    text, featured = features.fit_featured(train, "id")
    model = features.with_classifier(text, training.quick_classifiers()["Logistic Regression"].fit(featured))
    theirs = scores(scoring.score_reviews(odd, model))
    monkeypatch.setattr(type(model.stages[0]), "transform", lambda *_: pytest.fail("cut words in a stage"))
    ours = scores(scoring.score_counted(odd, model, "id"))
    assert {i: x[0] for i, x in ours.items()} == {i: x[0] for i, x in theirs.items()} and len(ours) > 1000
    assert {i: x[1] for i, x in ours.items()} == pytest.approx({i: x[1] for i, x in theirs.items()}, abs=1e-12)
