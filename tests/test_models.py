"""Long-form features, classifiers, metrics and scoring against Spark ML."""

from __future__ import annotations

import math
import random

import pytest
from plan_text import plan
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from opinara.functions.text import clean_serve
from opinara.models import evaluation, features, training
from opinara.models.scoring import score_reviews
from opinara.operators import bayes, lemma, terms
from opinara.operators.projections import with_cleaned
from opinara.schema import CLASSES

WORDS = {
    "positive": "great love perfect works happy cable sound".split(),
    "negative": "broken bad awful returned poor cable noise".split(),
    "neutral": "okay fine average expected cable plain".split(),
}


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(7)
    rows = []
    for i in range(240):
        label = CLASSES[2 if i % 2 else i // 2 % 2]
        words = [rng.choice(WORDS[label]) for _ in range(rng.randint(3, 12))] + [f"rare{'abcdefgh'[i % 8] * (i % 30)}"]
        rows.append((i, "  ".join(words) + rng.choice(["", "!", " 5 stars", "\n"]), label))
    rows += [(900, "", "positive"), (901, "the and of", "negative")]
    return spark.createDataFrame(rows, "id long, reviewText string, label string").repartition(4).cache()


@pytest.fixture(scope="module")
def fitted(corpus):
    return features.fit_features(with_cleaned(corpus))


def vectors(model, df, column):
    names = model.stages[2].vocabulary
    out = {}
    for row in model.transform(with_cleaned(df)).select("id", column).collect():
        for i, v in zip(row[column].indices, row[column].values, strict=True):
            out[row.id, names[i]] = v
    return out


def test_term_counts_equal_the_vectorizer(corpus, fitted):
    counts = terms.count_words(corpus, "id")
    ours = {(r.id, r.term): float(r.tf) for r in terms.term_counts(counts, "id").collect()}
    assert ours == vectors(fitted, corpus, features.COUNTS)
    assert any(term == "" for _, term in ours)
    assert terms.documents(counts, "id").count() == 242


def test_weights_equal_the_idf_stage(corpus, fitted):
    ours = {(r.id, r.term): r.weight for r in terms.tfidf(terms.count_words(corpus, "id"), "id").collect()}
    theirs = vectors(fitted, corpus, "features")
    assert ours.keys() == theirs.keys()
    assert all(math.isclose(ours[k], theirs[k], rel_tol=1e-12, abs_tol=1e-12) for k in ours)


@pytest.mark.parametrize("size", [1, 5, 9, 20, 900])
def test_vocabulary_keeps_the_most_frequent(corpus, size):
    counts = terms.count_words(corpus, "id")
    everything = {r.term: r.total for r in terms.vocabulary(counts).collect()}
    kept = {r.term: r.total for r in terms.most_frequent(terms.vocabulary(counts), size).collect()}
    assert len(kept) == min(size, len(everything))
    assert sorted(kept.values()) == sorted(sorted(everything.values())[-size:])


def test_vocabulary_has_no_bound(spark):
    """More terms than the fixed-width stage keeps by default."""
    n = 270_000
    df = spark.range(n).select(F.col("id") % 2, F.concat(F.lit("w"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")))
    df = df.toDF("id", "term").union(df.toDF("id", "term").select(1 - F.col("id"), "term")).withColumn("tf", F.lit(1).cast("bigint"))
    counts = df.union(spark.createDataFrame([(0, None, 1), (1, None, 1)], "id long, term string, tf long"))
    assert terms.vocabulary(counts).count() == n
    assert terms.term_counts(counts, "id").count() == 2 * n
    weights = terms.tfidf(counts, "id").agg(F.count(F.lit(1)), F.min("df"), F.max(F.abs("weight"))).first()
    assert tuple(weights) == (2 * n, 2, 0.0)


def test_class_sums_need_no_join(spark, corpus, monkeypatch):
    """Broadcasts off: nothing is joined below the sums by term, so no term is a hot key."""
    counts = terms.count_words(corpus, "id", "label")
    for module in (terms, bayes):  # the whole plan at once
        monkeypatch.setattr(module, "stored", lambda df, name: df)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(bayes.class_weights(counts))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "Join" not in text and "partial_sum" in text


def test_naive_bayes_equals_the_estimator(spark, corpus, fitted):
    featured = fitted.transform(with_cleaned(corpus))
    model = NaiveBayes(featuresCol="features", labelCol="indexedLabel", smoothing=1.0).fit(featured)
    names, words = features.class_names(fitted), fitted.stages[2].vocabulary

    counts = terms.count_words(corpus, "id", "label")
    weights = bayes.class_weights(counts)
    theta = {(r.label, r.term): r.theta for r in bayes.by_class(weights).collect()}
    for i, label in enumerate(names):
        for j, term in enumerate(words):
            assert theta[label, term] == pytest.approx(model.theta[i, j])

    priors = bayes.class_priors(terms.documents(counts, "label"))
    assert {r.label: r.prior for r in priors.collect()} == pytest.approx({n: model.pi[i] for i, n in enumerate(names)})

    scored = {r.id: r for r in bayes.score(counts, weights, priors, "id").collect()}
    assert len(scored) == 242
    for row in model.transform(featured).select("id", "prediction", "probability").collect():
        assert scored[row.id].label == names[int(row.prediction)]
        assert scored[row.id].confidence == pytest.approx(max(row.probability))


def test_metrics_equal_the_evaluator(spark):
    rng = random.Random(3)
    rows = [(float(rng.randint(0, 2)), float(rng.choice([0, 0, 1, 2, 3]))) for _ in range(400)]
    df = spark.createDataFrame(rows, "indexedLabel double, prediction double")
    ours = evaluation.metrics(evaluation.confusion(df, "indexedLabel", "prediction")).first()
    for name in evaluation.METRICS:
        theirs = MulticlassClassificationEvaluator(labelCol="indexedLabel", metricName=name).evaluate(df)
        assert ours[name] == pytest.approx(theirs)


def test_first_of_equal_models_wins(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.7), (2, 0.7)], "model_order int, accuracy double")
    assert evaluation.select_best(df).first().model_order == 1
    assert training.best_of({"a": 0.5, "b": 0.7, "c": 0.7}) == "b"


def test_labels_follow_names_not_codes(spark, corpus, fitted):
    # Negative is rarer than positive here, so a fixed order of codes would be wrong.
    model = features.with_classifier(fitted, training.classifiers()["Naive Bayes"].fit(fitted.transform(with_cleaned(corpus))))
    df = spark.createDataFrame(
        [(0, "great love perfect"), (1, "broken awful bad"), (2, ""), (3, None)], "id int, reviewText string"
    )
    scored = score_reviews(df, model)
    assert {r.id: r.label for r in scored.collect()} == {0: "positive", 1: "negative"}
    assert set(scored.columns) == {"id", "reviewText", "label", "confidence"}
    assert all(0 < r.confidence <= 1 for r in scored.collect())
    assert score_reviews(df, model, clean=clean_serve).count() == 2


def test_saved_model_predicts_the_same(spark, corpus, fitted, tmp_path):
    model = features.with_classifier(fitted, training.quick_classifiers()["Logistic Regression"].fit(fitted.transform(with_cleaned(corpus))))
    path = training.save_model(model, str(tmp_path), "sentiment")
    again = training.save_model(model, str(tmp_path), "sentiment")
    assert path != again and path.startswith(f"{tmp_path}/sentiment/")
    copy = training.load_model(path)
    assert sorted(score_reviews(corpus, model).collect()) == sorted(score_reviews(corpus, copy).collect())
    text_only = features.feature_model(model).transform(with_cleaned(corpus))
    assert "features" in text_only.columns and "prediction" not in text_only.columns


def test_all_models_train_and_the_best_is_chosen(corpus):
    ready = with_cleaned(corpus)
    small = {n: m for n, m in training.quick_classifiers().items() if n != "Random Forest"}
    done = training.train_all(ready, ready, "id", small)
    assert set(done.models) == set(small)
    assert done.accuracy[done.best] == max(done.accuracy.values()) > 0.9


def test_folds_do_not_depend_on_partitions(corpus):
    folds = [{r.id: r.fold for r in training.with_folds(corpus.repartition(p), "id").collect()} for p in (1, 6)]
    assert folds[0] == folds[1]
    assert set(folds[0].values()) == {0, 1, 2}


def test_tuning(corpus, fitted):
    models = training.classifiers()
    featured = training.with_folds(fitted.transform(with_cleaned(corpus)), "id")
    tuned = training.cross_validate(featured, models["Naive Bayes"], training.grids(models)["Naive Bayes"])
    assert len(tuned.avgMetrics) == 3
    assert [len(g) for g in training.grids(models).values()] == [6, 4, 3]


def test_hashed_counts_are_at_their_slots(spark):
    df = spark.createDataFrame([(["cable", "cable", "sound", ""],)], f"{features.KEPT} array<string>")
    stage = features.hashing_stage()
    found = stage.transform(df).first()[features.HASHED]
    assert {int(i): v for i, v in zip(found.indices, found.values, strict=True)} == {
        stage.indexOf("cable"): 2.0,
        stage.indexOf("sound"): 1.0,
        stage.indexOf(""): 1.0,
    }


def test_cut_terms_are_told(corpus):
    ready = with_cleaned(corpus)
    assert features.cut_terms(features.fit_features(ready), ready) == 0
    everything = len(features.fit_features(ready).stages[2].vocabulary)
    assert features.cut_terms(features.fit_features(ready, vocab_size=5), ready) == everything - 5


def test_a_token_with_several_lemmas_takes_the_first(spark):
    df = spark.createDataFrame([(0, ["axes", "axes"])], "id int, tokens array<string>")
    table = spark.createDataFrame([("axes", "axis"), ("axes", "axe"), ("axes", None)], "token string, lemma string")
    assert lemma.fold_lemmas(df, "id", table).first().tokens == ["axe", "axe"]


def test_lemma_folding_keeps_order_and_repeats(spark):
    df = spark.createDataFrame(
        [(0, ["cables", "bass", "cable", "cables", "s"]), (1, ["bas", "cable"]), (2, []), (3, ["gas"])],
        "id int, tokens array<string>",
    )
    table = lemma.plural_lemmas(df)
    assert {(r.token, r.lemma) for r in table.collect()} == {("cables", "cable"), ("bass", "bas")}
    expected = {0: ["cable", "bas", "cable", "cable", "s"], 1: ["bas", "cable"], 2: [], 3: ["gas"]}
    for candidate in (None, F.col("token").endswith("s")):
        out = lemma.fold_lemmas(df, "id", table, candidate=candidate)
        assert {r.id: r.tokens for r in out.collect()} == expected


def test_noun_rules_and_exceptions(spark):
    text = "cities city boxes box wolves wolf women woman bus churches church dishes dish buzzes buzz lenses lens mice glass ponies s men man"
    df = spark.createDataFrame([(1, text.split()), (2, ["bus", "glass", "city"]), (3, []), (4, None), (4, ["mice", "mice"])], "id int, tokens array<string>")
    table = lemma.noun_lemmas(df)
    folds = {r.token: r.lemma for r in table.collect()}
    assert folds == {
        "cities": "city", "boxes": "box", "wolves": "wolf", "women": "woman", "churches": "church", "dishes": "dish",
        "buzzes": "buzz", "lenses": "lens", "mice": "mouse", "men": "man",
    }
    either = lambda t: lemma.by_rule(t) | t.isin("mice")
    for candidate in (None, either):
        out = lemma.fold_lemmas(df, "id", table, candidate=candidate)
        found = sorted((r.id, tuple(r.tokens or ("none",))) for r in out.collect())
        whole = tuple(folds.get(t, t) for t in text.split())
        assert found == sorted([(1, whole), (2, ("bus", "glass", "city")), (3, ("none",)), (4, ("none",)), (4, ("mouse", "mouse"))])


def test_the_shortest_stem_in_the_vocabulary_wins(spark):
    df = spark.createDataFrame([(1, ["axes", "ax", "axe", "doves", "dove"])], "id int, tokens array<string>")
    assert {r.token: r.lemma for r in lemma.noun_lemmas(df).collect()} == {"axes": "ax", "doves": "dove"}
    own = spark.createDataFrame([("axe",), ("dof",)], "token string")
    assert {r.token: r.lemma for r in lemma.noun_lemmas(df, vocabulary=own).collect()} == {"axes": "axe", "doves": "dof"}
    more = spark.createDataFrame([("axes", "axis"), ("axes", "axon"), ("oxen", "ox")], "token string, lemma string")
    assert {r.token: r.lemma for r in lemma.noun_lemmas(df, exceptions=more).collect()} == {"axes": "axis", "doves": "dove"}


def test_documents_without_candidates_are_not_joined(spark):
    df = spark.createDataFrame([(1, ["cats", "cat"]), (2, ["none", "here"])], "id int, tokens array<string>")
    text = plan(lemma.fold_lemmas(df, "id", lemma.noun_lemmas(df), candidate=lemma.by_rule))
    assert "Union" in text and "exists(tokens" in text


@pytest.mark.parametrize("seed", [1, 2])
def test_fold_accuracies_equal_the_tuner(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(240):
        label = rng.choice([*CLASSES, "positive"])
        words = rng.choices(WORDS[label] + rng.choice(list(WORDS.values())), k=rng.randrange(1, 9))
        rows.append((i, label, " ".join(words)))
    df = training.with_folds(with_cleaned(spark.createDataFrame(rows, "id int, label string, reviewText string")), "id")
    featured = features.fit_features(df).transform(df).select("id", "fold", "features", "indexedLabel").cache()
    models = training.classifiers()
    tuned = training.cross_validate(featured, models["Naive Bayes"], training.grids(models)["Naive Bayes"])
    counts = terms.count_words(df, "id", "label", "fold")
    means = bayes.fold_accuracies(counts, "id").groupBy("smoothing").agg(F.avg("accuracy").alias("mean"))
    assert [r["mean"] for r in means.orderBy("smoothing").collect()] == pytest.approx(tuned.avgMetrics)


def test_fold_accuracies_of_a_class_in_one_fold_only(spark):
    df = spark.createDataFrame([(0, "negative", "bad bad", 0), (1, "positive", "good", 1), (2, "positive", "good bad", 2), (3, "positive", "", 2)], "id int, label string, reviewText string, fold int")
    counts = terms.count_words(df, "id", "label", "fold")
    found = {(r.fold, r.smoothing): (r.n, r.hits) for r in bayes.fold_accuracies(counts, "id").collect()}
    # The empty text of fold 2 fits both classes alike, so it goes to the first.
    assert {f: v for (f, s), v in found.items() if s == 1.0} == {0: (1, 0), 1: (1, 1), 2: (2, 1)}


def test_naive_bayes_keeps_more_terms_than_the_fixed_width(spark, small, tmp_path):
    """The model that the scoring queries share has no bound on its terms, as their SQL has none."""
    from opinara.plans import text_models

    n = features.VOCABULARY + 500
    letters = F.translate(F.conv(F.col("id") + 1, 10, 26), "0123456789ABCDEFGHIJKLMNOP", "abcdefghijklmnopqrstuvwxyz")
    words = spark.range(n).agg(F.array_join(F.sort_array(F.collect_list(F.concat(F.lit("zq"), letters))), " ").alias("text"))
    docs = spark.range(12).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit("web").alias("source"))
    docs.crossJoin(words).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "customer"):
        spark.read.parquet(f"{small}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    model = text_models.fitted(spark, str(tmp_path), "Naive Bayes")
    assert len(model.stages[2].vocabulary) == n
