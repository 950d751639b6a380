"""Multinomial naive Bayes over long-form word counts, as joins and aggregates."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.operators.terms import MIN_DF, count_words, documents, hashed, idf, vocabulary
from opinara.operators.words import count_pieces, piece_sums
from opinara.schema import CLASSES
from opinara.session import stored


def class_priors(labels: DataFrame, smoothing: float = 1.0) -> DataFrame:
    """``label, prior``: smoothed log share of each class."""
    counts = labels.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.agg(F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))).scalar()
    sized = counts.withColumn("s", sizes)
    prior = F.log(F.col("n") + smoothing) - F.log(F.col("s.rows") + F.col("s.classes") * smoothing)
    return sized.select("label", prior.alias("prior"))


def class_weights(
    counts: DataFrame, smoothing: float = 1.0, classes: Sequence[str] = CLASSES, min_df: int = MIN_DF
) -> DataFrame:
    """``term, idf`` and for each class a column: the smoothed log share of the term's weight in it.

    ``counts`` carries ``label`` as a key. One grouping by term gives document
    frequency and occurrences per class; the idf is the same for all rows of a
    term, so it is multiplied afterwards, and no row is joined for it.
    """
    return _smoothed(vocabulary(counts, min_df, "label", classes), idf(counts, F.col("df")), smoothing, classes)


#: Sums of weights are exact in it, and so the same in any order of the terms.
EXACT = "decimal(38,18)"


def _smoothed(terms: DataFrame, weight: Column, smoothing: float, classes: Sequence[str]) -> DataFrame:
    """``class_weights`` from ``term, df`` and the occurrences per class; ``weight`` is a term's idf."""
    sums = stored(terms.select("term", weight.alias("idf"), *[(F.col(c) * weight).alias(c) for c in classes]), "class-sums")
    whole = [F.sum(F.col(c).cast(EXACT)).cast("double").alias(c) for c in classes]
    sizes = sums.agg(F.struct(F.count(F.lit(1)).alias("terms"), *whole)).scalar()
    sized = sums.withColumn("s", sizes)
    theta = [
        (F.log(F.col(c) + smoothing) - F.log(F.col(f"s.{c}") + F.col("s.terms") * smoothing)).alias(c) for c in classes
    ]
    return sized.select("term", "idf", *theta)


def by_class(weights: DataFrame, classes: Sequence[str] = CLASSES) -> DataFrame:
    """``label, term, theta`` in long form."""
    rows = [F.struct(F.lit(c).alias("label"), F.col(c).alias("theta")) for c in classes]
    return weights.select("term", F.inline(F.array(*rows))).select("label", "term", "theta")


def score(
    counts: DataFrame, weights: DataFrame, priors: DataFrame, key: str, classes: Sequence[str] = CLASSES
) -> DataFrame:
    """``key, label, confidence``: the likeliest class of every counted document and its probability.

    The counts meet the terms in one join, with idf and class weight already
    multiplied. A class without training rows is never chosen; ties go to the
    class that comes first in ``classes``.
    """
    gains = weights.select("term", *[(F.col("idf") * F.col(c)).alias(c) for c in classes])
    hits = counts.select(key, "term", "tf").join(hashed(stored(gains, "class-weights")), "term")
    sums = hits.groupBy(key).agg(*[F.sum(F.col("tf") * F.col(c)).alias(c) for c in classes])
    return _likeliest(documents(counts, key).join(sums, key, "left"), priors, key, classes)


def score_texts(
    df: DataFrame,
    key: str,
    column: str = "reviewText",
    smoothing: float = 1.0,
    classes: Sequence[str] = CLASSES,
    min_df: int = MIN_DF,
) -> DataFrame:
    """``key, label, confidence`` of the rows with ``scored``, by a model of the rows with ``train``; both are flags.

    The numbers are those of ``score`` and ``class_weights`` over ``count_words``, which is also the way taken where rows
    share a key. Counts stay packed by piece of text, and only the different terms of a piece are shuffled, once to be
    added up and once to meet their weights.
    """
    rows = df.select(key, "label", "train", "scored", column)
    pieces = count_pieces(rows, "label", "train", classes, column)
    docs = pieces.filter(F.col("code").isNull()).select(key, "label", "train", "scored")
    if not docs.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).isEmpty():
        counts = count_words(rows, key, "label", "train", "scored", column=column)
        train = counts.filter("train")
        priors = class_priors(documents(train, "label"), smoothing)
        return score(counts.filter("scored"), class_weights(train, smoothing, classes, min_df), priors, key, classes)
    train = docs.filter("train")
    weights = _piece_weights(pieces, train, smoothing, classes, min_df)
    gains = stored(weights.select("term", *[(F.col("idf") * F.col(c)).alias(c) for c in classes]), "class-weights")
    sums = piece_sums(pieces.filter(F.col("code").isNotNull() | F.col("scored")), gains, key, classes)
    return _likeliest(sums, class_priors(train.select("label"), smoothing), key, classes)


def _piece_weights(pieces: DataFrame, train: DataFrame, smoothing: float, classes: Sequence[str], min_df: int) -> DataFrame:
    """``class_weights`` from ``count_pieces``; ``train`` has a row for every document learned from."""
    learned = pieces.filter(F.col("code").isNotNull()).groupBy("term")
    per_term = learned.agg(F.sum("df").alias("df"), *[F.sum(f"n{i}").alias(c) for i, c in enumerate(classes)])
    terms = stored(per_term.filter(F.col("df") >= min_df), "terms")
    size = train.agg(F.count(F.lit(1))).scalar()
    return _smoothed(terms, F.log((size + 1) / (F.col("df") + 1)), smoothing, classes)


@dataclass(frozen=True)
class TermModel:
    """A fitted model as two tables, so that no term is on the driver, in training, saving, loading or scoring.

    ``weights`` are those of ``class_weights``, ``priors`` those of ``class_priors``. Every row is a document of its own, as
    for Spark ML's estimator, whose numbers these are; ties go to the class that comes first in ``classes``.
    """

    weights: DataFrame
    priors: DataFrame
    classes: tuple[str, ...] = tuple(CLASSES)

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        column: str = "reviewText",
        label: str = "label",
        smoothing: float = 1.0,
        classes: Sequence[str] = CLASSES,
        min_df: int = MIN_DF,
    ) -> TermModel:
        """Learned from the rows with a text."""
        rows = df.select(F.col(label).alias("label"), F.lit(True).alias("train"), column)
        pieces = count_pieces(rows, "label", "train", classes, column)
        train = pieces.filter(F.col("code").isNull()).select("label")
        weights = stored(_piece_weights(pieces, train, smoothing, classes, min_df), "class-weights")
        return cls(weights, stored(class_priors(train, smoothing), "class-priors"), tuple(classes))

    def save(self, path: str) -> None:
        """The tables, and a description that ``is_at`` knows, which comes last."""
        spark = self.weights.sparkSession
        self.weights.write.parquet(f"{path}/weights")
        self.priors.write.parquet(f"{path}/priors")
        said = json.dumps({"class": _MODEL, "classes": self.classes})
        spark.createDataFrame([(said,)], "value string").coalesce(1).write.text(f"{path}/metadata")

    @staticmethod
    def is_at(spark: SparkSession, path: str) -> bool:
        """Whether the model stored there is one of these."""
        return json.loads(spark.read.text(f"{path}/metadata").first().value)["class"] == _MODEL

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TermModel:
        said = json.loads(spark.read.text(f"{path}/metadata").first().value)
        return cls(spark.read.parquet(f"{path}/weights"), spark.read.parquet(f"{path}/priors"), tuple(said["classes"]))

    def score(self, df: DataFrame, *keys: str, column: str = "reviewText") -> DataFrame:
        """The keys, ``label`` and ``confidence`` of every row with a text, by way of ``count_pieces`` and ``piece_sums``."""
        none = F.lit(None).cast("string").alias("label")
        rows = df.select(F.struct(*keys).alias("_keys"), none, F.lit(False).alias("train"), column)
        pieces = count_pieces(rows, "label", "train", (), column)
        gains = self.weights.select("term", *[(F.col("idf") * F.col(c)).alias(c) for c in self.classes])
        sums = piece_sums(pieces, gains, "_keys", self.classes)
        return _likeliest(sums, self.priors, "_keys", self.classes).select("_keys.*", "label", "confidence")


_MODEL = f"{TermModel.__module__}.{TermModel.__qualname__}"


def _likeliest(sums: DataFrame, priors: DataFrame, key: str, classes: Sequence[str]) -> DataFrame:
    """``key, label, confidence`` from a document's sum for each class, null where it has no known term."""
    base = priors.agg(F.map_from_entries(F.collect_list(F.struct("label", "prior")))).scalar()
    scored = sums.withColumn("_prior", base)
    totals = [
        F.struct(
            (F.coalesce(F.col(c), F.lit(0.0)) + F.try_element_at("_prior", F.lit(c))).alias("s"),
            F.lit(-i).alias("i"),
            F.lit(c).alias("label"),
        )
        for i, c in enumerate(classes)
    ]
    ranked = scored.select(key, F.filter(F.array(*totals), lambda t: t["s"].isNotNull()).alias("all"))
    ranked = ranked.withColumn("best", F.array_max("all"))
    odds = F.aggregate("all", F.lit(0.0), lambda acc, t: acc + F.exp(t["s"] - F.col("best.s")))
    return ranked.select(key, F.col("best.label").alias("label"), (1 / odds).alias("confidence"))


def fold_accuracies(
    counts: DataFrame,
    key: str,
    smoothings: Sequence[float] = (0.5, 1.0, 2.0),
    folds: int = 3,
    classes: Sequence[str] = CLASSES,
    min_df: int = MIN_DF,
) -> DataFrame:
    """``fold, smoothing, n, hits, accuracy``: cross-validation of all settings in one pass over the counts.

    ``counts`` carries ``label`` and ``fold`` as keys. Nothing is trained fold by fold: one grouping by term gives the
    occurrences per fold and class, and what a fold's model has learned is the total less the fold's own share. Counts
    then meet the weights of their fold for every setting in a single join. Vocabulary and idf come from all rows, as
    where the feature stages are fitted once. Only one number per fold and class reaches the driver.
    """
    cells = [(f, c) for f in range(folds) for c in classes]
    own = [F.sum(F.when((F.col("fold") == f) & (F.col("label") == c), F.col("tf")).otherwise(0)).alias(f"_{f}_{c}") for f, c in cells]
    per_term = counts.filter(F.col("term").isNotNull()).groupBy("term").agg(F.count(F.lit(1)).alias("df"), *own)
    kept = per_term.filter(F.col("df") >= min_df)
    weight = idf(counts, F.col("df"))
    sums = stored(kept.select("term", weight.alias("idf"), *[(F.col(f"_{f}_{c}") * weight).alias(f"_{f}_{c}") for f, c in cells]), "fold-sums")
    sizes = sums.agg(F.count(F.lit(1)).alias("terms"), *[F.coalesce(F.sum(f"_{f}_{c}"), F.lit(0.0)).alias(f"_{f}_{c}") for f, c in cells]).first()
    rows = {(r.fold, r.label): r.n for r in documents(counts, "fold", "label").groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect()}

    def gains(fold: int) -> Column:
        """For every setting and class: the weight of one occurrence of the term."""
        out = []
        for smoothing in smoothings:
            for c in classes:
                others = [f for f in range(folds) if f != fold]
                learned = sum((F.col(f"_{f}_{c}") for f in others), F.lit(0.0))
                total = sum(sizes[f"_{f}_{c}"] for f in others) + sizes["terms"] * smoothing
                out.append(F.col("idf") * (F.log(learned + smoothing) - math.log(total) if total else F.lit(0.0)))
        return F.array(*out)

    tables = [F.struct(F.lit(f).alias("fold"), gains(f).alias("gain")) for f in range(folds)]
    weights = stored(sums.select("term", F.inline(F.array(*tables))), "fold-weights")
    hits = counts.select(key, "fold", "term", "tf").join(hashed(weights), ["fold", "term"])
    n = len(smoothings) * len(classes)
    totals = hits.groupBy(key).agg(*[F.sum(F.col("tf") * F.col("gain")[i]).alias(f"_s{i}") for i in range(n)])
    scored = documents(counts, key, "fold", "label").join(totals, key, "left")

    def prior(fold: int, c: str, smoothing: float) -> float | None:
        learned = {x: sum(k for (f, label), k in rows.items() if label == x and f != fold) for _, x in rows}
        learned = {x: k for x, k in learned.items() if k}
        if c not in learned:
            return None
        return math.log(learned[c] + smoothing) - math.log(sum(learned.values()) + smoothing * len(learned))

    results = []
    for s, smoothing in enumerate(smoothings):
        classed = []
        for i, c in enumerate(classes):
            at = F.get(F.array(*[F.lit(prior(f, c, smoothing)).cast("double") for f in range(folds)]), F.col("fold"))
            gained = F.coalesce(F.col(f"_s{s * len(classes) + i}"), F.lit(0.0))
            classed.append(F.struct((at + gained).alias("s"), F.lit(-i).alias("i"), F.lit(c).alias("label")))
        best = F.array_max(F.filter(F.array(*classed), lambda t: t["s"].isNotNull()))["label"]
        results.append(F.struct(F.lit(float(smoothing)).alias("smoothing"), (best == F.col("label")).alias("hit")))
    judged = scored.select("fold", F.inline(F.array(*results)))
    found = judged.groupBy("fold", "smoothing").agg(F.count(F.lit(1)).alias("n"), F.count_if("hit").alias("hits"))
    return found.withColumn("accuracy", F.col("hits") / F.col("n"))
