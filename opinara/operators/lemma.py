"""Folding words to their base form with a (token, lemma) table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.session import stored

# Endings of English plural nouns and what the singular ends in instead.
NOUN_RULES = [
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
]
# Irregular plurals that no rule reaches; pass a table of your own for more.
NOUN_EXCEPTIONS = {
    "children": "child",
    "feet": "foot",
    "geese": "goose",
    "knives": "knife",
    "lives": "life",
    "mice": "mouse",
    "teeth": "tooth",
    "wives": "wife",
}


def by_rule(token: Column, rules: list[tuple[str, str]] = NOUN_RULES) -> Column:
    """Whether a rule's ending fits the token."""
    return reduce(Column.__or__, [token.endswith(ending) for ending, _ in rules], F.lit(False))


def stems(token: Column, rules: list[tuple[str, str]] = NOUN_RULES) -> Column:
    """The token without each ending that fits, with what the rule puts there instead."""

    def stem(ending: str, instead: str) -> Column:
        beginning = F.left(token, F.length(token) - len(ending))
        return F.when(token.endswith(ending), F.concat(beginning, F.lit(instead)))

    return F.array_compact(F.array(*[stem(*rule) for rule in rules]))


def exception_table(spark, exceptions: dict[str, str] = NOUN_EXCEPTIONS) -> DataFrame:
    return spark.createDataFrame(list(exceptions.items()), "token string, lemma string")


def noun_lemmas(
    words: DataFrame,
    column: str = "tokens",
    vocabulary: DataFrame | None = None,
    exceptions: DataFrame | None = None,
    rules: list[tuple[str, str]] = NOUN_RULES,
) -> DataFrame:
    """``token, lemma`` of the corpus' plural nouns.

    Each rule that fits gives a candidate stem; it counts if ``vocabulary`` (a table of ``token``; default: the
    corpus' own words) holds it. Of several the shortest wins, then the first in alphabetical order. A token in
    ``exceptions`` takes its lemma from there, whatever the rules say; of several the same one.

    Only distinct tokens are exploded, and candidates meet the vocabulary by semi-join. Both sides hold each word
    once or a few times, so no key is hot.
    """
    own = stored(words.select(F.explode(F.array_distinct(column)).alias("token")).distinct(), "corpus-words")
    known = own if vocabulary is None else vocabulary.select("token").distinct()
    if exceptions is None:
        exceptions = exception_table(words.sparkSession)
    listed = exceptions.filter("lemma is not null").join(own, "token", "left_semi").select("token", "lemma")

    ruled = own.filter(by_rule(F.col("token"), rules)).join(listed, "token", "left_anti")
    candidates = ruled.select("token", F.explode(stems(F.col("token"), rules)).alias("lemma"))
    held = candidates.join(known.select(F.col("token").alias("lemma")), "lemma", "left_semi").select("token", "lemma")
    shortest = F.min(F.struct(F.length("lemma"), "lemma")).getField("lemma")
    return held.unionByName(listed).groupBy("token").agg(shortest.alias("lemma"))


def plural_lemmas(words: DataFrame, column: str = "tokens") -> DataFrame:
    """``xs`` -> ``x`` only, for every word of the corpus whose ``x`` is in the corpus too."""
    none = words.sparkSession.createDataFrame([], "token string, lemma string")
    return noun_lemmas(words, column, exceptions=none, rules=NOUN_RULES[:1])


def fold_lemmas(
    df: DataFrame,
    key: str,
    lemmas: DataFrame,
    column: str = "tokens",
    candidate: Column | Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Replace each token that the table knows; order and repetition stay.

    A token with several lemmas takes the first of them in alphabetical order.

    Only a document's distinct tokens meet the table, and of these only those
    passing ``candidate``, a condition on the column ``token`` or, better, a
    function that makes one from a token: then documents without any candidate
    are passed on as they are, neither exploded nor shuffled. What matches goes
    back to its document as a small map. The table is written first: Spark
    broadcasts it where its true size allows, else joins by token and splits hot
    tokens, whose table side is a single row.
    """
    some, others = df, None
    if callable(candidate):
        fits = candidate
        any_fits = F.coalesce(F.exists(column, lambda t: fits(t)), F.lit(False))
        some, others = df.filter(any_fits), df.filter(~any_fits)
        candidate = fits(F.col("token"))
    found = some.select(key, F.explode(F.array_distinct(column)).alias("token"))
    if candidate is not None:
        found = found.filter(candidate)
    single = lemmas.filter("lemma is not null").groupBy("token").agg(F.min("lemma").alias("lemma"))
    matched = found.join(stored(single, "lemmas"), "token")
    folds = matched.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("token", "lemma"))).alias("_folds"))
    folded = F.transform(column, lambda t: F.coalesce(F.try_element_at("_folds", t), t))
    out = some.join(folds, key, "left").withColumn(column, F.when(F.col("_folds").isNull(), F.col(column)).otherwise(folded))
    out = out.select(*df.columns)
    return out if others is None else out.unionByName(others)
