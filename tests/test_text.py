"""Text functions against plain Python on awkward texts."""

from __future__ import annotations

import re

import pytest
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from opinara.functions import text

TEXTS = [
    None,
    "",
    " ",
    "   \t\n ",
    "\n",
    "12345 !!! ...",
    "Great  product,   bought 2!",
    " leading and trailing  ",
    "Don't stop - it's GOOD",
    "café ÉTÉ naïve straße",
    "tab\tand\nnewline\r\nend\n",
    "hello world wide　space",
    "file\x1cseparator\x1funit",
    "emoji 😀 text😀joined",
    "cannot gonna gotta gimme lemme wanna wannabe cannots",
    "İstanbul Kelvin K",
    "a\x0bb\x0cc",
]


def frame(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "id int, t string")


def values(df, column):
    return [r[0] for r in df.orderBy("id").select(column).collect()]


def test_training_cleaner(spark):
    got = values(frame(spark), text.clean_train(F.col("t")))
    expected = [None if t is None else re.sub(r"[^a-zA-Z \t\n\x0b\f\r]", " ", t).lower().strip(" ") for t in TEXTS]
    assert got == expected


def test_serving_cleaner(spark):
    def serve(t):
        if t is None:
            return ""
        letters = re.sub(r"[^a-zA-Z\s]", "", t.lower())
        for a, b in text.SPLIT_WORDS:
            letters = re.sub(rf"\b{a}{b}\b", f"{a} {b}", letters)
        return " ".join(w for w in letters.split() if w not in text.SERVING_STOP_WORDS)

    assert values(frame(spark), text.clean_serve(F.col("t"))) == [serve(t) for t in TEXTS]


def test_word_count(spark):
    assert values(frame(spark), text.review_length(F.col("t"))) == [0 if t is None else len(t.split()) for t in TEXTS]
    assert values(frame(spark), text.review_length(F.col("t"), null_words=1))[0] == 1


def test_ml_tokens_follow_the_tokenizer(spark):
    df = frame(spark, [t for t in TEXTS if t is not None] + ["a  b", "a ", " a", "a \n", "\na"])
    words = Tokenizer(inputCol="t", outputCol="words").transform(df)
    for raw, ours in words.select("words", text.ml_tokens(F.col("t"))).collect():
        assert ours == raw


def test_tokens_have_no_empty_ones(spark):
    got = values(frame(spark), text.tokens(F.col("t")))
    assert got[0] is None
    assert all("" not in words for words in got[1:])


def test_stop_words_are_those_of_the_remover(spark):
    assert text.STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")
    df = spark.createDataFrame([(0, ["the", "cat", "The", "cat", "", "isn't"])], "id int, words array<string>")
    expected = StopWordsRemover(inputCol="words", outputCol="kept").transform(df).first()["kept"]
    assert values(df, text.drop_stop_words(F.col("words")))[0] == expected


@pytest.mark.parametrize(
    ("chars", "name", "no"),
    [
        (0, "<50", 0),
        (49, "<50", 0),
        (50, "50-99", 1),
        (99, "50-99", 1),
        (100, "100-199", 2),
        (199, "100-199", 2),
        (200, "200-499", 3),
        (499, "200-499", 3),
        (500, "500+", 4),
    ],
)
def test_length_bins(spark, chars, name, no):
    df = frame(spark, ["é" * chars])
    assert df.select(text.length_bin(F.col("t")), text.length_bin_no(F.col("t"))).first()[:] == (name, no)


def test_snippet(spark):
    assert values(frame(spark, ["x" * 120, "ab", None]), text.snippet(F.col("t"))) == ["x" * 100 + "...", "ab...", "..."]


def test_train_tokens_are_the_tokens_of_the_cleaned_text(spark):
    from opinara.functions.text import clean_train, ml_tokens, train_tokens

    texts = ["", " ", "\n", " \n ", ".\n.", "\tA b", " .A  b\t c\n\n", "1 a", "é x", "\x0b\x0cq\r", "a.", "K k", None, "\n\n a\tb", "..", "a b"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in df.select("text", ml_tokens(clean_train(F.col("text"))).alias("a"), train_tokens(F.col("text")).alias("b")).collect():
        assert row.a == row.b, row.text
