from __future__ import annotations

import zlib

import numpy as np
import pytest
from llm_cases import ODD

from opinara.llm import quality


def area(scores, labels):
    """The share of pairs of unlike labels that the scores put right."""
    good, bad = scores[labels == 1], scores[labels == 0]
    return ((good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean()) if len(good) and len(bad) else 1.0


def test_additive_and_pair_effects():
    rng = np.random.default_rng(51)
    x = rng.normal(size=(4000, 5))
    chance = 1 / (1 + np.exp(-(2 * np.sin(2 * x[:, 0]) + 3 * np.sign(x[:, 1] * x[:, 2]))))
    y = (rng.random(4000) < chance).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert area(model.scores(x[3000:]), y[3000:]) > 0.9
    assert (1, 2) in model.pairs


def test_tables_add_up():
    rng = np.random.default_rng(52)
    x, y = rng.random((300, 3)), (rng.random(300) < 0.5).astype(float)
    model = quality.fit(x, y)
    for row, score in zip(x[:20], model.scores(x[:20]), strict=True):
        at = [int((e <= v).sum()) for e, v in zip(model.edges, row, strict=True)]
        total = model.base + sum(t[b] for t, b in zip(model.tables, at, strict=True))
        total += sum(t[at[i], at[j]] for (i, j), t in model.pairs.items())
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = quality.classify(docs, labels).collect()
    assert len(found) == docs.count()
    known = {r.doc_id: r.quality for r in labels.collect()}
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1
    tested = [(r.score, known[r.doc_id]) for r in found if r.held_out and r.doc_id in known]
    assert area(*np.array(tested).T) > 0.99


def test_odd_rows_and_labels(spark, odd, none):
    schema = "doc_id long, quality int, toxic int, features string"
    labels = spark.createDataFrame([(10, 1, 0, ""), (10, 0, 0, ""), (None, 1, 0, ""), (13, None, 0, ""), (24, 0, 1, "")], schema)
    found = quality.classify(odd, labels).collect()
    assert sorted((str(r.doc_id) for r in found)) == sorted(str(i) for i, _ in ODD)
    assert all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in quality.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(none, labels).count() == 0


def test_sample_is_bounded(spark):
    rows = quality.feature_table(spark.range(3000).selectExpr("id as doc_id", "concat('text ', id) as text"))
    labels = spark.range(3000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    seen = []
    fit, quality.fit = quality.fit, lambda x, y: seen.append(len(x)) or fit(x[:10], y[:10])
    try:
        quality.train(rows, labels, sample=100)
    finally:
        quality.fit = fit
    assert 40 < seen[0] <= 100
