from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from llm_cases import DOCS, ODD, prose

from opinara.llm import toxicity
from opinara.llm.common import table
from opinara.llm.toxicity import Model, segments

BAD = ["scumfoo", "vilebar", "hatebaz", "grimqux"]


def maximal(scores):
    """All maximal scoring segments by their definition: the best one first, then in what lies on either side of it."""

    def best(a, b):
        found = None
        for i in range(a, b):
            for j in range(i + 1, b + 1):
                s = sum(scores[i:j])
                if s > 1e-12 and (found is None or s > found[0] + 1e-9 or (abs(s - found[0]) <= 1e-9 and j - i < found[2] - found[1])):
                    found = s, i, j
        return found

    def split(a, b):
        found = best(a, b)
        return [] if found is None else [*split(a, found[1]), (found[1], found[2]), *split(found[2], b)]

    return split(0, len(scores))


def test_segments_against_their_definition():
    rng = random.Random(1)
    for _ in range(400):
        # Whole multiples that are no sums of each other, so that no two segments tie.
        scores = [rng.choice([-1.0, -1.0, -1.0, 1.37 + rng.random(), 3.1 + rng.random()]) for _ in range(rng.randrange(18))]
        hits = [(i, s) for i, s in enumerate(scores) if s > 0]
        assert [(s.start, s.end) for s in segments(hits, -1.0)] == maximal(scores)
        for s in segments(hits, -1.0):
            assert math.isclose(s.score, sum(scores[s.start : s.end]), abs_tol=1e-9)


def test_segments_take_one_pass():
    n = 200_000
    assert len(segments([(3 * i, 1.0) for i in range(n)], -1.0)) == n
    assert len(segments([(2 * i, 5.0) for i in range(n)], -1.0)) == 1
    assert len(segments([(i * 3, 1.0 + (n - i) / n) for i in range(n)], -1.0)) == n


def test_decay_solves_its_equation():
    rng = random.Random(2)
    for _ in range(50):
        scores = np.array([rng.uniform(1, 6) for _ in range(5)])
        step = -rng.uniform(0.01, 0.5)
        shares = np.full(5, 0.1 * -step / scores.max() * rng.random())
        x = toxicity.decay(scores, shares, step)
        assert x > 0 and abs(shares @ np.exp(x * scores) + (1 - shares.sum()) * math.exp(x * step) - 1) < 1e-6


def test_log_odds_and_prior():
    odds, error = toxicity.log_odds(np.array([50.0, 1.0, 100.0]), np.array([0.0, 0.0, 900.0]), 1000, 9000)
    assert odds[0] / error[0] > toxicity.LEAST_Z > odds[1] / error[1]
    assert abs(odds[2]) < 0.1


def test_beginnings_of_words():
    assert toxicity.units(b"abc") == [b"abc"]
    assert toxicity.units("öäüßen".encode()) == ["öäüßen".encode(), "öäüß*".encode(), "öäüße*".encode()]


def test_chances_and_probabilities_stay_in_range():
    model = Model({b"x": 5.0}, -0.05, 1.2, 0.001, 0.8, -4.0)
    text = b"word " * 500
    empty, some, many = (model.figure(*model.hits(t)) for t in (text, text + b"x " + text, text + b"x y x " * 2000))
    assert empty == 0 < some < many < math.inf
    assert 0 < model.probability(empty) < model.probability(some) <= model.probability(many) <= 1


def made(n, seed):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.2
        words = prose(seed * 10_000 + i, rng.randrange(5, 120)).split()
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "", "a", "en", "ist"]))
        docs.append((i, " ".join(words)))
        labels.append((i, rng.randrange(2), int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    rows = [(i, t, "en", "s", None, *["x"] * 7) for i, t in docs]
    return spark.createDataFrame(rows, DOCS).repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_finds_toxic_documents_and_passages(spark):
    docs, labels = made(1500, 3)
    frame, marks = frames(spark, docs, labels)
    found = {r.doc_id: r for r in toxicity.classify(frame, marks).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in found.items())
    held = [(found[i].predicted, toxic) for i, _, toxic in labels if found[i].held_out]
    assert sum(p == t for p, t in held) >= 0.97 * len(held)
    model = toxicity.train(frame, marks)
    spots = toxicity.passages(frame, model).collect()
    texts = dict(docs)
    for s in spots:
        inside = [w for some in toxicity.words(texts[s.doc_id].encode()) for w in some][s.first_word : s.end_word]
        assert any(w.decode().startswith(b) for b in BAD for w in (inside[0],)) and s.chance <= 0.01
    toxic = {i for i, _, t in labels if t}
    assert len({s.doc_id for s in spots} & toxic) >= 0.9 * len(toxic) and len({s.doc_id for s in spots} - toxic) <= 5


def test_held_out_labels_teach_nothing(spark):
    docs, labels = made(300, 4)
    marks = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    a, b = (sorted(map(tuple, toxicity.classify(*frames(spark, docs, m)).collect())) for m in (labels, marks))
    assert a == b


@pytest.mark.parametrize("kept", [None, 0, 1])
def test_few_or_no_labels(spark, kept):
    docs, labels = made(120, 5)
    found = toxicity.classify(*frames(spark, docs, [x for x in labels if x[2] == kept])).collect()
    scores = {r.score for r in found}
    assert len(found) == len(docs)
    assert scores == {0.5} if kept is None else (max(scores) < 0.1 if kept == 0 else min(scores) > 0.8)


def test_odd_and_empty_tables(spark, odd, none):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(8, 26)] + [(None, 1, 1), (10, None, None)], "doc_id long, quality int, toxic int")
    found = toxicity.classify(odd, labels).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0) for r in found)) == sorted((i is None, i or 0) for i, _ in ODD)
    assert toxicity.classify(none, labels).count() == 0
    assert {r.score for r in toxicity.classify(odd, labels.limit(0)).collect()} == {0.5}


def test_held_out_accuracy_on_the_tables(spark):
    folder = "/root/testdata/sf0.1"
    labels = table(spark, folder, "labels")
    found = toxicity.classify(table(spark, folder, "documents"), labels).join(labels, "doc_id").filter("held_out").collect()
    caught = [r.predicted for r in found if r.toxic]
    alarms = [r.predicted for r in found if not r.toxic]
    assert len(caught) > 80 and sum(caught) >= 0.92 * len(caught)  # some toxic rows hold no toxic word
    assert sum(alarms) <= 0.01 * len(alarms)


def test_sample_is_bounded(spark):
    docs, labels = made(400, 6)
    assert toxicity.teaching(*frames(spark, docs, labels), sample=100).count() < 150
