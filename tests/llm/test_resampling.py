from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from llm_cases import DOCS, documents, prose

from opinara.llm import resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def buckets(text, size, lengths):
    w = words(text)
    found = [" ".join(w[i : i + n]) for n in range(lengths[0], lengths[1] + 1) for i in range(len(w) - n + 1)]
    return [zlib.crc32(f.encode()) % size for f in found]


def expected(docs, target, size=10_000, lengths=(1, 1), least=20, percent=10, seed=2024):
    s, t = (Counter(b for x in texts for b in buckets(x, size, lengths)) for texts in ([x for _, x in docs], target))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + size) / ((s[b] + 1) * (T + size)))) for b in range(size)]
    rows = []
    for doc_id, text in docs:
        found = buckets(text, size, lengths)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(found), weight, score, len(words(text)) >= least))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    top = able[: percent * len(able) // 100]
    ranks = [(*r[:4], i + 1) for i, r in enumerate(top)]
    rest = Counter(rows) - Counter(top)
    return sorted(ranks + [(*r[:4], None) for r, n in rest.items() for _ in range(n)], key=str)


def plain(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None, *["x"] * 7) for i, t in rows], DOCS).repartition(4)


def target(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


TARGET = [prose(90, 60), None, "", "Été über 42", prose(91, 30)]


def made(seed, n=300):
    rng = random.Random(seed)
    rows = [(rng.choice([i, i, i, i % 7, None]), prose(seed * 1000 + i % 250, rng.randrange(60))) for i in range(n)]
    return rows + [(None, "same words again " * 9)] * 40


@pytest.mark.parametrize("how", [{}, {"size": 64, "lengths": (1, 3), "least": 5, "percent": 37, "seed": 7}, {"size": 70_000, "lengths": (2, 2)}])
def test_against_brute_force(spark, how):
    rows = made(len(how) + 1)
    names = {"size": "buckets"}
    found = resampling.resample(frame(spark, rows), target(spark, TARGET), **{names.get(k, k): v for k, v in how.items()})
    assert plain(found) == expected(rows, TARGET, **how)


def test_odd_and_empty_tables(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert plain(resampling.resample(odd, target(spark, TARGET))) == expected(rows, TARGET)
    assert plain(resampling.resample(odd, target(spark, []))) == expected(rows, [])
    assert resampling.resample(none, target(spark, TARGET)).count() == 0
    assert {r.rank for r in resampling.resample(frame(spark, [(1, "few words")]), target(spark, [])).collect()} == {None}


def test_crc_of_all_lengths():
    rng = random.Random(3)
    features = [rng.randbytes(rng.choice([0, 1, 1, 2, 3, 7, 8, 40, 500])) for _ in range(3000)]
    assert resampling.crc_matrices(features).tolist() == [zlib.crc32(f) for f in features]


def test_buckets_with_little_memory(monkeypatch):
    monkeypatch.setattr(resampling, "REMEMBERED", 20)
    hasher = resampling.Hasher(97)
    rng = random.Random(4)
    for _ in range(50):
        features = [b"%d" % rng.randrange(60) for _ in range(rng.randrange(40))]
        assert hasher(features).tolist() == [zlib.crc32(f) % 97 for f in features]


def test_runs_across_blocks(monkeypatch):
    monkeypatch.setattr(resampling, "text_blocks", lambda text: resampling_blocks(text, 40))
    text = prose(5, 300)
    for lengths in ((1, 1), (1, 2), (2, 4), (3, 3)):
        found = Counter(f for _, features in resampling.runs(text.encode(), *lengths) for f in features)
        w = words(text)
        assert found == Counter(" ".join(w[i : i + n]).encode() for n in range(lengths[0], lengths[1] + 1) for i in range(len(w) - n + 1))


def resampling_blocks(text, size):
    from opinara.llm.common import text_blocks

    return text_blocks(text, size)


def test_documents_like_the_target_are_drawn(spark):
    target_words = "alpha beta gamma delta epsilon zeta".split()
    rng = random.Random(6)
    near = [(i, " ".join(rng.choice(target_words) for _ in range(40))) for i in range(20)]
    far = [(100 + i, prose(600 + i, 40)) for i in range(180)]
    found = resampling.resample(frame(spark, near + far), target(spark, [" ".join(target_words * 400)]), buckets=1000)
    ranked = [r.doc_id for r in found.filter("rank is not null").collect()]
    assert len(ranked) == 20 and sum(i < 100 for i in ranked) >= 12
