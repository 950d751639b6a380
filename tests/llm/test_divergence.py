from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from llm_cases import DOCS, documents

from opinara.llm import divergence, transducer
from opinara.llm.common import stored

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def expected(rows, least=3, listed=200):
    """By the rule, with plain loops over every kept term."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, found = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        words = TERM.findall((text or "").translate(lower))
        counts[lang or "", source or ""].update(words)
        found[lang or ""].update(set(words))
    out = []
    for lang, source in counts:
        kept = [t for t, n in found[lang].items() if n >= least]
        v = len(kept)
        sources = [s for a, s in counts if a == lang]

        def share(n, total, v=v):
            return 1 + 10**9 * (n + 1) // (total + v)

        def shares(count, kept=kept, share=share):
            total = sum(count[t] for t in kept)
            return {t: share(count[t], total) for t in kept}

        ours = counts[lang, source]
        p = shares(ours)
        pairs = []
        for other in sources:
            if other != source:
                q = shares(counts[lang, other])
                pairs.append((-sum((p[t] - q[t]) ** 2 // q[t] for t in kept), other.encode()))
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        terms = [(-((p[t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if ours[t] and p[t] > q[t]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:listed])):
            out += [(lang, source, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(items)]
    return sorted(out)


def made(seed: int, n: int = 120):
    rng = random.Random(seed)
    words = ["the", "The", "of", "été", "x", "naïve", "über", "东京", "z" * 300, "z" * 256, "z" * 256 + "a", "foo", "bar", "baz", "qux"]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "fr", "", None, "en\0fr", "rare" + str(i % 40)])
        source = rng.choice(["a", "a", "a", "b", "ç", "", None])
        text = " ".join(rng.choice(words[: rng.randrange(1, len(words) + 1)]) + rng.choice(["", "", ",", "1", "-q"]) for _ in range(rng.randrange(30)))
        rows.append((lang, source, rng.choice([text, text, text, text, None, ""])))
    return rows + rows[:7]


def result(spark, rows, **how):
    filled = [(i, t, lang, source, None, *["x"] * 7) for i, (lang, source, t) in enumerate(rows)]
    return divergence.divergence(spark.createDataFrame(filled, DOCS).repartition(5), **how)


def plain(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = made(seed)
    found = plain(result(spark, rows))
    assert found == expected(rows)
    assert any(r[2] == "term" for r in found)


def test_terms_that_travel_to_many_small_blocks(spark):
    rows = made(3)
    assert plain(result(spark, rows, broadcast=0, block=4, listed=3)) == expected(rows, listed=3)


def test_small_memory(spark, monkeypatch):
    monkeypatch.setattr(divergence, "COUNTED", 3)
    rows = [(lang or "", source or "", (t or "").encode()) for lang, source, t in made(4)]
    sums = Counter()
    for lang, words, counts in divergence._counted(rows):
        for source, (numbers, n) in counts.items():
            for i, k in zip(numbers.tolist(), n.tolist(), strict=True):
                sums[(lang, source), words[i]] += k
    whole = Counter()
    for lang, source, t in rows:
        for words in divergence.terms(t):
            whole.update(((lang, source), w) for w in words)
    assert sums == whole


def test_shared_terms_in_pieces(monkeypatch):
    rng = random.Random(5)
    rows = [("en", f"s{s}", o, rng.randrange(1, 10**9), rng.randrange(1, 10**9)) for o in range(40) for s in rng.sample(range(9), rng.randrange(10))]
    want = Counter()
    for a in rows:
        for b in rows:
            if a[2] == b[2] and a[1] != b[1]:
                f = lambda p, q: (p - q) ** 2 // q
                want[a[1], b[1]] += f(a[3], b[3]) - f(a[3], b[4]) - f(a[4], b[3]) + f(a[4], b[4])
    monkeypatch.setattr(divergence, "PAIRS", 5)
    got = Counter()
    table = pa.Table.from_pylist([dict(zip(("lang", "source", "ordinal", "p", "z"), r, strict=True)) for r in rows])
    for batch in divergence.shared_terms(table.to_batches(max_chunksize=7)):
        for r in batch.to_pylist():
            got[r["source"], r["item"]] += r["more"]
    assert got == want


def test_odd_and_empty_tables(spark, odd, none):
    rows = [(r.lang, r.source, r.text) for r in odd.collect()]
    assert plain(divergence.divergence(odd)) == expected(rows)
    assert divergence.divergence(none).count() == 0
    assert {r.value for r in result(spark, [("en", s, "1 2 3") for s in "abc"]).collect()} == {0}


def test_transducer_finds_every_string_and_no_other():
    rng = random.Random(6)
    alphabet = b"abc\xc3\xa9"
    for trial in range(100):
        strings = {bytes(rng.choice(alphabet) for _ in range(rng.randrange(6))) for _ in range(rng.randrange(150))}
        if trial % 3 == 0:
            strings |= {b"q" * n for n in (255, 256, 300)} | {b"q" * 256 + b"z"}
        ordered = sorted(strings)
        built = transducer.load(transducer.build(ordered).dump())
        probes = ordered + [bytes(rng.choice(b"abcd") for _ in range(rng.randrange(7))) for _ in range(50)] + [b"q" * 257]
        place = {s: i for i, s in enumerate(ordered)}
        assert built.size == len(ordered)
        assert built.ordinals(probes).tolist() == [place.get(p, -1) for p in probes]


def test_transducer_is_minimal():
    built = transducer.build([b"talked", b"talking", b"walked", b"walking"])
    assert (len(built.final), len(built.arcs)) == (9, 10)


def test_ordinals_are_gapless_and_sorted(spark):
    rows = made(7)
    docs = spark.createDataFrame([(lang or "", s or "", (t or "").encode()) for lang, s, t in rows], "lang string, source string, text binary")
    found = divergence.vocabulary(stored(docs, "v")).orderBy("ordinal").collect()
    assert [r.ordinal for r in found] == list(range(len(found)))
    assert [r.key for r in found] == sorted(r.key for r in found)
