from __future__ import annotations

import hashlib
import random

import pytest
from llm_cases import DOCS, ODD, documents, prose

from opinara.llm.substrings import factors, remove_substrings, substring_duplicates


def covered(rows):
    """For each row its words and whether each is removed."""
    first = {}
    cut = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in cut:
        for at in range(len(words) - 49):
            if i is not None:
                key = tuple(words[at : at + 50])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, words in cut:
        gone = [False] * len(words)
        for at in range(len(words) - 49):
            if i is not None and first[tuple(words[at : at + 50])] < i:
                gone[at : at + 50] = [True] * 50
        out.append((i, words, gone))
    return out


def expected(rows):
    out = []
    for i, words, gone in covered(rows):
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_against_brute_force(odd):
    assert sorted(map(tuple, substring_duplicates(odd).collect()), key=str) == expected(ODD)


@pytest.mark.parametrize("seed", range(4))
def test_copied_passages_of_any_length(spark, seed):
    """Passages around the least length, at any place, with few distinct words and repeats within a text."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3 if seed == 0 else 500)]
    pool = [rng.choices(words, k=400) for _ in range(4)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(rng.randrange(5)):
            text += rng.choices(words, k=rng.randrange(60))
            source, at = rng.choice(pool), rng.randrange(300)
            text += source[at : at + rng.choice([20, 49, 50, 51, 75, 100])]
        rows.append((rng.randrange(40), " ".join(text)))
    found = substring_duplicates(documents(spark, rows))
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows)


def test_factors():
    assert factors([(5, 60), (60, 110), (0, 50), (200, 250)]) == [(0, 110), (200, 250)]
    assert factors([(0, 20)]) == []


def test_empty_table(none):
    assert substring_duplicates(none).count() == 0
    assert remove_substrings(none).count() == 0


def test_removal_keeps_other_columns_and_untouched_texts(spark):
    rows = [*ODD, (30, prose(9, 10) + "\n\n" + prose(3, 200))]
    made = remove_substrings(documents(spark, rows))
    assert made.schema == DOCS
    want = []
    for (i, text), (_, words, gone) in zip(rows, covered(rows), strict=True):
        if any(gone):
            text = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        want.append((i, text, None if text is None else len(text)))
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in made.collect()), key=str) == sorted(want, key=str)
