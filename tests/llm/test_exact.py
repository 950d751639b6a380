from __future__ import annotations

import hashlib
import random
from collections import defaultdict

from llm_cases import DOCS, ODD, REPEATED, documents, one_each

from opinara.llm import exact
from opinara.llm.exact import CuckooIndex, drop_duplicates, exact_duplicates


def digest(text):
    return hashlib.sha256((text or "").encode().lower()).hexdigest()


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[digest(text)].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[digest(text)]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep, digest(text)))
    return sorted(out, key=str)


def test_against_brute_force(odd):
    assert sorted(map(tuple, exact_duplicates(odd).drop("row_hash").collect()), key=str) == expected(ODD)


def test_an_index_given_out_early_changes_nothing(odd, monkeypatch):
    monkeypatch.setattr(exact, "LIVE_ROWS", 2)
    assert sorted(map(tuple, exact_duplicates(odd).drop("row_hash").collect()), key=str) == expected(ODD)


def test_empty_table(none):
    assert exact_duplicates(none).count() == 0
    assert drop_duplicates(none).count() == 0


def test_dropping_keeps_one_row_of_each_group(spark):
    rows = ODD + REPEATED
    kept = drop_duplicates(documents(spark, rows).repartition(5))
    assert kept.schema == DOCS
    want = one_each(rows, digest, max)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)


def test_index_grows_and_deletes():
    index, rng = CuckooIndex(2), random.Random(1)
    digests = [rng.randbytes(32) for _ in range(3000)]
    for i, d in enumerate(digests):
        index.add(d, i, 1)
    assert index.resized > 0 and index.size == 3000
    assert all(index.find(d) for d in digests)
    for d in digests[::2]:
        assert index.delete(d)[0] == d
    assert [index.find(d) is None for d in digests] == [i % 2 == 0 for i in range(3000)]
    assert index.delete(digests[0]) is None
    assert index.size == 1500


def test_equal_fingerprints_are_told_apart():
    index = CuckooIndex()
    first, second = b"\x01" * 32, b"\x01" * 31 + b"\x02"
    index.add(first, 5, 1)
    index.add(second, 7, 1)
    index.add(first, 3, 1)
    assert sorted(map(tuple, index)) == [(first, 5, 2), (second, 7, 1)]
