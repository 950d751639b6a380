from __future__ import annotations

import random

import pytest
import xxhash
from llm_cases import DOCS, ODD, REPEATED, documents, one_each, prose

from opinara.llm.graph import components
from opinara.llm.simhash import fingerprint, keep_first, links, near_duplicates


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def reach(nodes, near):
    """The smallest name each node can reach, by flooding."""
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if label[a] > label[b] and near(a, b):
                    label[a], changed = label[b], True
    return label


def expected(rows):
    prints = {(i, t): plain_fingerprint(t) for i, t in rows}
    values = sorted(set(prints.values()))
    group = reach(values, lambda a, b: (a ^ b).bit_count() <= 2)
    first = {}
    for (i, _), v in prints.items():
        if i is not None:
            first[group[v]] = min(i, first.get(group[v], i))
    return sorted(((i, f"{prints[i, t]:016x}", first.get(group[prints[i, t]])) for i, t in rows), key=str)


def test_fingerprints_in_blocks():
    text = prose(7, 400_000).encode()  # more than one block
    assert fingerprint(text) == plain_fingerprint(text.decode())
    assert fingerprint(b"") == fingerprint(b" \n") == 0
    assert fingerprint(b"One TWO") == xxhash.xxh64_intdigest(b"one two", 42)


@pytest.mark.parametrize("longest", [512, 1])
def test_against_brute_force(spark, longest):
    base = prose(8, 900).split()
    rows = ODD + [(100 + i, " ".join(base[:i] + ["other"] + base[i + 1 :])) for i in range(0, 900, 30)]
    found = near_duplicates(documents(spark, rows), longest=longest)
    assert sorted(map(tuple, found.drop("row_hash").collect()), key=str) == expected(rows)


@pytest.mark.parametrize("longest", [512, 3, 1])
def test_links_connect_all_near_fingerprints(spark, longest):
    rng = random.Random(longest)
    values = {0, 2**64 - 1}
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(rng.randrange(12)):
            values.add(at)
            at ^= 1 << rng.randrange(64) | (1 << rng.randrange(64) if rng.random() < 0.7 else 0)
    signed = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    found = components(links(spark.createDataFrame([(v,) for v in signed], "bits long"), longest)).collect()
    label = {v: v for v in signed} | {r.node: r.label for r in found}
    assert label == reach(signed, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 2)


def test_components_of_a_long_path(spark):
    order = list(range(300))
    random.Random(5).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:], strict=False)) + [(900, 901), (950, 950)], "a long, b long")
    found = {r.node: r.label for r in components(edges).collect()}
    assert found == dict.fromkeys(range(300), 0) | {900: 900, 901: 900}


def test_empty_table(none):
    assert near_duplicates(none).count() == 0
    assert keep_first(none).count() == 0


def one_of_each_component(rows):
    prints = {t: plain_fingerprint(t) for _, t in rows}
    component = reach(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    return one_each(rows, lambda t: component[prints[t]], min)


def test_keeping_one_row_of_each_component(spark):
    rows = ODD + REPEATED
    kept = keep_first(documents(spark, rows).repartition(5))
    assert kept.schema == DOCS
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(one_of_each_component(rows), key=str)


def test_members_of_a_long_list_are_not_collected(spark):
    """Stars come from smallest and largest members; a third one is joined."""
    values = [0, 1, 2, 4, 8, 3 << 40, 1 << 50]
    prints = spark.createDataFrame([(v,) for v in values], "bits long")
    found = links(prints, longest=0)
    assert "collect_list" not in found._jdf.queryExecution().toString()
    linked = {(r.a, r.b) for r in found.collect()}
    assert all((a ^ b).bit_count() <= 2 for a, b in linked)
    assert {b for a, b in linked if a == 0} == set(values[1:])
