"""Small sources: mixed with each other, and dealt by their targets."""

from __future__ import annotations

from collections import Counter, defaultdict

import public_tokenizers
from llm_cases import documents, prose
from pyspark.sql import functions as F

from opinara.llm.packing import pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


def packed(spark, rows, targets=None):
    """Pieces with the source of their document; ``rows`` are (id, source, text)."""
    sources = {i: s for i, s, _ in rows}
    docs = documents(spark, [(i, t) for i, _, t in rows]).drop("source").join(
        spark.createDataFrame(list(sources.items()), "doc_id long, source string"), "doc_id"
    )
    pieces = pack(docs.orderBy(F.col("source")), PATH, targets).collect()
    places, by_doc = Counter(), defaultdict(list)
    for p in pieces:
        at = p.sequence_id * 2048 + p.offset
        places.update(range(at, at + p.length))
        by_doc[p.doc_id].append(p)
    assert set(places) == set(range(sum(places.values())))  # every place is taken once
    for own in by_doc.values():
        own.sort(key=lambda p: p.start)
        assert own[0].start == 0 and sum(p.length for p in own) == own[0].doc_tokens
        assert all(a.start + a.length == b.start for a, b in zip(own, own[1:], strict=False))
    return [(p.sequence_id * 2048 + p.offset, p.length, sources[p.doc_id]) for p in pieces]


def test_small_sources_are_mixed_with_each_other(spark):
    rows = [(10 * s + i, f"s{s:03}", prose(10 * s + i, 150)) for s in range(300) for i in range(6)]
    pieces = packed(spark, rows)
    total, halves = sum(n for _, n, _ in pieces), defaultdict(Counter)
    for at, n, source in pieces:
        halves[2 * at // total][source] += n
    # Each source has half its tokens in each half, to within a block; as one run it would have all in one.
    assert all(abs(halves[0][s] - halves[1][s]) <= 2 * 512 for s in {s for _, s, _ in rows})
    assert sum(halves[0][s] > 0 and halves[1][s] > 0 for s in halves[0]) > 290


def test_a_target_for_a_small_source_holds(spark):
    rows = [(i, "large", prose(i, 1500)) for i in range(150)] + [(1000, "rare", prose(1000, 500)), (1001, "other", prose(1001, 500))]
    pieces = packed(spark, rows, {"large": 1, "rare": 1})
    total = sum(n for _, n, s in pieces if s == "rare")
    last = max(at + n for at, n, s in pieces if s == "rare")
    assert total * 256 < sum(n for _, n, _ in pieces)
    assert last <= 3 * total + 3 * 2048  # a third of each window until it has run dry
