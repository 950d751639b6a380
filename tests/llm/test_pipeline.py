"""The stages against brute force, each on its own input."""

from __future__ import annotations

from collections import defaultdict

import corpus_pipeline
import public_tokenizers
import pytest
from llm_cases import DOCS, ODD, REPEATED, documents, one_each, prose
from test_simhash import one_of_each_component
from test_substrings import covered
from tokenizers import Tokenizer

from opinara.llm import rules
from opinara.llm.common import stored

BASE = prose(61, 800).split()
ROWS = [
    *ODD,
    *REPEATED,
    *[(200 + i, " ".join(BASE[:i] + ["changed"] + BASE[i + 1 :])) for i in range(0, 800, 50)],
    *[(300 + i, prose(70 + i, 60) + " " + prose(62, 55 + i)) for i in range(5)],
]


def brute(rows):
    rows = [(i, t) for i, t in rows if not any(rule(rules.Text((t or "").encode())) for rule in rules.RULES)]
    rows = one_of_each_component(one_each(rows, lambda t: t.encode().lower(), max))
    out = []
    for (i, t), (_, words, gone) in zip(rows, covered(rows), strict=True):
        if any(gone):
            t = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        out.append((i, t))
    return out


def test_all_stages(spark):
    docs = documents(spark, ROWS).repartition(3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, None), name)
        assert docs.schema == DOCS
    kept = brute(ROWS)
    assert 0 < len(kept) < len(ROWS)
    assert sorted(((r.doc_id, r.text) for r in docs.collect()), key=str) == sorted(kept, key=str)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, None).collect()
    got, places = defaultdict(int), set()
    for p in pieces:
        got[p.doc_id] += p.length
        places |= {(p.sequence_id, p.offset + i) for i in range(p.length)}
    want = defaultdict(int)
    for i, t in kept:
        want[i] += len(tokenizer.encode(t, add_special_tokens=False).ids) + 1
    assert got == want  # a repeated row is packed once
    assert len(places) == sum(got.values())


def test_stages_pass_an_empty_table(spark, none):
    docs = none
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, None), name)
        assert docs.count() == 0


def test_run(spark, small):
    found = corpus_pipeline.run(spark, small)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert found.count() > 0


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_names(name):
    assert name in ("quality_rules", "exact_dedup", "near_dedup", "substring_dedup", "packing")
