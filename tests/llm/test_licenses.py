from __future__ import annotations

import random
import re

import pytest
from llm_cases import ODD

from opinara.llm.licenses import BASE, FREEDOM, NOTICES, evaluate, license_scan, postfix, scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in BASE.items():
        parts = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_in_random_texts():
    rng = random.Random(21)
    words = ["mit", "MIT", "license", "License.", "apache", "general", "public", "x-mit", "é", "—", "lesser"]
    for _ in range(500):
        text = rng.choice([" ", "\n", ", "]).join(rng.choices(words, k=rng.randrange(40)))
        assert scan(text.encode())[:5] == base(text)


def test_query_form(odd, none):
    found = license_scan(odd)
    assert sorted((tuple(r)[:6] for r in found.collect()), key=str) == sorted(((i, *base(t)) for i, t in ODD), key=str)
    assert all(0 <= r.score <= 1 for r in found.collect())
    assert license_scan(none).count() == 0


@pytest.mark.parametrize(
    ("text", "items", "freedom", "labels"),
    [
        ("MIT", ["MIT"], 0.95, {"mit"}),
        ("MIT OR GPL-2.0-only AND Apache-2.0", ["MIT", "GPL-2.0-only", "Apache-2.0", "AND", "OR"], 0.95, {"mit", "gpl", "apache"}),
        ("(MIT or GPL-2.0+) and BSD-3-Clause */", ["MIT", "GPL-2.0+", "OR", "BSD-3-Clause", "AND"], 0.9, {"mit", "gpl", "bsd"}),
        ("GPL-3.0-only WITH Classpath-exception-2.0", ["GPL-3.0-only", "Classpath-exception-2.0", "WITH"], 0.5, {"gpl"}),
        ("MIT AND", ["MIT"], 0.95, {"mit"}),
        ("((MIT)", ["MIT"], 0.95, {"mit"}),
        ("Own-1.0 some words", ["Own-1.0"], 0.5, {"own-1.0"}),
        ("AND MIT", [], 1.0, set()),
        ("MIT and see the file", ["MIT"], 0.95, {"mit"}),
        ("Apache-2.0 or later versions", ["Apache-2.0"], 0.9, {"apache"}),
        ("MIT or (ISC and zlib)", ["MIT", "ISC", "zlib", "AND", "OR"], 0.95, {"mit", "isc", "zlib"}),
        ("gpl-2.0 with Classpath-exception-2.0", ["gpl-2.0", "Classpath-exception-2.0", "WITH"], 0.5, {"gpl"}),
        ("gpl-2.0 with thanks", ["gpl-2.0"], 0.3, {"gpl"}),
        ("(MIT OR\nApache-2.0)\nOR GPL-2.0", ["MIT", "Apache-2.0", "OR"], 0.95, {"mit", "apache"}),
        ("(MIT OR\r\n  # Apache-2.0) AND\nISC", ["MIT", "Apache-2.0", "OR"], 0.95, {"mit", "apache"}),
        ("(MIT or\n * apache-2.0)", ["MIT", "apache-2.0", "OR"], 0.95, {"mit", "apache"}),
        ("MIT or", ["MIT"], 0.95, {"mit"}),
        ("(MIT\n" + "\n" * 100_000 + "and", ["MIT"], 0.95, {"mit"}),
    ],
)
def test_expressions(text, items, freedom, labels):
    assert postfix(text, 0) == items
    assert evaluate(items) == (freedom, labels)


def test_tags_and_notices_add_labels():
    text = "# SPDX-License-Identifier: Apache-2.0 OR MIT\nReleased under the MIT License.\nAll rights reserved."
    found = scan(text.encode())
    assert found[4:] == ("mit", "apache,mit,proprietary", 0.05)
    assert scan(b"")[1:] == (0, None, None, "", "", 0.0)


@pytest.mark.parametrize(
    ("text", "base_labels", "labels", "score"),
    [
        (b"the lesser general public license", "gpl", "gpl,lgpl", 0.5),
        (b"the affero general public license", "gpl", "agpl,gpl", 0.2),
        (b"lesser general public license, general public license", "gpl", "gpl,lgpl", 0.3),
        (b"licensed under CC BY-NC", "", "cc-by-nc", 0.1),
        (b"licensed under CC BY", "", "cc-by", 0.85),
        (b"mit license apache license", "apache,mit", "apache,mit", 0.9),
        (b"SPDX-License-Identifier: MIT and see the file", "", "mit", 0.95),
    ],
)
def test_the_longest_phrase_scores(text, base_labels, labels, score):
    assert scan(text)[4:] == (base_labels, labels, score)


def added(text):
    """Labels and score of phrases alone, from every pair of places."""
    words = WORD.findall(text.lower())
    spans = []
    for phrase, label in {**BASE, **NOTICES}.items():
        parts = phrase.split()
        spans += [(i, i + len(parts), label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    kept = [
        label
        for begin, end, label in spans
        if not any(b <= begin and end <= e and e - b > end - begin for b, e, _ in spans)
    ]
    named = set(kept).union(base(text)[4].split(",")) - {""}
    return ",".join(sorted(named)), min((FREEDOM[label] for label in kept), default=0.0)


def test_added_labels_in_random_texts():
    rng = random.Random(22)
    pool = sorted({w for phrase in {**BASE, **NOTICES} for w in phrase.split()}) + ["word"]
    phrases = [*BASE, *NOTICES]
    for _ in range(1000):
        parts = [rng.choice(phrases) if rng.random() < 0.6 else rng.choice(pool) for _ in range(rng.randrange(12))]
        text = " ".join(parts)
        assert scan(text.encode())[5:] == added(text)
