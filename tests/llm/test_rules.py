from __future__ import annotations

import random
import re
from collections import Counter

from llm_cases import DOCS, ODD
from plan_text import plan

from opinara.llm import rules
from opinara.llm.rules import Cascade, Text, quality_filter, quality_report, repeated_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def test_counts_against_brute_force(odd):
    found = quality_report(odd).collect()
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found), key=str)
    assert got == sorted(((i, *counts(t)) for i, t in ODD), key=str)
    for r in found:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_repeated_words_in_random_texts():
    rng = random.Random(11)
    for _ in range(300):
        words = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randrange(60))]
        assert repeated_words(words) == counts(b" ".join(words).decode())[4]


def texts(n=400):
    rng = random.Random(12)
    kinds = ["plain words of a text. " * 9, "a b c #### $$$$ " * 20, "SHOUTED TEXT OF MANY WORDS. " * 7, "12345 67890 " * 30]
    return [(rng.choice(kinds) + " ".join(str(rng.random()) for _ in range(rng.randrange(30)))).encode() for _ in range(n)]


def test_verdict_does_not_depend_on_the_order():
    given = texts()
    plain = [not any(rule(Text(t)) for rule in rules.RULES) for t in given]
    for seed in range(3):
        order = random.Random(seed).sample(rules.RULES, len(rules.RULES))
        cascade = Cascade(tuple(order))
        assert [cascade.keeps(Text(t)) for t in given] == plain


def test_cascade_orders_by_rejections_per_cost_and_stops_early():
    calls = Counter()

    def rule(name, rejects):
        def run(text):
            calls[name] += 1
            sum(range(20_000 if name == "dear" else 10))
            return rejects(text)

        return run

    never, dear, cheap = (rule(n, f) for n, f in (("never", lambda t: False), ("dear", lambda t: True), ("cheap", lambda t: True)))
    cascade = Cascade((never, dear, cheap), sample=10)
    for t in texts(110):
        assert not cascade.keeps(Text(t))
    assert cascade.rules[0] is cheap and cascade.rules[-1] is never
    assert calls == {"never": 10, "dear": 10, "cheap": 110}


def test_filter_keeps_all_columns(odd, none):
    kept = quality_filter(odd)
    assert kept.schema == DOCS
    want = [(i, t) for i, t in ODD if not any(rule(Text((t or "").encode())) for rule in rules.RULES)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)
    assert quality_filter(none).count() == quality_report(none).count() == 0


def test_filter_sends_each_text_once(odd):
    assert "coalesce(" not in plan(quality_filter(odd))
    assert quality_filter(odd.withColumnRenamed("text", "Body"), "body").count() == quality_filter(odd).count()
