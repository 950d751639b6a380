from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_cases import ODD, documents, prose
from tokenizers import Tokenizer

from opinara.llm.packing import Deal, pack, piece_encoder, sequences
from opinara.llm.pieces import PieceEncoder, forget_pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_pieces_spell_as_the_library(tokenizer):
    rng = random.Random(31)
    texts = [t or "" for _, t in ODD] + ["a\n\nb  c \t d\n", "\n\n", "  x", "it's\n\n'tis", "tab\there "] + ["".join(rng.choices("ab é\n\t 9.'s \u3000\x85\x1c\u180e", k=40)) for _ in range(500)]
    for text, packed in zip(texts, piece_encoder(PATH).encode(texts), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == ids_of(tokenizer, text)[:-1]


def test_words_of_latin_letters_spell_as_the_library(tokenizer):
    letters = [chr(c) for c in range(0x41, 0x251) if chr(c).isalpha()]
    rng = random.Random(32)
    texts = letters + [" ".join("".join(rng.choices(letters, k=rng.randrange(1, 9))) for _ in range(30)) + ".\n" for _ in range(200)]
    for text, packed in zip(texts, piece_encoder(PATH).encode(texts), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == ids_of(tokenizer, text)[:-1]


def test_a_piece_is_spelled_once():
    asked = Counter()

    def spell(text):
        asked[text] += 1
        return text.encode()

    encoder = PieceEncoder(spell, str.encode)
    texts = ["one two, two", "two one\none, two. two"]
    assert encoder.encode(texts) == [t.encode() for t in texts]
    assert encoder.encode(texts * 2) == [t.encode() for t in texts * 2]
    assert max(asked.values()) == 1
    assert {"one", " two", "two", " one", ",", "."} <= set(asked)


def test_a_worker_forgets_its_pieces():
    encoder = piece_encoder(PATH)
    texts = ["some words, more words\n", "others"]
    before = encoder.encode(texts)
    forget_pieces()
    assert not any((*m, *m.old) for m in (encoder.words, encoder.signs, encoder.loose))
    assert encoder.encode(texts) == before


@pytest.mark.parametrize("targets", [None, {"src0": 1, "src1": 7, "src2": 2}])
def test_every_id_in_exactly_one_place(spark, tokenizer, targets):
    rows = [(i, prose(i, 30 + 37 * (i % 23))) for i in range(150)] + [(1000, prose(50, 9000)), (1001, ""), (1002, None)]
    found = pack(documents(spark, rows).repartition(4), PATH, targets, with_ids=True)
    pieces = found.collect()
    windows, texts = defaultdict(list), defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append(p)
        texts[p.doc_id].append(p)
        assert p.length == len(p.ids)
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
    for i, text in rows:
        own = sorted(texts[i], key=lambda p: p.start)
        assert [p.start for p in own] == list(np.cumsum([0] + [p.length for p in own])[:-1])
        assert sum((p.ids for p in own), []) == ids_of(tokenizer, text)
        assert {p.doc_tokens for p in own} == {len(ids_of(tokenizer, text))}
    assert sorted(windows) == list(range(len(windows)))
    for number, parts in windows.items():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == list(np.cumsum([0] + [p.length for p in parts])[:-1])
        assert sum(p.length for p in parts) == 2048 or number == len(windows) - 1
    whole = {r.sequence_id: r.ids for r in sequences(found.hint("x")).collect()} if targets is None else {}
    for number, ids in whole.items():
        assert len(ids) == sum(p.length for p in windows[number])


def test_odd_rows(odd, none, tokenizer):
    found = pack(odd, PATH).collect()
    want = Counter()
    for i, t in ODD:
        want[i] += len(ids_of(tokenizer, t))
    got = Counter()
    for p in found:
        got[p.doc_id] += p.length
    assert got == want
    assert pack(none, PATH).count() == 0


def simulated(totals, weights, length, quantum):
    """Deficit round-robin step by step: queue and token of every place in the stream."""
    credit, dealt, out = [0] * len(totals), [0] * len(totals), []
    while len(out) < sum(totals):
        for q, total in enumerate(totals):
            credit[q] += length * weights[q]
            while credit[q] >= quantum * sum(weights):
                credit[q] -= quantum * sum(weights)
                step = min(quantum, total - dealt[q])
                out += [(q, dealt[q] + i) for i in range(step)]
                dealt[q] += step
    return out


@pytest.mark.parametrize("seed", range(30))
def test_places_against_a_simulation(seed):
    rng = random.Random(seed)
    totals = [rng.randrange(1, 400) for _ in range(rng.randrange(1, 6))]
    weights = totals if seed % 2 else [rng.randrange(1, 9) for _ in totals]
    quantum = rng.choice([1, 4, 7, 16])
    length = quantum * rng.randrange(1, 5)
    want = {item: place for place, item in enumerate(simulated(totals, weights, length, quantum))}
    made = Deal(totals, weights, length, quantum)
    for q, total in enumerate(totals):
        at = 0
        while at < total:
            size = min(rng.randrange(1, 40), total - at)
            upto = 0
            for a, b, place in made.pieces(q, at, size):
                assert a == upto and place // length == (place + b - a - 1) // length
                assert [want[q, at + i] for i in range(a, b)] == list(range(place, place + b - a))
                upto = b
            assert upto == size
            at += size


def test_proportions_hold_in_every_stretch():
    totals = [600_000, 300_000, 100_000]
    made = Deal(totals, totals)
    shares = defaultdict(Counter)
    for q, total in enumerate(totals):
        for a, b, place in made.pieces(q, 0, total):
            shares[place // (8 * 2048)][q] += b - a
    for number, got in shares.items():
        if number < len(shares) - 1:
            for q, total in enumerate(totals):
                assert abs(got[q] - 8 * 2048 * total / 1_000_000) <= 2 * 256 + 2048 * total / 1_000_000
