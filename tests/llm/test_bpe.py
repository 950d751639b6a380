from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import LONG, ODD

from opinara.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(PATH, public_tokenizers.PATTERN)


TEXTS = ["a" * 20_000, "ab" * 9_000 + "c", "x<|endoftext|> y", "  two  spaces ", "\n\n", "it's \t we'll", "日本語" * 500, LONG]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_and_round_trip(reference, codec, text):
    ids = codec.encode(text)
    assert ids == reference.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()
    assert codec.queue.top == 0 and not codec.queue.buckets


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeéüñ漢 \n\t\r  '19.,!?s \x1c\x85\U0001f600"), max_size=60))
def test_any_text_piece_by_piece(reference, codec, text):
    (packed,) = codec.pieces.encode([text])
    assert [int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4)] == reference.encode_ordinary(text)


def test_queue_gives_lowest_rank_then_leftmost():
    rng, queue = random.Random(3), bpe.RankQueue(50_000)
    wanted = sorted((rng.choice([0, 255, 256, 65, 49_999, rng.randrange(50_000)]), rng.randrange(1000)) for _ in range(500))
    for item in rng.sample(wanted, len(wanted)):
        queue.push(*item)
    assert [queue.pop() for _ in wanted] == wanted
    assert queue.top == 0


def test_query_form(odd, reference):
    def row(doc_id, text):
        ids = reference.encode_ordinary(text or "")
        spelled = " ".join(map(str, ids)).encode()
        return doc_id, len(ids), hashlib.sha256(spelled).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    found = bpe.digests(odd, PATH, public_tokenizers.PATTERN)
    assert sorted(map(tuple, found.collect()), key=str) == sorted((row(*r) for r in ODD), key=str)


def test_encode_then_decode(odd, none):
    ids = bpe.encode(odd, PATH, public_tokenizers.PATTERN)
    found = bpe.decode(ids, PATH, public_tokenizers.PATTERN).collect()
    assert sorted(((r.doc_id, bytes(r.decoded).decode()) for r in found), key=str) == sorted(((i, t or "") for i, t in ODD), key=str)
    assert bpe.encode(none, PATH, public_tokenizers.PATTERN).count() == 0
