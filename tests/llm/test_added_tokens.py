from __future__ import annotations

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from opinara.llm.packing import piece_encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_added_tokens_as_the_file_says():
    untouched = Tokenizer.from_file(PATH)
    texts = ["<|endoftext|>", "one two<|endoftext|>\nthree", "a <|endoftext|> b", "<|endoftext| >", "plain words"]
    want = [untouched.encode(t, add_special_tokens=False).ids for t in texts]
    assert any(50256 in ids for ids in want)
    assert [np.frombuffer(p, "<u4").tolist() for p in piece_encoder(PATH).encode(texts)] == want
