"""Byte-level BPE encoding and decoding.

Method. A match of the split pattern starts as a linked list of its bytes. Every
neighbouring pair that the vocabulary knows waits in the bucket of its rank. The
buckets' ranks are bits of a hierarchical bitmap, 256 to a word below one word
for the words: find-first-set, once per level, gives the lowest rank in two
steps, however many pairs wait. The leftmost position of that bucket is merged, its new neighbours
are queued, and entries whose pair has changed since are stale and skipped when
met. So a match of n bytes takes about n steps, which matters for very long ones.

On Spark. One pass over the texts, no shuffle; a worker loads the vocabulary
once and remembers words up to a bound.

Defined results. A null text is an empty one: no ids, and the digests of the
empty string. Special tokens' strings are ordinary text. A very long text is
encoded whole. Repeated rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from functools import cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import map_rows
from opinara.llm.pieces import PieceEncoder, encoded

#: Matches that a worker remembers, and the longest it does.
REMEMBERED = 100_000
LONGEST = 64


BIT = [1 << i for i in range(256)]


class RankQueue:
    """Positions by merge rank; the lowest rank first, of a rank the leftmost position.

    Bit ``r % 256`` of ``words[r // 256]`` tells that bucket r holds something, bit w of ``top`` that word w does.
    """

    __slots__ = ("buckets", "top", "words")

    def __init__(self, ranks: int) -> None:
        self.buckets: dict[int, list[int]] = {}
        self.words = [0] * ((ranks >> 8) + 1)
        self.top = 0

    def fill(self, pairs: list[int]) -> None:
        """Push the rank of every position that has one (not -1)."""
        buckets, words, top = self.buckets, self.words, self.top
        for position, rank in enumerate(pairs):
            if rank >= 0:
                if rank in buckets:
                    heappush(buckets[rank], position)
                else:
                    buckets[rank] = [position]
                    w = rank >> 8
                    words[w] |= BIT[rank & 255]
                    top |= 1 << w
        self.top = top

    def push(self, rank: int, position: int) -> None:
        if rank in self.buckets:
            heappush(self.buckets[rank], position)
        else:
            self.buckets[rank] = [position]
            w = rank >> 8
            self.words[w] |= BIT[rank & 255]
            self.top |= 1 << w

    def pop(self) -> tuple[int, int]:
        """The next rank and position, taken out; only while ``top`` is not 0."""
        top = self.top
        w = (top & -top).bit_length() - 1
        word = self.words[w]
        r = (word & -word).bit_length() - 1
        rank = (w << 8) + r
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heappop(bucket)
        del self.buckets[rank]
        word ^= BIT[r]
        self.words[w] = word
        if not word:
            self.top = top & (top - 1)
        return rank, bucket[0]


class Matches(dict):
    """Packed ids of matches of the pattern, worked out when first asked for and remembered up to a bound."""

    def __init__(self, codec: Codec) -> None:
        self.codec = codec

    def __missing__(self, match: str) -> bytes:
        ids = self.codec.merged(match.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(match) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[match] = packed
        return packed


class Codec:
    """Encoder and decoder of one vocabulary of ranks."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.byte_pairs = {(a, b): self.ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)}
        self.decimals = [b"%d" % i for i in range(len(self.tokens))]
        self.split = regex.compile(pattern)
        self.queue = RankQueue(len(self.tokens))
        self.known = Matches(self)
        self.pieces = PieceEncoder(self.pack, self.pack)

    def merged(self, match: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        whole = self.ranks.get(match)
        if whole is not None:
            return [whole]
        rank_of, queue, n = self.ranks.get, self.queue, len(match)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # The rank of the pair that starts at a position; -1: none, or no token starts there any more.
        pair = list(map(self.byte_pairs.__getitem__, zip(match, match[1:], strict=False)))
        pair.append(-1)
        queue.fill(pair)
        # The queue's pop and push, written out: calls would cost more than the work.
        buckets, words, top = queue.buckets, queue.words, queue.top
        while top:
            w = (top & -top).bit_length() - 1
            word = words[w]
            lowest = word & -word
            rank = (w << 8) + lowest.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                word ^= lowest
                words[w] = word
                if not word:
                    top &= top - 1
            if pair[i] != rank:
                continue  # stale
            gone = after[i]
            end = after[i] = after[gone]
            pair[gone] = -1
            found = []
            if end < n:
                before[end] = i
                new = pair[i] = rank_of(match[i : after[end]], -1)
                if new >= 0:
                    found.append((new, i))
            else:
                pair[i] = -1
            left = before[i]
            if left >= 0:
                new = pair[left] = rank_of(match[left:end], -1)
                if new >= 0:
                    found.append((new, left))
            for new, position in found:
                if new in buckets:
                    heappush(buckets[new], position)
                else:
                    buckets[new] = [position]
                    w = new >> 8
                    words[w] |= BIT[new & 255]
                    top |= 1 << w
        queue.top = 0
        ranks = self.ranks
        out, i = [], 0
        while i < n:
            out.append(ranks[match[i : after[i]]])
            i = after[i]
        return out

    def pack(self, text: str) -> bytes:
        """The ids of a text, 4 bytes each, little-endian."""
        if text.lstrip(" ").isalpha() and text[1:2] != " ":
            return self.known[text]  # one match
        return b"".join(map(self.known.__getitem__, self.split.findall(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.pack(text), "<u4").tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@cache
def codec(path: str, pattern: str) -> Codec:
    """Loaded once in each worker."""
    return Codec(path, pattern)


IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
DIGESTS = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long"), F.coalesce(F.col(text), F.lit("")))


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` of every row of ``docs``."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, ids in encoded(rows, codec(path, pattern).pieces):
            yield doc_id, np.frombuffer(ids, "<i4")

    return map_rows(_texts(docs, key, text), run, IDS, "doc_id long, ids array<int>")


def decode(ids: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, decoded`` in bytes, from the result of ``encode``; null ids are none."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, given in rows:
            yield doc_id, codec(path, pattern).decode(given or ())

    schema = pa.schema([("doc_id", pa.int64()), ("decoded", pa.binary())])
    return map_rows(ids.select("doc_id", "ids"), run, schema, "doc_id long, decoded binary")


def digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: every text encoded, and decoded again from its ids."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        made = codec(path, pattern)
        for doc_id, packed in encoded(rows, made.pieces):
            ids = np.frombuffer(packed, "<u4").tolist()
            spelled = b" ".join(map(made.decimals.__getitem__, ids))
            yield doc_id, len(ids), hashlib.sha256(spelled).hexdigest(), hashlib.sha256(made.decode(ids)).hexdigest()

    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_rows(_texts(docs, key, text), run, DIGESTS, ddl)
