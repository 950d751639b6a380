"""Removal of long passages that an earlier document already holds, by blocks and windows.

Method. Joins of blocks and windows stand in for the greedy factors of a relative
Lempel-Ziv parse: no place in the reference is carried. Every document is
compared with the documents with smaller ids, the reference. The reference is indexed by blocks cut by content: of the word
10-grams of every window of 50 words the one with the smallest hash is its
anchor, and the consecutive windows that share an anchor form a block, about 70
words long. A passage that occurs in two documents is cut into the same blocks
in both, save at its ends. Adjacent blocks found in the reference form stretches.
At the ends of stretches, where a copied passage begins or stops inside a block, it
checks word by word: it looks up each window of the blocks in question among the
windows of the reference's blocks with the same anchor. Stretches of at least 50
words become duplicate spans.

That is exact. If a window of 50 words also starts in an earlier document, take
the earliest one: there its block cannot itself be found in the reference, and
the window has the same anchor in both. So it is enough to compare windows of
blocks that are not found whole, and whose anchor occurs in several documents.

On Spark. The texts are read once for blocks (one row in about 21 words, with
hashes of 8 and 16 bytes) and only documents with something to check or remove
are read again, joined by document. Blocks, anchors and windows are grouped by
hash with partial sums, and rows meet their group in a join whose hot keys
adaptive execution splits; the blocks of copies after the first are settled by
block and add no windows, however many there are.

Defined results. A null text has no words. A document with a null id is neither
changed nor part of the reference. Rows that repeat an id do not remove from
each other; each is parsed on its own. Fewer than 50 words: nothing is removed.
A very long text is judged whole; its task holds all its words at once. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import fresh, map_rows, on_workers, row_hash, slices, stored, utf8

WINDOW = 50
GRAM = 10
#: Words whose hashes a worker remembers.
REMEMBERED = 1 << 17


class WordHashes(dict):
    """Hash of a word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


HASHES = WordHashes()


def anchors(words: list[bytes], window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each block its first window, the start of its last window plus one, and its anchor's hash."""
    hashes = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    n = len(words) - gram + 1
    grams = np.zeros(n, np.uint64)
    for i in range(gram):
        grams *= np.uint64(0x9E3779B97F4A7C15)
        grams += hashes[i : i + n]
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(32)
    # The high half decides, then the place: the leftmost of equal ones.
    smallest = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    span, width = window - gram + 1, 1
    while 2 * width <= span:
        smallest = np.minimum(smallest[:-width], smallest[width:])
        width *= 2
    if width < span:
        smallest = np.minimum(smallest[: width - span], smallest[span - width :])
    place = (smallest & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return first, np.r_[first[1:], len(place)], grams[place[first]]


def word_starts(words: list[bytes]) -> np.ndarray:
    """Where each word starts in the words joined by one space, and the end of it plus one."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    return np.r_[0, np.cumsum(lengths)]


def _blocks(rows: Iterable[tuple]) -> Iterator[tuple]:
    for doc_id, row, text in rows:
        words = text.split()
        if len(words) < WINDOW or doc_id is None:
            continue
        joined, at = b" ".join(words), word_starts(words)
        first, end, anchor = anchors(words)
        starts, stops = at[first].tolist(), (at[end + WINDOW - 1] - 1).tolist()
        for a, b, g, s, e in zip(first.tolist(), end.tolist(), anchor.view(np.int64).tolist(), starts, stops, strict=True):
            yield doc_id, row, a, b, g, xxhash.xxh3_128_digest(joined[s:e])


BLOCKS = pa.schema(
    [("doc_id", pa.int64()), ("row_hash", pa.int64()), ("first", pa.int64()), ("end", pa.int64())]
    + [("anchor", pa.int64()), ("block", pa.binary())]
)


def _windows(rows: Iterable[tuple]) -> Iterator[tuple]:
    for doc_id, row, places, text in rows:
        words = text.split()
        joined, at = b" ".join(words), word_starts(words).tolist()
        # A row that occurs several times has each of its blocks as often.
        for first, end in sorted({(p["first"], p["end"]) for p in places}):
            for i in range(first, end):
                yield doc_id, row, i, xxhash.xxh3_128_digest(joined[at[i] : at[i + WINDOW] - 1])


WINDOWS = pa.schema([("doc_id", pa.int64()), ("row_hash", pa.int64()), ("first", pa.int64()), ("window", pa.binary())])


def factors(pieces: Iterable[tuple[int, int]], least: int = WINDOW) -> list[tuple[int, int]]:
    """Maximal factors ``(start, end)`` in words, made greedily from left to right of found pieces."""
    out: list[list[int]] = []
    for start, end in sorted(pieces):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out if b - a >= least]


def cut(words: list[bytes], spans: list[tuple[int, int]]) -> list[bytes]:
    """The words outside the spans."""
    kept, at = [], 0
    for start, end in spans:
        kept += words[at:start]
        at = end
    return kept + words[at:]


def duplicate_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, row_hash, pieces``: of each row with something to remove, the windows' places ``(first, end)``.

    A piece covers the words from ``first`` to ``end``, ``end`` not included. One list is bounded by its text.
    """
    base = docs.select(F.col(key).cast("long").alias("doc_id"), row_hash(text).alias("row_hash"), utf8(text).alias("utf8"))
    blocks = stored(
        map_rows(base, _blocks, BLOCKS, "doc_id long, row_hash long, first long, end long, anchor long, block binary"),
        "blocks",
    )
    several = F.col("first_id") < F.col("last_id")
    ids = (F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    known = stored(blocks.groupBy("block").agg(*ids).filter(several).select("block", "first_id"), "known-blocks")
    judged = blocks.join(known, "block", "left")
    judged = judged.withColumn("found", F.coalesce(F.col("first_id") < F.col("doc_id"), F.lit(False)))
    judged = stored(judged.select("doc_id", "row_hash", "first", "end", "anchor", "found"), "judged-blocks")

    open_blocks = judged.filter("not found")
    shared = open_blocks.groupBy("anchor").agg(*ids).filter(several).select("anchor")
    shared = stored(shared, "shared-anchors")
    checked = open_blocks.join(shared, "anchor", "left_semi")
    checked = checked.groupBy("doc_id", "row_hash").agg(F.collect_list(F.struct("first", "end")).alias("places"))
    checked = stored(checked, "places")
    # The texts stay on the streamed side of a hash join: they are neither sorted nor held.
    read = base.join(checked.hint("shuffle_hash"), ["doc_id", "row_hash"]).select("doc_id", "row_hash", "places", "utf8")
    windows = stored(
        map_rows(read, _windows, WINDOWS, "doc_id long, row_hash long, first long, window binary"), "windows"
    )
    known = stored(windows.groupBy("window").agg(*ids).filter(several).select("window", "first_id"), "known-windows")
    copied = windows.join(known, "window").filter(F.col("first_id") < F.col("doc_id"))

    found = judged.filter("found").select("doc_id", "row_hash", "first", (F.col("end") + WINDOW - 1).alias("end"))
    found = found.union(copied.select("doc_id", "row_hash", "first", (F.col("first") + WINDOW).alias("end")))
    pieces = found.groupBy("doc_id", "row_hash").agg(F.collect_list(F.struct("first", "end")).alias("pieces"))
    return stored(pieces, "pieces")


def _kept(rows: Iterable[tuple]) -> Iterator[tuple]:
    for doc_id, text, pieces in rows:
        words = text.split()
        spans = factors((p["first"], p["end"]) for p in pieces or ())
        digest = hashlib.sha256(b" ".join(cut(words, spans))).hexdigest()
        yield doc_id, len(words), sum(b - a for a, b in spans), digest


KEPT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
)


def with_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with each row's pieces, null where there are none, and that column's name."""
    pieces, name = duplicate_spans(docs, key, text), fresh(docs, "pieces")
    pieces = pieces.select(F.col("doc_id").alias("span_id"), F.col("row_hash").alias("span_hash"), F.col("pieces").alias(name))
    same = (docs[key].cast("long") == pieces["span_id"]) & (row_hash(text) == pieces["span_hash"])
    joined = docs.join(pieces.hint("shuffle_hash"), same, "left")
    return joined.select(*[docs[c] for c in docs.columns], pieces[name]), name


def substring_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row of ``docs``."""
    base = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    joined, pieces = with_pieces(base)
    return map_rows(
        joined.select("doc_id", utf8("text"), pieces), _kept, KEPT, "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )


def remove_substrings(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` without the duplicate spans, all columns kept.

    A text that loses words becomes its other words joined by one space, and its ``length`` follows; all else stays.
    """
    joined, name = with_pieces(docs, text=text)
    extra = fresh(joined, "utf8")
    columns, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            texts, lengths = batch.column(text).to_pylist(), None
            if length in columns:
                lengths = batch.column(length).to_pylist()
            found = zip(batch.column(extra).to_pylist(), batch.column(name).to_pylist(), strict=True)
            for i, (utf, pieces) in enumerate(found):
                spans = factors((p["first"], p["end"]) for p in pieces or ())
                if spans:
                    texts[i] = b" ".join(cut(utf.split(), spans)).decode()
                    if lengths:
                        lengths[i] = len(texts[i])
            arrays = {c: batch.column(c) for c in columns}
            arrays[text] = pa.array(texts, batch.schema.field(text).type)
            if lengths is not None:
                arrays[length] = pa.array(lengths, batch.schema.field(length).type)
            yield pa.RecordBatch.from_arrays([arrays[c] for c in columns], names=columns)

    return on_workers(joined.withColumn(extra, utf8(text))).mapInArrow(run, schema)


SUBSTRINGS_SQL = """
with w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words from documents),
windows as (
  select doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) as win
  from (select doc_id, words, unnest(range(1, len(words) - 48)) as i from w)),
firsts as (select win, min(doc_id) as first_id from windows group by win),
places as (
  select distinct doc_id, p
  from (select doc_id, unnest(range(i, i + 50)) as p from windows join firsts using (win) where first_id < doc_id)),
gone as (select doc_id, list(p) as places, count(*) as n from places group by doc_id)
select doc_id, len(words) as n_words, coalesce(n, 0) as n_removed,
  sha256(coalesce(array_to_string([word for word, i in words if n is null or not list_contains(places, i)], ' '), '')) as kept_sha256
from w left join gone using (doc_id)
"""
