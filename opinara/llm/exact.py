"""Exact deduplication with an index of live digests in a cuckoo filter.

Method. A digest is the SHA-256 of a text after lower-casing A-Z. Each task keeps
its live digests (one row per group of equal texts, the one that stays) in a
cuckoo filter: buckets of four short fingerprints, two possible buckets per
digest. A hit of the filter is only a hint; it is verified against the content
stored beside the fingerprint, that is the whole digest. When a row with a
larger id meets a live digest, the old entry is deleted and the new one
inserted. A filter that overflows is rebuilt at twice its size from the stored
keys.

On Spark. The texts are read once and hashed; only (id, digest) is written. Each
task first reduces its own rows to live digests, so that a group that holds a
third of all rows reaches the shuffle as a few rows per task; an index that has
grown to ``LIVE_ROWS`` is given out and a new one begun. The live digests are
then dealt by digest, sorted by their first byte, and merged by one index per
byte. So no index holds more than a bounded part. Rows meet their group in a join
by digest, which only groups of two and more take part in; adaptive execution
splits its hot keys.

Defined results. A null text is an empty one. A null id is smaller than any
other. Rows that repeat an id and its text are one document: all get the same
decision, and each counts in ``group_size``; ``drop_duplicates`` keeps one row
of a group, also where rows tie for its id or none has one. A very long text is
digested whole. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import keep_one, map_rows, row_hash, stored, utf8

SLOTS = 4
KICKS = 200
#: Entries after which a task gives out what it has so far.
LIVE_ROWS = 100_000


class CuckooIndex:
    """A cuckoo filter whose slots also hold what they stand for.

    ``fingerprints[i]`` are the short tags of bucket i and ``content[i]`` the
    entries ``[digest, id, count]`` in the same order.
    """

    def __init__(self, buckets: int = 64) -> None:
        self.mask = buckets - 1
        self.fingerprints: list[list[int]] = [[] for _ in range(buckets)]
        self.content: list[list[list]] = [[] for _ in range(buckets)]
        self.random = random.Random(42)
        self.resized = 0
        self.size = 0

    def place(self, digest: bytes) -> tuple[int, int]:
        """The short tag, never 0, and the first bucket."""
        tag = int.from_bytes(digest[:2], "little") or 1
        return tag, int.from_bytes(digest[2:10], "little") & self.mask

    def other(self, tag: int, bucket: int) -> int:
        """The other bucket of a tag; applied twice it gives the first again."""
        return (bucket ^ (tag * 0x5BD1E995)) & self.mask

    def find(self, digest: bytes) -> tuple[int, int] | None:
        """Bucket and slot of a live digest, verified against the content."""
        tag, bucket = self.place(digest)
        for b in (bucket, self.other(tag, bucket)):
            if tag in self.fingerprints[b]:
                for slot, entry in enumerate(self.content[b]):
                    if entry[0] == digest:
                        return b, slot
        return None

    def delete(self, digest: bytes) -> list | None:
        at = self.find(digest)
        if at is None:
            return None
        self.fingerprints[at[0]].pop(at[1])
        self.size -= 1
        return self.content[at[0]].pop(at[1])

    def insert(self, entry: list) -> None:
        self.size += 1
        tag, bucket = self.place(entry[0])
        for b in (bucket, self.other(tag, bucket)):
            if len(self.content[b]) < SLOTS:
                self.fingerprints[b].append(tag)
                self.content[b].append(entry)
                return
        for _ in range(KICKS):
            slot = self.random.randrange(SLOTS)
            self.fingerprints[bucket][slot], tag = tag, self.fingerprints[bucket][slot]
            self.content[bucket][slot], entry = entry, self.content[bucket][slot]
            bucket = self.other(tag, bucket)
            if len(self.content[bucket]) < SLOTS:
                self.fingerprints[bucket].append(tag)
                self.content[bucket].append(entry)
                return
        self.grow(entry)

    def grow(self, left_over: list) -> None:
        """Rebuild at twice the size from the stored entries."""
        entries = [*self, left_over]
        resized = self.resized + 1
        self.__init__((self.mask + 1) * 2)
        self.resized = resized
        for entry in entries:
            self.insert(entry)

    def add(self, digest: bytes, doc_id: int | None, count: int) -> None:
        """Count a row; of equal digests the one with the largest id stays live."""
        at = self.find(digest)
        if at is None:
            self.insert([digest, doc_id, count])
            return
        live = self.content[at[0]][at[1]]
        if doc_id is not None and (live[1] is None or doc_id > live[1]):
            old = self.delete(digest)
            self.insert([digest, doc_id, old[2] + count])
        else:
            live[2] += count

    def __iter__(self) -> Iterator[list]:
        return (entry for bucket in self.content for entry in bucket)


def _digests(rows: Iterable[tuple]) -> Iterator[tuple]:
    for doc_id, row, text in rows:
        yield doc_id, row, hashlib.sha256(text.lower()).digest()


def _live(most: int | None):
    """Merge ``bucket, digest, doc_id, count`` rows; give out the index when the bucket changes or it holds ``most``."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        index, current = CuckooIndex(), None
        for bucket, digest, doc_id, count in rows:
            if index.size and (bucket != current or most and index.size >= most):
                yield from map(tuple, index)
                index = CuckooIndex()
            current = bucket
            index.add(digest, doc_id, count)
        yield from map(tuple, index)

    return run


DIGESTS = pa.schema([("doc_id", pa.int64()), ("row_hash", pa.int64()), ("digest", pa.binary())])
LIVE = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())])
LIVE_DDL = "digest binary, keep_id long, group_size long"


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, row_hash, digest`` of every row, written once."""
    read = docs.select(F.col(key).cast("long"), row_hash(text), utf8(text))
    found = map_rows(read, _digests, DIGESTS, "doc_id long, row_hash long, digest binary")
    return stored(found, "digests")


def live_digests(rows: DataFrame) -> DataFrame:
    """``digest, keep_id, group_size``: one row for each distinct digest."""
    whole = F.lit(None).cast("binary")
    own = map_rows(rows.select(whole, "digest", "doc_id", F.lit(1).cast("long")), _live(LIVE_ROWS), LIVE, LIVE_DDL)
    bucketed = own.select(F.substring("digest", 1, 1).alias("bucket"), "digest", "keep_id", "group_size")
    bucketed = bucketed.repartition("digest").sortWithinPartitions("bucket")
    return map_rows(bucketed, _live(None), LIVE, LIVE_DDL)


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, row_hash`` for every row of ``docs``."""
    rows = digests(docs, key, text)
    groups = stored(live_digests(rows).filter("group_size > 1"), "live-digests")
    joined = rows.join(groups, "digest", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "row_hash",
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The row of ``docs`` that stays of each group of equal texts, all columns kept; of tied rows one."""
    return keep_one(docs, stored(exact_duplicates(docs), "exact-groups"), "text_sha256")
