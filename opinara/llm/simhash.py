"""Near-duplicate detection by SimHash fingerprints.

Method. A text's fingerprint has a bit for each bit of a 64-bit hash, set where
more than half of its word shingles set it. Two texts are near copies if their
fingerprints differ in at most two bits, hence in at most two of the eight
bytes: they share at least six of eight positional bytes. An inverted index
keeps, for each set of four byte positions that is a union of two of the byte
pairs (0,1) (2,3) (4,5) (6,7), the fingerprints by their bytes there; two
differing bytes leave two pairs whole, so every link meets in one of the six
sets. For each pair that meets, the shared positional bytes are tallied, pairs
with fewer than six are dropped, and the rest are verified bit by bit. Lists of
one byte position would hold 1/256 of the corpus each; four bytes keep them
short at any size. So these keys find the pairs in place of a count over lists of
single bytes, and the test for six shared bytes only repeats what the bits imply.

On Spark. Texts are read once; from then on only distinct fingerprints travel,
so exact copies cost nothing. A list of at most ``LIST`` fingerprints is joined
with itself. Fingerprints of longer lists take a way that needs no pairs: each
gives itself and its 64 neighbours at one bit; fingerprints that give the same
value are at most two bits apart, and any two that far apart give a common one.
Such a group has at most 65 members and is linked as a star from its smallest. Both ways are
exact, so the result does not depend on ``LIST``. Groups are connected
components, found by joins in the shared folder.

Defined results. A null text has no words: its fingerprint is 0, linked like any
other. A null id belongs to a component but never names one, unless all its ids
are null. Repeated rows share fingerprint and component; ``keep_first`` keeps one
row of a component, also where rows tie for its id or none has one. A very long
text is hashed whole, in blocks of bounded size. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import keep_one, map_rows, row_hash, stored, text_blocks, utf8
from opinara.llm.graph import components

SEED = 42
SHINGLE = 3
DISTANCE = 2
BYTES = 8
#: Longer lists take the way over neighbours instead of a self-join.
LIST = 512


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """The fingerprint of a text in UTF-8, worked out in blocks of bounded size."""
    hash64 = xxhash.xxh64_intdigest
    ones, n, tail = np.zeros(64, np.int64), 0, []
    for block in text_blocks(text.lower()):
        words = tail + block.split()
        hashes = [hash64(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(size)), strict=False)]
        if hashes:
            bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
            n += len(hashes)
        tail = words[-(size - 1) :] if size > 1 else []
    if n == 0:
        return hash64(b" ".join(tail), SEED) if tail else 0
    set_bits = np.packbits(2 * ones > n, bitorder="little")
    return int.from_bytes(set_bits.tobytes(), "little")


def _fingerprints(rows: Iterable[tuple]) -> Iterator[tuple]:
    for doc_id, row, text in rows:
        value = fingerprint(text)
        yield doc_id, row, value - (1 << 64) if value >> 63 else value


PRINTS = pa.schema([("doc_id", pa.int64()), ("row_hash", pa.int64()), ("bits", pa.int64())])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, row_hash, bits`` of every row, written once; ``bits`` is the fingerprint as a signed number."""
    read = docs.select(F.col(key).cast("long"), row_hash(text), utf8(text))
    found = map_rows(read, _fingerprints, PRINTS, "doc_id long, row_hash long, bits long")
    return stored(found, "fingerprints")


def _byte_lists(bits: Column) -> Column:
    """The keys of the six lists that hold a fingerprint: the number of the list and four bytes."""
    pairs = [F.shiftrightunsigned(bits, 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    keys = [
        F.lit(number << 32).cast("long").bitwiseOR(F.shiftleft(pairs[i], 16)).bitwiseOR(pairs[j])
        for number, (i, j) in enumerate(combinations(range(4), 2))
    ]
    return F.explode(F.array(*keys))


def _shared_bytes(difference: Column) -> Column:
    """How many of the eight positional bytes are equal."""
    equal = [
        (F.shiftrightunsigned(difference, 8 * p).bitwiseAND(F.lit(0xFF)) == 0).cast("int") for p in range(BYTES)
    ]
    return sum(equal[1:], equal[0])


def links(prints: DataFrame, longest: int = LIST) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``bits``) that connect all near copies."""
    index = prints.select("bits", _byte_lists(F.col("bits")).alias("list"))
    long_lists = index.groupBy("list").count().filter(F.col("count") > longest).select("list")
    long_lists = stored(long_lists, "long-lists")

    short = index.join(long_lists, "list", "left_anti")
    a, b = short.select("list", F.col("bits").alias("a")), short.select("list", F.col("bits").alias("b"))
    difference = F.col("a").bitwiseXOR(F.col("b"))
    near = (_shared_bytes(difference) >= BYTES - DISTANCE) & (F.bit_count(difference) <= DISTANCE)
    pairs = a.join(b, (a["list"] == b["list"]) & (F.col("a") < F.col("b")) & near).select("a", "b")

    crowded = index.join(long_lists, "list", "left_semi").select("bits").distinct()
    flips = [F.lit((1 << i) - (1 << 64) if i == 63 else 1 << i).cast("long") for i in range(64)]
    near_values = F.array("bits", *[F.col("bits").bitwiseXOR(f) for f in flips])
    met = crowded.select("bits", F.explode(near_values).alias("value"))
    # Most values have one or two members, and those are their smallest and largest; no list of members is made.
    ends = [F.min("bits").alias("a"), F.max("bits").alias("b"), F.count(F.lit(1)).alias("n")]
    stars = stored(met.groupBy("value").agg(*ends).filter("n > 1"), "stars")
    inner = met.join(stars.filter("n > 2"), "value").filter("bits <> a and bits <> b").select("a", F.col("bits").alias("b"))
    stars = stars.select("a", "b").union(inner)
    return pairs.union(stars.distinct())


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", longest: int = LIST) -> DataFrame:
    """``doc_id, row_hash, bits, label, component_id``; ``label`` names a component even where no row has an id."""
    rows = fingerprints(docs, key, text)
    prints = stored(rows.groupBy("bits").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    labels = components(links(prints, longest))
    named = prints.join(labels, prints["bits"] == labels["node"], "left")
    named = named.select("bits", "first_id", F.coalesce("label", "bits").alias("label"))
    smallest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    named = stored(named.join(smallest, "label").select("bits", "label", "component_id"), "components")
    return rows.join(named, "bits").select("doc_id", "row_hash", "bits", "label", "component_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", longest: int = LIST) -> DataFrame:
    """``doc_id, fingerprint, component_id, row_hash`` for every row of ``docs``."""
    fingerprint = F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint")
    return groups(docs, key, text, longest).select("doc_id", fingerprint, "component_id", "row_hash")


def keep_first(docs: DataFrame) -> DataFrame:
    """The row of ``docs`` that names its component, all columns kept; of tied rows one."""
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return keep_one(docs, stored(groups(docs).select("doc_id", "row_hash", "label", kept), "near-groups"), "label")
