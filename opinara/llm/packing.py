"""Packing of documents into training sequences of fixed length, mixed by source.

Method. Each source is a queue of documents, seen as one run of tokens cut into
blocks of ``QUANTUM`` tokens. Deficit round-robin deals them: in every round a
queue's credit grows by its target share of one window; while the credit covers
a block, a block is dealt and paid for; the rest is carried to the next round.
The dealt blocks form one stream, cut every ``LENGTH`` tokens, so every window
but the last is full and holds the target proportions to within a block a
source. Without targets the shares are those of the whole corpus, so that all
queues last to the end; with others, a queue that has run dry is passed over.

The credit after r rounds is r times the share, so blocks dealt, and with them
the place of any block in the stream, follow from r by integer arithmetic: no
task waits for another, and deficits carry over windows and partitions exactly.

On Spark. The texts are read once; the ids are written with each row's place
among its task's tokens of that source. Sums by task and source, added up in
two steps, turn that into places in the queue. Then each row works out its own
pieces: no row is moved, sorted or grouped. A source has a queue of its own if
it has 1/256 of all tokens or more, or is named in the targets. The others share
one queue, in which their blocks are dealt in turn too: block i of a source's n
stands at (i + phase) / n of the queue, with a phase by source, so each of them
is spread evenly over all of it. Their places are sums over a written table of
blocks, and their rows are cut at blocks and joined with it. Only the totals of
the other queues, at most 257 and the named ones, reach the driver.

Defined results. A null text is an empty one: a document of one token, the end
token. A null source is a source of its own. Rows that repeat an id are packed
each. A very long text is encoded whole and cut into as many pieces as it needs.
An empty table gives no rows. The order in a queue is that of the files.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.common import map_rows, stored
from opinara.llm.pieces import PieceEncoder, encoded

LENGTH = 2048
QUANTUM = 256
#: Sources with a smaller share than one in this many share a queue, in which they are mixed block by block.
QUEUES = 256
#: Stretches of the shared queue whose blocks are put in order together.
STRETCHES = 1 << 16
END = 1
#: How byte-level vocabularies write each byte: as the character of its number where that is visible.
VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in VISIBLE)}
SPACE = chr(BYTES[32])
#: Letters below it are letters in every version of Unicode.
LATIN_END = "\u0250"


@cache
def piece_encoder(path: str) -> PieceEncoder:
    """A tokenizer file's encoder, loaded once in each worker; one thread, as Spark spreads the work."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]

    def whole(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    # A piece takes the library's split and model without the offsets and masks that encode() makes.
    split, model = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model.tokenize

    def one(text: str) -> bytes:
        """A piece without white space but for one leading space."""
        letters = text.isalpha() or text[1:].isalpha() and text[0] == " "
        if letters and text.isascii():
            matches = [text.replace(" ", SPACE)]  # letters are one match, and stand for themselves
        elif letters and max(text) < LATIN_END:
            matches = [text.encode().decode("latin-1").translate(BYTES)]
        else:
            matches = [match for match, _ in split(text)]
        return array("I", [token.id for match in matches for token in model(match)]).tobytes()

    # The split and the model know nothing of added tokens.
    apart = re.compile("|".join(map(re.escape, added))) if added else None
    return PieceEncoder(one, whole, apart)


TOKENS = pa.schema(
    [("doc_id", pa.int64()), ("source", pa.string()), ("part", pa.int64()), ("place", pa.int64())]
    + [("length", pa.int64()), ("wide", pa.bool_()), ("ids", pa.binary())]
)


def tokens(docs: DataFrame, path: str, end: int = END, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The ids of every row, written once, with its ``place`` among the tokens of its ``source`` in its ``part``.

    ``ids`` take two bytes each, or four where one needs them (``wide``).
    """
    last = np.array([end], "<u4").tobytes()

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        part, places = TaskContext.get().partitionId(), {}
        for doc_id, queue, packed in encoded(rows, piece_encoder(path)):
            ids = np.frombuffer(packed + last, "<u4")
            place = places.get(queue, 0)
            places[queue] = place + len(ids)
            wide = bool(ids.max() >> 16)
            yield doc_id, queue, part, place, len(ids), wide, (ids if wide else ids.astype("<u2")).tobytes()

    # No source is "", a named one begins with "=".
    queue = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    read = docs.select(F.col(key).cast("long"), queue, F.coalesce(F.col(text), F.lit("")))
    ddl = "doc_id long, source string, part long, place long, length long, wide boolean, ids binary"
    return stored(map_rows(read, run, TOKENS, ddl), "tokens")


class Deal:
    """Deficit round-robin over queues of ``totals`` tokens, with integer ``weights``."""

    def __init__(self, totals: list[int], weights: list[int], length: int = LENGTH, quantum: int = QUANTUM) -> None:
        self.totals, self.weights, self.length, self.quantum = totals, weights, length, quantum
        self.whole = sum(weights)
        self.rounds: dict[int, list[int]] = {}

    def dealt(self, queue: int, rounds: int) -> int:
        """Tokens of a queue dealt in so many rounds: the blocks its credit has covered."""
        blocks = rounds * self.length * self.weights[queue] // (self.quantum * self.whole)
        return min(self.totals[queue], blocks * self.quantum)

    def others(self, rounds: int) -> list[int]:
        """For each queue, the tokens of all other queues dealt before its turn in a round (counted from 1)."""
        found = self.rounds.get(rounds)
        if found is None:
            now = [self.dealt(q, rounds) for q in range(len(self.totals))]
            before = [self.dealt(q, rounds - 1) for q in range(len(self.totals))]
            found, first, rest = [], 0, sum(before)
            for a, b in zip(now, before, strict=True):
                rest -= b
                found.append(first + rest)
                first += a
            if len(self.rounds) > 4096:
                self.rounds.clear()
            self.rounds[rounds] = found
        return found

    def pieces(self, queue: int, start: int, length: int) -> Iterator[tuple[int, int, int]]:
        """Where the tokens from ``start`` of a queue go: their places in the stream, as ``(from, to, place)``.

        ``from`` and ``to`` count from ``start``; no piece crosses the end of a window.
        """
        end, at = start + length, start
        begun, place, upto = start, -1, -1  # the piece that is being made
        cost, credit = self.quantum * self.whole, self.length * self.weights[queue]
        while at < end:
            block = at // self.quantum
            stop = min(end, (block + 1) * self.quantum)
            rounds = -(-(block + 1) * cost // credit)
            here = self.others(rounds)[queue] + at
            while at < stop:
                step = min(stop - at, self.length - here % self.length)
                if here != upto or here % self.length == 0:
                    if upto >= 0:
                        yield begun - start, at - start, place
                    begun, place = at, here
                at, here = at + step, here + step
                upto = here
        if upto >= 0:
            yield begun - start, end - start, place


def deal(rows: DataFrame, targets: dict[str, int] | None = None) -> tuple[Deal, dict[str, int]]:
    """The deal for the written ``tokens``, and the queue of each source that has one; the others take the last queue.

    ``targets`` are integer weights by source; the shared queue has the key "" and a source that is not
    named has weight 1. At most 257 rows and the named sources reach the driver.
    """
    sums = rows.groupBy("source").agg(F.sum("length").alias("total"))
    total = rows.agg(F.sum("length")).first()[0] or 0
    own = F.col("total") * QUEUES >= total
    if targets:
        own = own | F.col("source").isin([f"={name}" for name in targets if name])
    large = sorted((r.source, r.total) for r in sums.filter(own).collect())
    queues = {source: i for i, (source, _) in enumerate(large)}
    totals = [t for _, t in large]
    rest = total - sum(totals)
    if rest:
        totals.append(rest)
    if not targets:
        return Deal(totals, totals), queues
    weights = [max(1, targets.get(source.removeprefix("="), 1)) for source, _ in large]
    return Deal(totals, weights + [max(1, targets.get("", 1))] * bool(rest)), queues


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``start``, the place of each row's first token among those of its source."""
    sums = stored(rows.groupBy("part", "source").agg(F.sum("length").alias("tokens")), "sums-by-part")
    along = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", "source", F.coalesce(F.sum("tokens").over(along), F.lit(0)).alias("base"))
    bases = stored(bases, "places-by-part")
    return rows.join(bases, ["part", "source"]).withColumn("start", F.col("base") + F.col("place"))


def shared_blocks(rows: DataFrame, quantum: int) -> DataFrame:
    """``source, block, base`` of the ``rows``' sources: where each block begins in the queue they share."""
    sums = rows.groupBy("source").agg(F.sum("length").alias("total"))
    count = F.ceil(F.col("total") / quantum)
    blocks = sums.select("source", "total", count.alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("block"))
    phase = F.pmod(F.xxhash64("source"), F.lit(1 << 20)) / (1 << 20)
    time = (F.col("block") + phase) / F.col("n")
    size = F.least(F.lit(quantum), F.col("total") - F.col("block") * quantum)
    blocks = blocks.select("source", "block", time.alias("time"), size.alias("tokens"))
    blocks = stored(blocks.withColumn("stretch", F.floor(F.col("time") * STRETCHES)), "blocks")
    stretches = blocks.groupBy("stretch").agg(F.sum("tokens").alias("tokens"))
    along = Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    earlier = stretches.select("stretch", F.coalesce(F.sum("tokens").over(along), F.lit(0)).alias("earlier"))
    within = Window.partitionBy("stretch").orderBy("time", "source", "block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.withColumn("before", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
    return stored(before.join(earlier, "stretch").select("source", "block", (F.col("before") + F.col("earlier")).alias("base")), "shared-blocks")


def cut_at_blocks(rows: DataFrame, quantum: int) -> DataFrame:
    """The ``placed`` rows of sources that share a queue, one for each block they reach into, as ``queued`` gives them."""
    first, last = F.floor(F.col("start") / quantum), F.floor((F.col("start") + F.col("length") - 1) / quantum)
    cut = rows.withColumn("block", F.explode(F.sequence(first, last)))
    cut = cut.withColumn("skip", F.greatest(F.lit(0), F.col("block") * quantum - F.col("start")))
    cut = cut.withColumn("size", F.least("length", (F.col("block") + 1) * quantum - F.col("start")) - F.col("skip"))
    bytes_each = F.when(F.col("wide"), 4).otherwise(2)
    own = F.substring("ids", (F.col("skip") * bytes_each + 1).cast("int"), (F.col("size") * bytes_each).cast("int"))
    cut = cut.select("doc_id", "source", "block", "start", "skip", "size", "length", "wide", own.alias("ids"))
    at = F.col("base") + F.col("start") + F.col("skip") - F.col("block") * quantum
    return cut.join(shared_blocks(rows, quantum), ["source", "block"]).select(
        "doc_id", at.alias("start"), "skip", "size", "length", "wide", "ids"
    )


def queued(rows: DataFrame, plan: Deal, queues: dict[str, int]) -> DataFrame:
    """``doc_id, queue, start, skip, size, length, wide, ids``: runs of ids and their place in a queue.

    ``skip`` tokens of the row's ``length`` come before the run of ``size``.
    """
    columns = ("doc_id", "queue", "start", "skip", "size", "length", "wide", "ids")
    cases = F.lit(None).cast("int")
    for source, queue in queues.items():
        cases = F.when(F.col("source") == source, queue).otherwise(cases)
    rows = placed(rows).withColumn("queue", cases)
    whole = rows.filter("queue is not null").withColumns({"skip": F.lit(0).cast("long"), "size": F.col("length")}).select(*columns)
    if len(plan.totals) == len(queues):
        return whole
    shared = cut_at_blocks(rows.filter("queue is null"), plan.quantum).withColumn("queue", F.lit(len(queues)))
    return whole.union(shared.select(*columns))


PIECES = pa.schema([("doc_id", pa.int64())] + [(c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
PIECES_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, path: str, targets: dict[str, int] | None = None, with_ids: bool = False, **columns: str) -> DataFrame:
    """One row per piece of a document; with ``with_ids`` also the ids themselves."""
    rows = tokens(docs, path, **columns)
    plan, queues = deal(rows, targets)

    def run(found: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, queue, start, skip, size, length, wide, packed in found:
            ids = packed if wide else np.frombuffer(packed, "<u2").astype("<u4").tobytes()
            for a, b, place in plan.pieces(queue, start, size):
                own = ids[4 * a : 4 * b]
                row = (doc_id, skip + a, b - a, zlib.crc32(own), length, place // plan.length, place % plan.length)
                yield (*row, np.frombuffer(own, "<i4")) if with_ids else row

    schema, ddl = PIECES, PIECES_DDL
    if with_ids:
        schema, ddl = schema.append(pa.field("ids", pa.list_(pa.int32()))), ddl + ", ids array<int>"
    return map_rows(queued(rows, plan, queues), run, schema, ddl)


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids``: the packed windows themselves, from pieces with ids.

    A window holds at most ``LENGTH`` ids, so a group is bounded.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    rows = pieces.groupBy("sequence_id").agg(parts.alias("parts"))
    return rows.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
