"""Source divergence audit: how the vocabulary of each source differs from the others' of its language.

Method. A language keeps the terms found in enough of its documents. The kept
terms in sorted order become minimal acyclic transducers (``transducer.py``),
one per ``BLOCK`` terms, which map a language and term to its ordinal, its place
in that order. Texts are streamed through them to count the kept terms again by
source; from there on terms are ordinals, whose order settles ties. Probabilities
are integers of a billionth, and all sums are exact.

On Spark. Tasks count terms in bounded memory and send sums only. The texts pass
the transducers in the task that reads them as long as all blocks together have
at most ``BROADCAST`` bytes, which is checked; beyond that the counted terms of a
task travel to their block instead, spread over ``SPREAD`` parts by source and
task, and pass its transducer there. A pair's sum over all terms is made of what
the pair would have without terms in common, from each source's table of counts,
and of a correction for the terms that both have; those are paired term by term
in bounded pieces and summed before they leave a task, so no row is made per
pair and term. Ordinals come from a sort by range and sums per part.

Defined results. Null text, language and source count as empty. A group without
terms has pairs, and none of its terms are listed; where a language keeps no term
all its pairs have 0. Repeated rows are documents of their own. A very long text
is cut into words a block at a time, and memory grows with its distinct words; a
very long word is one term. Other columns are not read. An empty table gives no
rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import count, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm import transducer
from opinara.llm.common import map_rows, numbered, on_workers, slices, stored, text_blocks, utf8

#: A term occurs in so many documents of its language.
LEAST_DOCUMENTS = 3
#: Terms that are listed for a group.
TERMS = 200
SCALE = 1_000_000_000
#: Terms of a transducer.
BLOCK = 1 << 15
#: All transducers together have at most so many bytes where every task gets them.
BROADCAST = 1 << 25
#: Different terms that a task counts before it sends them on.
COUNTED = 1 << 20
#: Ordinals whose counts travel in one row.
PIECE = 1 << 12
#: Parts that the counted terms of a block are spread over, where they travel.
SPREAD = 32
#: Parts that the groups of a language are spread over when they are paired.
BUCKETS = 16
#: Pairs of sources that are summed at a time.
PAIRS = 1 << 20

#: Bytes of terms to their lower case, all others to a space.
LOWER = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """All terms of a text, a block at a time."""
    for block in text_blocks(text.translate(LOWER)):
        yield block.split()


Batches = Iterable[pa.RecordBatch]


def _rows(batches: Batches) -> Iterator[tuple]:
    for batch in batches:
        for part in slices(batch):
            yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def _columns(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Long batches in pieces."""
    for batch in batches:
        yield from (batch.slice(i, 1 << 16) for i in range(0, batch.num_rows, 1 << 16))


FOUND = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("n", pa.int64())])
FOUND_DDL = "lang string, term binary, n long"


def _documents(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """``lang, term, n``: documents of a task that hold a term."""
    counts: dict[str, Counter] = defaultdict(Counter)
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, seen in counts.items():
            columns = [pa.repeat(lang, len(seen)), pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=FOUND)
        counts.clear()

    for lang, _, text in rows:
        seen = counts[lang]
        size -= len(seen)
        seen.update(set().union(*terms(text)))
        size += len(seen)
        if size > COUNTED:
            yield from flush()
            size = 0
    yield from flush()


#: By source: numbers of words, and how often each occurs.
Counts = dict[str, tuple[np.ndarray, np.ndarray]]


def _counted(rows: Iterable[tuple]) -> Iterator[tuple[str, list[bytes], Counts]]:
    """Language, words by number, and occurrences by source, some at a time."""
    counts: dict[str, dict[str, Counter]] = defaultdict(lambda: defaultdict(Counter))
    size = 0

    def flush() -> Iterator[tuple[str, list[bytes], Counts]]:
        for lang, sources in counts.items():
            number = defaultdict(count().__next__)
            numbered = {
                source: (np.fromiter(map(number.__getitem__, seen), np.int64, len(seen)), np.fromiter(seen.values(), np.int64, len(seen)))
                for source, seen in sources.items()
            }
            yield lang, list(number), numbered
        counts.clear()

    for lang, source, text in rows:
        seen = counts[lang][source]
        size -= len(seen)
        for words in terms(text):
            seen.update(words)
        size += len(seen)
        if size > COUNTED:
            yield from flush()
            size = 0
    yield from flush()


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in ascending order, with the sum of its values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    ends = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[ends], np.add.reduceat(values[order], ends) if len(ends) else values[:0]


def key(lang: str, term: bytes) -> bytes:
    """What the transducers hold; no term has a zero byte, so its last one ends the language."""
    return lang.encode() + b"\0" + term


class Blocks:
    """Transducers of consecutive parts of the vocabulary, each with its first key and the ordinal of that."""

    def __init__(self, rows: Iterable[tuple[bytes, int, bytes]]) -> None:
        found = sorted(rows)
        self.firsts = [first for first, _, _ in found]
        self.bases = [base for _, base, _ in found]
        self.bodies = [transducer.load(body) for _, _, body in found]

    def ordinals(self, keys: list[bytes]) -> np.ndarray:
        """Of keys in ascending order."""
        out = np.full(len(keys), -1, np.int64)
        for i, a, b in parts(self.firsts, keys):
            found = self.bodies[i].ordinals(keys[a:b])
            out[a:b] = np.where(found >= 0, found + self.bases[i], -1)
        return out


def parts(firsts: list[bytes], keys: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """Blocks that some of the ascending keys belong to, with the range of those."""
    at = 0
    while at < len(keys):
        block = bisect_right(firsts, keys[at]) - 1
        end = bisect_right(keys, firsts[block + 1], at) if block + 1 < len(firsts) else len(keys)
        if end > at and block + 1 < len(firsts) and keys[end - 1] == firsts[block + 1]:
            end -= 1
        if block >= 0:
            yield block, at, end
        at = end


PACKED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("piece", pa.int64()), ("places", pa.binary()), ("counts", pa.binary())])
PACKED_DDL = "lang string, source string, piece long, places binary, counts binary"


def _packed(lang: str, source: str, ordinals: np.ndarray, n: np.ndarray) -> Iterator[tuple]:
    """The counts of a group, a row for each ``PIECE`` ordinals."""
    ordinals, n = _summed(ordinals[ordinals >= 0], n[ordinals >= 0])
    piece = ordinals // PIECE
    cuts = np.flatnonzero(np.diff(piece)) + 1
    for at, some, counts in zip(piece[np.r_[0, cuts]] if len(piece) else (), np.split(ordinals, cuts), np.split(n, cuts), strict=False):
        yield lang, source, int(at), (some % PIECE).astype(np.uint16).tobytes(), counts.astype(np.int64).tobytes()


def _through(blocks: Blocks, lang: str, words: list[bytes], counts: Counts) -> Iterator[tuple]:
    """The counts of the kept words."""
    order = pc.sort_indices(pa.array(words, pa.binary())).to_numpy()
    ordinals = np.empty(len(words), np.int64)
    ordinals[order] = blocks.ordinals([key(lang, words[i]) for i in order.tolist()])
    for source, (numbers, n) in counts.items():
        yield from _packed(lang, source, ordinals[numbers], n)


ORDINALS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("ordinal", pa.int64()), ("n", pa.int64())])
ORDINALS_DDL = "lang string, source string, ordinal long, n long"


def _merged(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """``lang, source, ordinal, n`` from rows of ``_packed`` in the order of group and piece."""
    for (lang, source, piece), some in groupby(rows, key=lambda r: r[:3]):
        total = np.zeros(PIECE, np.int64)
        for _, _, _, places, counts in some:
            total[np.frombuffer(places, np.uint16)] += np.frombuffer(counts, np.int64)
        at = np.flatnonzero(total)
        columns = [pa.repeat(lang, len(at)), pa.repeat(source, len(at)), pa.array(at + piece * PIECE), pa.array(total[at])]
        yield pa.RecordBatch.from_arrays(columns, schema=ORDINALS)


def _recounted_in_place(docs: DataFrame, blocks: DataFrame) -> DataFrame:
    """Texts pass the transducers where they are read. ``blocks`` are few, as their size is checked."""
    shared = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in blocks.collect()])

    def make(rows: Iterable[tuple]) -> Iterator[tuple]:
        loaded = Blocks((bytes(first), base, bytes(body)) for first, base, body in shared.value)
        for lang, words, counts in _counted(rows):
            yield from _through(loaded, lang, words, counts)

    return map_rows(docs, make, PACKED, PACKED_DDL)


SENT = pa.schema(
    [("first", pa.binary()), ("part", pa.int32()), ("lang", pa.string()), ("source", pa.string())]
    + [("words", pa.binary()), ("counts", pa.binary()), ("base", pa.int64()), ("body", pa.binary())]
)
SENT_DDL = "first binary, part int, lang string, source string, words binary, counts binary, base long, body binary"


def _recounted_at_blocks(docs: DataFrame, blocks: DataFrame) -> DataFrame:
    """The counted words of a task travel to the transducer of their block. Tasks know only where blocks begin."""
    firsts = docs.sparkSession.sparkContext.broadcast(sorted(bytes(r[0]) for r in blocks.select("first").collect()))

    def send(rows: Iterable[tuple]) -> Iterator[tuple]:
        task = TaskContext.get().partitionId()
        for lang, words, counts in _counted(rows):
            order = pc.sort_indices(pa.array(words, pa.binary())).to_numpy()
            rank = np.empty(len(words), np.int64)
            rank[order] = np.arange(len(words))
            words = [words[i] for i in order.tolist()]
            for source, (numbers, n) in counts.items():
                ranks, n = _summed(rank[numbers], n)
                some = [words[i] for i in ranks.tolist()]
                part = (task + sum(source.encode())) % SPREAD
                for block, a, b in parts(firsts.value, [key(lang, w) for w in some]):
                    yield firsts.value[block], part, lang, source, b"\0".join(some[a:b]), n[a:b].astype(np.int64).tobytes(), None, None

    def look_up(rows: Iterable[tuple]) -> Iterator[tuple]:
        block = None
        for first, _, lang, source, words, counts, base, body in rows:
            if body is not None:  # comes first
                block = Blocks([(first, base, body)])
                continue
            ordinals = block.ordinals([key(lang, w) for w in words.split(b"\0")])
            yield from _packed(lang, source, ordinals, np.frombuffer(counts, np.int64))

    sent = map_rows(docs, send, SENT, SENT_DDL)
    every = F.explode(F.array(*[F.lit(i) for i in range(SPREAD)])).alias("part")
    bodies = blocks.select("first", every, "base", "body")
    both = sent.unionByName(bodies, allowMissingColumns=True).repartition("first", "part")
    together = both.sortWithinPartitions("first", "part", F.col("body").isNull()).select(*SENT.names)
    return map_rows(together, look_up, PACKED, PACKED_DDL)


def vocabulary(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``ordinal, lang, term, key`` of the kept terms, as a written table. Takes ``lang, source, text``."""
    found = on_workers(docs).mapInArrow(lambda batches: _columns(_documents(_rows(batches))), FOUND_DDL)
    kept = found.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    joined = F.concat(F.col("lang").cast("binary"), F.lit(b"\0"), "term").alias("key")
    kept = stored(kept.select("lang", F.col("term").cast("string"), joined), "kept-terms")
    if not kept.take(1):
        return kept.select(F.lit(0).cast("long").alias("ordinal"), "*")
    return numbered(kept, [F.col("key")], "vocabulary")


def transducers(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """``first, base, body``: a transducer for each ``block`` consecutive terms, as a written table."""
    schema = pa.schema([("first", pa.binary()), ("base", pa.int64()), ("body", pa.binary())])

    def build(table: pa.Table) -> pa.Table:
        keys = sorted(table["key"].to_pylist())
        base = min(table["ordinal"].to_pylist())
        return pa.Table.from_pylist([{"first": keys[0], "base": base, "body": transducer.build(keys).dump()}], schema)

    found = on_workers(vocabulary).select(F.expr(f"ordinal div {block}").alias("block"), "ordinal", "key")
    return stored(found.groupBy("block").applyInArrow(build, "first binary, base long, body binary"), "transducers")


def recount(docs: DataFrame, blocks: DataFrame, broadcast: int = BROADCAST) -> DataFrame:
    """``lang, source, ordinal, n`` of all kept terms, as a written table."""
    size = blocks.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    found = (_recounted_in_place if size <= broadcast else _recounted_at_blocks)(docs, blocks)
    found = found.repartition("lang", "source", "piece").sortWithinPartitions("lang", "source", "piece")
    return stored(on_workers(found).mapInArrow(lambda batches: _columns(_merged(_rows(batches))), ORDINALS_DDL), "recounts")


def share(n: Column | str, total: Column | str, kept: Column | str) -> Column:
    """``1 + floor(SCALE * (n + 1) / (total + kept))``, exactly."""
    n, total, kept = ((F.col(c) if isinstance(c, str) else c).cast("decimal(18,0)") for c in (n, total, kept))
    up = (n + 1) * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", up, total + kept)


def gap(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / q)``."""
    return F.call_function("div", (p - q) * (p - q), q)


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return ((p - q) ** 2).view(np.uint64) // q.view(np.uint64)


SHARED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("more", pa.int64())])


def shared_terms(batches: Batches) -> Iterator[pa.RecordBatch]:
    """What terms that two sources both have add to their sums, some pairs at a time.

    Takes ``lang, source, ordinal, p, z`` in the order of ``ordinal``.
    """
    sums: dict[tuple[str, str, str], int] = {}

    def flush() -> pa.RecordBatch:
        columns = [*zip(*sums, strict=True), sums.values()] if sums else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, SHARED, strict=True)], schema=SHARED)

    for piece in _pieces(batches):
        langs, sources = (piece[c].combine_chunks().dictionary_encode() for c in ("lang", "source"))
        index = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
        ordinal, p, z = (piece[c].to_numpy() for c in ("ordinal", "p", "z"))
        groups, index = np.unique(index, return_inverse=True)
        keys, values = [], []
        for step in range(1, len(ordinal)):
            pairs = np.flatnonzero(ordinal[step:] == ordinal[:-step])
            if not pairs.size:
                break
            for a, b in ((pairs, pairs + step), (pairs + step, pairs)):
                more = _gap(p[a], p[b]) - _gap(p[a], z[b]) - _gap(z[a], p[b]) + _gap(z[a], z[b])
                key, value = _summed(index[a] * len(groups) + index[b], more.view(np.int64))
                keys.append(key)
                values.append(value)
        if not keys:
            continue
        lang_names, source_names = langs.dictionary.to_pylist(), sources.dictionary.to_pylist()
        names = [(lang_names[g // len(source_names)], source_names[g % len(source_names)]) for g in groups.tolist()]
        key, value = _summed(np.concatenate(keys), np.concatenate(values))
        for pair, n in zip(key.tolist(), value.tolist(), strict=True):
            (lang, source), (_, item) = names[pair // len(names)], names[pair % len(names)]
            sums[lang, source, item] = sums.get((lang, source, item), 0) + n
        if len(sums) > PAIRS:
            yield flush()
            sums.clear()
    yield flush()


def _pieces(batches: Batches) -> Iterator[pa.Table]:
    """Whole terms, about 50,000 rows at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows > 50_000:
            table = pa.Table.from_batches(held)
            ordinal = table["ordinal"].to_numpy()
            changes = np.flatnonzero(np.diff(ordinal))
            if changes.size:
                end = int(changes[-1]) + 1
                yield table.slice(0, end)
                held = table.slice(end).to_batches()
                rows = table.num_rows - end
    if rows:
        yield pa.Table.from_batches(held)


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, listed: int = TERMS, broadcast: int = BROADCAST, block: int = BLOCK) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every group."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    docs = docs.select(*named, utf8("text").alias("text"))
    known = vocabulary(docs, least)
    counts = recount(docs, transducers(known, block), broadcast)

    # One row per group, with its table of counts: at most about the root of twice its words.
    kept = known.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(kept, "lang", "left")
    groups = groups.na.fill(0, ["total", "v"])
    groups = groups.withColumn("z", F.when(F.col("v") > 0, share(F.lit(0), "total", "v")))
    groups = groups.withColumn("lang_total", F.sum("total").over(Window.partitionBy("lang")))
    groups = stored(groups, "groups")

    rows = counts.withColumn("lang_n", F.sum("n").over(Window.partitionBy("ordinal")))
    rows = rows.join(groups, ["lang", "source"])
    figures = [share("n", "total", "v").alias("p"), "z", share("lang_n", "lang_total", "v").alias("q")]
    rows = stored(rows.select("lang", "source", "ordinal", *figures), "term-shares")
    return _pairs(groups, rows).unionByName(_terms(rows, known, listed))


def _pairs(groups: DataFrame, rows: DataFrame) -> DataFrame:
    ordered = rows.select("lang", "source", "ordinal", "p", "z").repartition("ordinal").sortWithinPartitions("ordinal")
    more = on_workers(ordered).mapInArrow(shared_terms, "lang string, source string, item string, more long")
    more = more.groupBy("lang", "source", "item").agg(F.sum("more").alias("more"))

    tables = rows.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("n"))
    tables = tables.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "n")).alias("table"))
    groups = groups.join(tables, ["lang", "source"], "left").select("lang", "source", "v", "z", "table")
    groups = stored(groups, "count-tables")
    left = groups.withColumn("bucket", F.pmod(F.hash("source"), F.lit(BUCKETS)))
    every = F.explode(F.array(*[F.lit(i) for i in range(BUCKETS)])).alias("bucket")
    right = groups.select("lang", F.col("source").alias("item"), F.col("z").alias("y"), F.col("table").alias("other"), every)
    both = left.join(right, ["lang", "bucket"]).filter(F.col("source") != F.col("item"))

    none = gap(F.col("z"), F.col("y"))
    zero = F.lit(0).cast("long")

    def alone(table: str, one) -> Column:
        """The sum over one side's terms, as if the other had none of them."""
        added = F.aggregate(table, zero, lambda s, t: s + t["n"] * (one(t["p"]) - none))
        return F.coalesce(added, zero)

    value = F.col("v") * none + alone("table", lambda p: gap(p, F.col("y"))) + alone("other", lambda p: gap(F.col("z"), p))
    both = both.join(more, ["lang", "source", "item"], "left")
    value = F.when(F.col("v") > 0, value + F.coalesce("more", zero)).otherwise(zero)
    both = both.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return both.withColumn("rank", F.row_number().over(order))


def _terms(rows: DataFrame, known: DataFrame, listed: int) -> DataFrame:
    above = rows.filter(F.col("p") > F.col("q")).select("lang", "source", "ordinal", gap(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    best = stored(above.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= listed), "best-terms")
    named = best.join(known.select("ordinal", F.col("term").alias("item")), "ordinal")
    return named.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


DIVERGENCE_SQL = r"""
with d as (
  select row_number() over () as row_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
words as (select row_id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
tf as (select row_id, lang, source, term, count(*) as n from words group by all),
kept as (select lang, term from tf group by all having count(*) >= 3),
counts as (select lang, source, term, sum(n) as n from tf join kept using (lang, term) group by all),
groups as (select distinct lang, source from d),
size as (select lang, count(*) as v from kept group by all),
totals as (select lang, source, coalesce(sum(n), 0)::hugeint as total from groups left join counts using (lang, source) group by all),
lang_totals as (select lang, sum(total)::hugeint as total from totals group by all),
shares as (
  select lang, source, term, coalesce(n, 0) as n, 1 + (1000000000::hugeint * (coalesce(n, 0) + 1)) // (total + v) as p
  from kept join size using (lang) join totals using (lang) left join counts using (lang, source, term)),
lang_shares as (
  select lang, term, 1 + (1000000000::hugeint * (sum(n)::hugeint + 1)) // (any_value(total) + any_value(v)) as q
  from counts join size using (lang) join lang_totals using (lang) group by lang, term),
summed as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::bigint as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join summed s on s.lang = a.lang and s.source = a.source and s.item = b.source),
terms as (
  select lang, source, 'term' as part, term as item, (((p - q) * (p - q)) // q)::bigint as value
  from shares join lang_shares using (lang, term) where n > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as rank
  from (select * from pairs union all select * from terms))
select lang, source, part, item, value, rank::int as rank from ranked where part = 'pair' or rank <= 200
"""
