"""Target-distribution importance resampling: draw documents that look like a target.

Method. A text is a bag of word runs, each hashed by CRC-32 into one of a fixed
number of buckets. How much more often a bucket occurs in the target than in the
corpus is its gain; a document's weight is the mean gain of its runs, and the
highest weights after Gumbel noise from a hash of the id are drawn, which is
sampling without replacement in proportion to the weights. CRCs are worked out
for many features at once: features that differ are grouped by length into
byte matrices, and all CRCs of a matrix are moved on column by column; buckets
are then scattered back to the places where the features occur.

On Spark. One pass cuts and hashes the texts and writes each document's buckets,
two bytes a feature; counts, weights and scores come from that table. Counts are
summed in the tasks first; what reaches the driver is one number per bucket. The
draw cuts the counts of scores, whose range is bounded by the gains and the noise,
and only documents at or above the cut are sorted, by range.

Defined results. A null or empty text has no features, weight 0 and, with fewer
than ``LEAST_WORDS`` words, no rank. A null id is hashed as an empty one and comes
last among equals; rows that repeat an id are documents of their own. A very long
text is cut into words a block at a time; its buckets are held together, two
bytes a feature. Without target texts all gains follow from the corpus alone.
Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.common import map_rows, numbered, on_workers, slices, stored, text_blocks, utf8

BUCKETS = 10_000
#: Features are runs of so many words.
RUNS = (1, 1)
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
#: Features that are hashed at a time, and words whose buckets a task remembers.
BATCH = 1 << 17
REMEMBERED = 1 << 18

#: Bytes of words to their lower case, all others to a space.
LOWER = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
#: The reversed polynomial of CRC-32, a fixed value.
POLYNOMIAL = 0xEDB88320


def _steps() -> np.ndarray:
    """What each value of the lowest byte adds to a CRC."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(POLYNOMIAL), table >> 1)
    return table


STEPS = _steps()


def crc_matrices(features: list[bytes]) -> np.ndarray:
    """CRC-32 of each feature."""
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(lengths, kind="stable")
    out = np.empty(len(features), np.uint32)
    ends = np.flatnonzero(np.diff(lengths[order], append=-1)) + 1
    start = 0
    for end in ends.tolist():
        rows = order[start:end]
        start, length = end, int(lengths[rows[0]])
        matrix = np.frombuffer(b"".join([features[i] for i in rows.tolist()]), np.uint8).reshape(len(rows), length)
        crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        for column in matrix.T:
            crc = STEPS[(crc ^ column) & np.uint32(0xFF)] ^ crc >> np.uint32(8)
        out[rows] = ~crc
    return out


class Hasher:
    """Buckets of features; those of the words met before are remembered up to a bound."""

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self.known: dict[bytes, int] = {}

    def __call__(self, features: list[bytes]) -> np.ndarray:
        new = list(dict.fromkeys(features).keys() - self.known.keys())
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = list(dict.fromkeys(features))
        self.known.update(zip(new, (crc_matrices(new) % self.buckets).tolist(), strict=True))
        return np.fromiter(map(self.known.__getitem__, features), np.uint16 if self.buckets <= 1 << 16 else np.uint32, len(features))


def runs(text: bytes, shortest: int, longest: int) -> Iterator[tuple[int, list[bytes]]]:
    """Number of words and all features of a text, a block at a time."""
    before: list[bytes] = []
    for block in text_blocks(text.translate(LOWER)):
        words = block.split()
        found = words if shortest == 1 else []
        for n in range(max(2, shortest), longest + 1):
            lead = before[len(before) - n + 1 :] if n - 1 <= len(before) else before
            both = lead + words
            found = found + [b" ".join(both[i : i + n]) for i in range(len(both) - n + 1)]
        before = (before + words)[max(0, len(before) + len(words) - longest + 1) :] if longest > 1 else []
        yield len(words), found


HASHED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("buckets", pa.binary())])
HASHED_DDL = "doc_id long, n_words long, n_features long, buckets binary"


def hashed(docs: DataFrame, buckets: int = BUCKETS, lengths: tuple[int, int] = RUNS, key: str | None = "doc_id") -> DataFrame:
    """``doc_id, n_words, n_features, buckets`` of every row, the buckets as numbers in place of its features."""

    def make(rows: Iterable[tuple]) -> Iterator[tuple]:
        hasher = Hasher(buckets)
        open_rows: list[list] = []  # id, words, features, buckets, features that wait
        waiting: list[bytes] = []

        def hash_waiting() -> None:
            found, at = hasher(waiting), 0
            for row in open_rows:
                row[3].append(found[at : at + row[4]].tobytes())
                at, row[4] = at + row[4], 0
            waiting.clear()

        for doc_id, text in rows:
            row = [doc_id, 0, 0, [], 0]
            open_rows.append(row)
            for n_words, features in runs(text, *lengths):
                row[1], row[2], row[4] = row[1] + n_words, row[2] + len(features), row[4] + len(features)
                waiting += features
                if len(waiting) > BATCH:
                    hash_waiting()
            if not waiting:
                yield from ((*r[:3], b"".join(r[3])) for r in open_rows)
                open_rows = []
        hash_waiting()
        yield from ((*r[:3], b"".join(r[3])) for r in open_rows)

    ids = (F.col(key) if key else F.lit(None)).cast("long")
    return map_rows(docs.select(ids, utf8("text")), make, HASHED, HASHED_DDL)


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: a task sends one row for each of its buckets."""
    width = np.uint16 if buckets <= 1 << 16 else np.uint32
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch):
                total += np.bincount(np.frombuffer(b"".join(part.column(0).to_pylist()), width), minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], schema=schema)

    found = on_workers(rows.select("buckets")).mapInArrow(run, "bucket int, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How much each bucket speaks for the target, in thousandths; one number per bucket reaches the driver."""

    def filled(counts: DataFrame, name: str) -> DataFrame:
        every = counts.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
        n = F.coalesce("n", F.lit(0)).cast("double")
        return every.join(counts, "bucket", "left").select("bucket", n.alias(name), F.sum(n).over(Window.partitionBy()).alias(f"{name}_all"))

    both = filled(corpus, "s").join(filled(target, "t"), "bucket")
    one, all_ = F.lit(1.0), F.lit(float(buckets))
    ratio = (F.col("t") + one) * (F.col("s_all") + all_) / ((F.col("s") + one) * (F.col("t_all") + all_))
    found = both.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long")).collect()
    return np.array([gain for _, gain in sorted(map(tuple, found))], np.int64)


def weights(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """The floored mean of the gains of each row's features."""
    width = np.uint16 if len(gain) <= 1 << 16 else np.uint32
    schema = pa.schema([*list(HASHED)[:3], ("weight", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy()
            sums = [int(gain[np.frombuffer(b, width)].sum()) for part in slices(batch) for b in part.column(3).to_pylist()]
            found = np.array(sums, np.int64) // np.maximum(sizes, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found)], schema=schema)

    return on_workers(rows).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def drawn(scored: DataFrame, least: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """``scored``, a written table, with the rank of the drawn rows."""
    able = F.col("n_words") >= least
    # Scores are whole numbers of a bounded range, so this table is small whatever the number of documents.
    counts = stored(scored.filter(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")), "score-counts")
    wanted = (counts.agg(F.sum("n")).first()[0] or 0) * percent // 100
    upto = F.sum("n").over(Window.orderBy(F.desc("score")))
    cut = counts.select("score", upto.alias("upto")).filter(F.col("upto") >= wanted).agg(F.max("score")).first()[0] if wanted else None
    if cut is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    high = able & (F.col("score") >= cut)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.col("weight"), F.col("n_features"), F.col("row")]
    ranked = numbered(stored(scored.filter(high), "high-scores"), order, "drawn")
    rank = F.when(F.col("ordinal") < wanted, F.col("ordinal") + 1).cast("long")
    return ranked.select(*scored.columns, rank.alias("rank")).unionByName(scored.filter(~high).withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = BUCKETS,
    lengths: tuple[int, int] = RUNS,
    least: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``; ``target`` has a column ``text``."""
    rows = stored(hashed(docs, buckets, lengths), "buckets")
    gain = gains(bucket_counts(rows, buckets), bucket_counts(hashed(target, buckets, lengths, None), buckets), buckets)
    score = (F.col("weight") + noise(F.col("doc_id"), seed)).cast("long")
    # The row's number tells rows apart that repeat an id, so that any number of them can be sorted.
    scored = weights(rows, gain).select("*", score.alias("score"), F.monotonically_increasing_id().alias("row"))
    return drawn(stored(scored, "scores"), least, percent).select("doc_id", "n_features", "weight", "score", "rank")


RESAMPLING_SQL = r"""
with steps as (
  select list(c order by i) as tab from (
    select i, list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
    from range(256) t(i))),
d as (
  select row_number() over () as row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents),
b as (
  select unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from benchmark),
w as (select row_id, unnest(words) as word from d),
hexed as (select word, hex(encode(word)) as h from (select word from w union select word from b)),
bytes as (select word, list_transform(range(1, length(h), 2), lambda i: ('0x' || substr(h, i, 2))::bigint) as bytes from hexed),
hashed as (
  select word, xor(list_reduce(list_prepend(4294967295::bigint, bytes),
    lambda c, k: xor(c >> 8, tab[(xor(c, k) & 255) + 1])), 4294967295::bigint) % 10000 as bucket
  from bytes, steps),
s as (select bucket, count(*) as n from w join hashed using (word) group by bucket),
t as (select bucket, count(*) as n from b join hashed using (word) group by bucket),
gains as (
  select i as bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::double * ((select coalesce(sum(n), 0) from s) + 10000)::double
    / ((coalesce(s.n, 0) + 1)::double * ((select coalesce(sum(n), 0) from t) + 10000)::double)))::bigint as gain
  from range(10000) r(i) left join s on s.bucket = i left join t on t.bucket = i),
means as (select row_id, floor(sum(gain)::double / count(*))::bigint as weight from w join hashed using (word) join gains using (bucket) group by row_id),
scored as (
  select row_id, doc_id, len(words) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
  from d left join means using (row_id)),
ranked as (select row_id, row_number() over (order by score desc, doc_id) as rank from scored where n_features >= 20),
n as (select count(*) * 10 // 100 as n from ranked)
select doc_id, n_features::bigint as n_features, weight, score, case when rank <= n then rank end as rank
from scored left join ranked using (row_id), n
"""
