"""What the operators share: reading tables, Arrow batches, words."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinara.session import on_workers, stored

__all__ = ["fresh", "keep_one", "map_rows", "numbered", "on_workers", "row_hash", "slices", "stored", "table", "text_blocks", "utf8"]

#: The space characters of ``[^\x20\x09-\x0D]+``; ``bytes.split`` cuts at the same ones.
SPACES = b" \t\n\r\x0b\x0c"
#: Texts are worked through in pieces of about this many bytes, so that a very long one needs no more memory.
BLOCK = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: Column | str) -> Column:
    """A text as its UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def row_hash(text: Column | str) -> Column:
    """Tells rows apart that share an id, by their text."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_one(docs: DataFrame, found: DataFrame, group: str) -> DataFrame:
    """The one row of ``docs`` that stays of each group, all columns kept.

    ``found`` is a written table with a row for each one of ``docs``: its ``doc_id``, ``row_hash``, the group's name in
    the column ``group``, and ``kept``, true where the row has the id that stays. Of rows with that id (or without one,
    where a group has none) the one with the smallest hash of its text stays; of rows that repeat id and text any one.
    Only keys are moved, and rows that repeat; those are combined before they are shuffled, so none is a hot one.
    """
    kept = found.filter("kept")
    ties = kept.groupBy(group).agg(F.min("row_hash").alias("first_hash"), F.count(F.lit(1)).alias("n"))
    ties = stored(ties.filter("n > 1").select(group, "first_hash"), "ties")
    lost = kept.join(ties, group).filter("row_hash <> first_hash")
    gone = found.filter("not kept").select("doc_id", "row_hash").union(lost.select("doc_id", "row_hash"))
    again = kept.join(ties, group, "left_semi").groupBy("doc_id", "row_hash").count().filter("count > 1")
    gone = stored(gone.select(F.col("doc_id").alias("gone_id"), F.col("row_hash").alias("gone_hash")).distinct(), "gone")
    again = stored(again.select(F.col("doc_id").alias("gone_id"), F.col("row_hash").alias("gone_hash")), "repeated")

    def met(keys: DataFrame) -> Column:
        return docs["doc_id"].eqNullSafe(keys["gone_id"]) & (row_hash(docs["text"]) == keys["gone_hash"])

    left = docs.join(gone, met(gone), "left_anti")
    name = fresh(docs, "row_hash")
    repeated = left.join(again, met(again), "left_semi").withColumn(name, row_hash("text"))
    repeated = repeated.dropDuplicates(["doc_id", name]).drop(name)
    return left.join(again, met(again), "left_anti").union(repeated)


#: Rows that go to one output batch at most.
ROWS = 4096
#: Rows of an input batch that are made plain values together.
SLICE = 256


def map_rows(df: DataFrame, make: Callable[..., Iterable[tuple]], schema: pa.Schema, ddl: str) -> DataFrame:
    """``make(rows)`` for the rows of each partition, an iterator of tuples; it gives tuples.

    Batches stay in Arrow form on both sides; Python sees plain values.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            row for batch in batches for part in slices(batch) for row in zip(*(c.to_pylist() for c in part.columns), strict=True)
        )
        out: list[tuple] = []
        for row in make(rows):
            out.append(row)
            if len(out) >= ROWS:
                yield as_batch(out, schema)
                out = []
        if out:
            yield as_batch(out, schema)

    return on_workers(df).mapInArrow(run, ddl)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, so that few of its rows are plain values at a time."""
    return (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE))


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def text_blocks(text: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """Consecutive pieces of ``text``, each cut right before a space character, so no word is cut."""
    start, n = 0, len(text)
    while n - start > size:
        end = min((p for p in (text.find(s, start + size) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if p >= 0), default=n)
        yield text[start:end]
        start = end
    if start < n:
        yield text[start:]


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``ordinal``, the place of each row in ``order``, from 0; as a written table.

    A sort by range; only row counts per part meet in one place. ``df`` is read twice, so it should be a written table.
    Rows that ``order`` cannot tell apart go to one part: add a column that can, where there may be many.
    """
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    place, part, before = fresh(df, "place"), fresh(df, "part"), fresh(df, "before")
    # The id holds the part in its upper bits and the place in the part below them.
    ordered = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered = stored(ordered.withColumn(place, F.monotonically_increasing_id()), name)
    ordered = ordered.withColumn(part, F.shiftright(place, 33))
    sizes = stored(ordered.groupBy(part).agg(F.count(F.lit(1)).alias("rows")), f"{name}-sizes")
    sizes = sizes.select(part, (F.sum("rows").over(Window.orderBy(part)) - F.col("rows")).alias(before))
    ordinal = F.col(before) + F.col(place).bitwiseAND((1 << 33) - 1)
    return stored(ordered.join(sizes, part).select(ordinal.alias("ordinal"), *df.columns), f"{name}-numbered")
