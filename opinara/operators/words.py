"""Words of texts in Arrow batches: every row is cut, counted and coded inside its task, so no word is shuffled to be counted.

The words are those of ``functions.text.train_tokens`` without the stop words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions.text import STOP_WORDS
from opinara.session import on_workers, stored

#: Bytes of text that are counted at once; bounds the memory of a task beside its batch.
PIECE = 16 << 20

# What each byte of a text becomes: letters their lower case, other white space than the space a line end, the rest a space.
_CLEANED = bytes(c if chr(c) in ascii_lowercase else c + 32 if chr(c) in ascii_uppercase else 10 if 9 <= c <= 13 else 32 for c in range(256))
_SPACED = bytes(32 if c == 10 else c for c in range(256))
# Of a character of several bytes only the first stays, so that it becomes one space.
_LATER = bytes(range(0x80, 0xC0))


def _mapped(texts: pa.Array, table: bytes) -> pa.Array:
    """The characters of each text through a table by byte."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    if offsets[0] == offsets[-1]:
        return texts
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    gone = np.flatnonzero((data & 0xC0) == 0x80)
    offsets = (offsets - np.searchsorted(gone, offsets)).astype(np.int32)
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(data.tobytes().translate(table, _LATER)))


def cut(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The row and the code of every word that is no stop word, and the words by code. No text may be null."""
    trimmed = pc.ascii_trim(_mapped(texts.cast(pa.string()), _CLEANED), " ")
    ended = pc.ascii_rtrim(trimmed, " \n")
    # A text of white space only has no word, an empty one an empty word.
    blank = np.asarray(pc.and_(pc.equal(pc.binary_length(ended), 0), pc.greater(pc.binary_length(trimmed), 0)))
    lists = pc.split_pattern(_mapped(ended, _SPACED), " ")
    coded = lists.flatten().dictionary_encode()
    names = coded.dictionary
    codes, rows = np.asarray(coded.indices), np.asarray(pc.list_parent_indices(lists))
    kept = ~np.asarray(pc.is_in(names, pa.array(STOP_WORDS, pa.string())))[codes]
    if blank.any():
        kept &= ~blank[rows]
    return rows[kept], codes[kept], names


def tallied(rows: np.ndarray, codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, code and number of each code of a row, in that order."""
    found, n = np.unique(rows.astype(np.int64) * width + codes, return_counts=True)
    return found // width, found % width, n


def _pieces(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Rows with a text, a few megabytes at a time."""
    for batch in batches:
        batch = batch.filter(pc.is_valid(batch.column(column)))
        ends = np.cumsum(np.asarray(pc.binary_length(batch.column(column)), dtype=np.int64)) // PIECE
        for part in np.split(np.arange(len(ends)), np.flatnonzero(np.diff(ends)) + 1):
            if len(part):
                yield batch.slice(int(part[0]), len(part))


def _on_pieces(df: DataFrame, keys: Sequence[str], column: str, make: Callable[[pa.RecordBatch], pa.RecordBatch], added: str) -> DataFrame:
    """``make`` of the keys and ``_text`` of some rows at a time; it gives the keys it wants and the columns of ``added``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(make, _pieces(batches, "_text"))

    texts = on_workers(df.select(*keys, F.col(column).alias("_text")))
    return texts.mapInArrow(run, T.StructType([*texts.drop("_text").schema.fields, *T.StructType.fromDDL(added).fields]))


def count_rows(df: DataFrame, *keys: str, column: str) -> DataFrame:
    """The keys, each ``term`` of a row and its number ``tf``; and one row without a term for every row with a text."""

    def make(piece: pa.RecordBatch) -> pa.RecordBatch:
        rows, codes, names = cut(piece.column("_text"))
        at, code, n = tallied(rows, codes, max(1, len(names)))
        whole = np.arange(len(piece))
        term = pa.concat_arrays([names.take(pa.array(code)), pa.nulls(len(whole), pa.string())])
        tf = pa.array(np.concatenate([n, np.ones_like(whole)]), pa.int64())
        taken = piece.select(list(keys)).take(pa.array(np.concatenate([at, whole])))
        return pa.RecordBatch.from_arrays([*taken.columns, term, tf], [*keys, "term", "tf"])

    return _on_pieces(df, keys, column, make, "term string, tf bigint")


def _packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """For each row its values, as 32-bit numbers in one run of bytes."""
    data = np.ascontiguousarray(values, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(data)])


def count_pieces(df: DataFrame, label: str, train: str, classes: Sequence[str], column: str) -> DataFrame:
    """Counts in a packed form, as a written table of two kinds of rows, so that few rows are left to be shuffled.

    A task numbers the words of some rows at a time, a ``piece``. Rows without ``code`` are the documents: the ``codes`` and
    numbers ``tfs`` of a document's words, 32 bits each. The others name each ``code`` of a piece: its ``term``, in how many
    documents with ``train`` it is (``df``), and how often in those of each of ``classes`` (``n0``, ``n1``, ...).
    """
    keys = [c for c in df.columns if c != column]
    sums = [f"n{i}" for i in range(len(classes))]
    told = ["piece", "codes", "tfs", "code", "term", "df", *sums]

    def make(piece: pa.RecordBatch, number: int) -> pa.RecordBatch:
        rows, codes, names = cut(piece.column("_text"))
        # Only words that are kept have a code.
        found = np.flatnonzero(np.bincount(codes, minlength=len(names)))
        fresh = np.zeros(len(names), np.int64)
        fresh[found] = np.arange(len(found))
        codes = fresh[codes]
        at, code, n = tallied(rows, codes, max(1, len(found)))
        ends = np.searchsorted(at, np.arange(len(piece) + 1))
        trained = np.asarray(pc.fill_null(piece.column(train), False))
        labels = np.asarray(pc.fill_null(pc.index_in(piece.column(label), pa.array(classes, pa.string())), -1))
        own = trained[at]
        learned = [np.bincount(code[own], minlength=len(found))]
        learned += [np.bincount(code[m], n[m], len(found)) for m in (own & (labels[at] == i) for i in range(len(classes)))]
        docs, terms = len(piece), len(found)

        def column_of(kind: pa.DataType, of_docs: pa.Array | None, of_terms: pa.Array | None) -> pa.Array:
            parts = [pa.nulls(n, kind) if a is None else a for a, n in ((of_docs, docs), (of_terms, terms))]
            return pa.concat_arrays(parts)

        made = [column_of(piece.schema.field(k).type, piece.column(k), None) for k in keys]
        made.append(pa.array(np.full(docs + terms, number, np.int64)))
        made += [column_of(pa.binary(), _packed(x, ends), None) for x in (code, n)]
        made.append(column_of(pa.int32(), None, pa.array(np.arange(terms, dtype=np.int32))))
        made.append(column_of(pa.string(), None, names.take(pa.array(found))))
        made += [column_of(pa.int64(), None, pa.array(x.astype(np.int64))) for x in learned]
        return pa.RecordBatch.from_arrays(made, keys + told)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for number, piece in enumerate(_pieces(batches, "_text")):
            yield make(piece, first + number)

    texts = on_workers(df.withColumnRenamed(column, "_text"))
    added = "piece bigint, codes binary, tfs binary, code int, term string, df bigint"
    fields = T.StructType.fromDDL(", ".join([added, *[f"{s} bigint" for s in sums]])).fields
    kept = [T.StructField(k, df.schema[k].dataType) for k in keys]
    return stored(texts.mapInArrow(run, T.StructType([*kept, *fields])), "piece-counts")


def piece_sums(pieces: DataFrame, gains: DataFrame, key: str, classes: Sequence[str]) -> DataFrame:
    """``key`` and for each class the sum of a document's counts times its terms' ``gains``, a row of numbers per term.

    Each term of a piece meets its gains once, however many documents hold it; then a piece is added up in one task, where
    it holds as much as ``PIECE`` bytes of text do.
    """
    names = pieces.filter(F.col("code").isNotNull()).select("piece", "code", "term")
    known = names.join(gains.hint("shuffle_hash"), "term").select("piece", "code", *classes)
    docs = pieces.filter(F.col("code").isNull()).select(F.col("piece").alias("_piece"), key, "codes", "tfs")
    schema = T.StructType([pieces.schema[key], *[T.StructField(c, T.DoubleType()) for c in classes]])

    def add(of_docs: pa.Table, of_terms: pa.Table) -> pa.Table:
        codes, tfs = (np.frombuffer(b"".join(of_docs[c].to_pylist()), np.int32) for c in ("codes", "tfs"))
        ends = np.cumsum(np.asarray(pc.binary_length(of_docs["codes"]), dtype=np.int64)) // 4
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        some = starts[: len(ends)] < ends
        places = np.asarray(of_terms["code"])
        out = []
        for c in classes:
            gain = np.zeros(max(codes.max(initial=0), places.max(initial=0)) + 1)
            gain[places] = np.asarray(of_terms[c])
            total = np.zeros(len(ends))
            if some.any():
                total[some] = np.add.reduceat((tfs * gain[codes]).astype(np.longdouble), starts[: len(ends)][some])
            out.append(pa.array(total))
        return pa.Table.from_arrays([of_docs[key], *out], [key, *classes])

    return docs.groupBy("_piece").cogroup(known.groupBy("piece")).applyInArrow(add, schema)


def term_totals(df: DataFrame, column: str) -> DataFrame:
    """``term, df, total`` of all rows: a task adds up its rows piece by piece, Spark the pieces."""

    def make(piece: pa.RecordBatch) -> pa.RecordBatch:
        rows, codes, names = cut(piece.column("_text"))
        width = max(1, len(names))
        _, code, _ = tallied(rows, codes, width)
        found = [np.bincount(c, minlength=width)[: len(names)] for c in (code, codes)]
        kept = pa.array(found[1] > 0)
        out = pa.RecordBatch.from_arrays([names, *[pa.array(f, pa.int64()) for f in found]], ["term", "df", "total"])
        return out.filter(kept)

    found = _on_pieces(df, [], column, make, "term string, df bigint, total bigint")
    return found.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def vectors(df: DataFrame, *keys: str, column: str, vocabulary: Sequence[str], name: str) -> DataFrame:
    """The keys and the sparse vector ``name`` of each row's counts of the vocabulary's words, as a written table.

    Equal to those of Spark ML's count vectorizer. A task looks up each different word of a piece once.
    """
    size = len(vocabulary)
    held = df.sparkSession.sparkContext.broadcast(pa.array(vocabulary, pa.string()))

    def make(piece: pa.RecordBatch) -> pa.RecordBatch:
        rows, codes, names = cut(piece.column("_text"))
        place = np.asarray(pc.fill_null(pc.index_in(names, held.value), -1), dtype=np.int64)[codes]
        at, index, n = tallied(rows[place >= 0], place[place >= 0], max(1, size))
        ends = pa.array(np.searchsorted(at, np.arange(len(piece) + 1)), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (index.astype(np.int32), n.astype(np.float64))]
        made = [pa.array(np.full(len(piece), x, t)) for x, t in ((0, np.int8), (size, np.int32))]
        vector = pa.StructArray.from_arrays([*made, *lists], ["type", "size", "indices", "values"])
        return pa.RecordBatch.from_arrays([*piece.select(list(keys)).columns, vector], [*keys, name])

    form = "struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"
    rows = _on_pieces(df, keys, column, make, f"{name} {form}")
    as_vectors = T.StructType([*rows.schema.fields[:-1], T.StructField(name, VectorUDT())])
    return stored(rows, name.replace("_", "-"), as_vectors)
