"""A quality classifier: a generalised additive model with pairwise interactions.

Method. Each feature is cut into bins at quantiles. Boosting goes round the
features, fitting in turn a shallow tree on one feature's bins to what is still
unexplained, and adds a small part of it to that feature's table. Then the pairs
of features whose coarse grid explains most of the rest are boosted in the same
way with trees that split both. What remains are lookup tables: a score is the
logistic of the sum of one table entry per feature and pair, added up for a whole
batch at a time.

On Spark. The features of all texts are worked out in one pass and written, a
narrow table. The model is fitted on the driver on at most ``SAMPLE`` labelled
rows, chosen by hash of the id; scoring is a pass over the features. Inputs are
figures of the text alone.

Defined results. A null text is an empty one; it is scored like any other.
Without labels every score is 0.5; with labels of one class only the score is
near that class. A null id is not held out and never used for training; repeated
rows are scored each. A very long text is measured whole; its task holds all its
words at once. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import map_rows, on_workers, stored, utf8

#: Labelled rows that reach the driver, at most.
SAMPLE = 20_000
FOLDS = 5
BINS = 48
COARSE = 8
PAIRS = 8
ROUNDS = 200
PAIR_ROUNDS = 60
RATE = 0.1
SMOOTH = 1.0
THRESHOLD = 0.3

UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
LOWER = bytes(b for b in range(256) if not 97 <= b <= 122)
DIGITS = bytes(range(48, 58))
FEATURES = (
    "log_words",
    "mean_word",
    "symbols",
    "bars",
    "marks",
    "stops",
    "upper",
    "digits",
    "not_ascii",
    "distinct",
    "top_word",
    "pairs_again",
    "repeated_neighbours",
    "short_words",
    "longest_word",
    "line_words",
    "repeated_lines",
    "open_lines",
)


def features(text: bytes) -> list[float]:
    """The figures named in ``FEATURES``."""
    words = text.split()
    n, size = len(words), max(1, len(text))
    some = max(1, n)
    counts = Counter(words)
    lengths = [len(w) for w in counts]
    lines = [line.rstrip() for line in text.split(b"\n") if line and not line.isspace()]
    upper = len(text.translate(None, UPPER))
    letters = max(1, upper + len(text.translate(None, LOWER)))
    neighbours = Counter(zip(words, words[1:], strict=False))
    return [
        np.log1p(n),
        sum(map(len, words)) / some,
        (size - len(text.translate(None, b"#*$%&<>"))) / some if text else 0.0,
        text.count(b"|") / some,
        (text.count(b"!") + text.count(b"?")) / some,
        (text.count(b".") + text.count(b",")) / some,
        upper / letters,
        (size - len(text.translate(None, DIGITS))) / size if text else 0.0,
        0.0 if text.isascii() else 1 - len(text.decode("utf-8", "replace")) / size,
        len(counts) / some,
        max(counts.values(), default=0) / some,
        1 - len(neighbours) / max(1, n - 1) if n > 1 else 0.0,
        sum(c for (a, b), c in neighbours.items() if a == b) / some,
        sum(c for w, c in counts.items() if len(w) <= 3) / some,
        float(max(lengths, default=0)),
        n / max(1, len(lines)),
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        sum(not line.endswith((b".", b"!", b"?")) for line in lines) / max(1, len(lines)),
    ]


@dataclass
class Additive:
    """Edges of the bins, and a table for every feature and pair."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> np.ndarray:
        found = [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(self.edges)]
        return np.array(found, np.int64).reshape(len(self.edges), len(x))

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        binned = self.bins(x)
        for table, b in zip(self.tables, binned, strict=True):
            total += table[b]
        for (i, j), table in self.pairs.items():
            total += table[binned[i], binned[j]]
        return 1 / (1 + np.exp(-total))


def _leaf(g, h):
    return g / (h + SMOOTH)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of ordered bins; place 0: none."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl * _leaf(gl, hl) + gr * _leaf(gr, hr) - g.sum() * _leaf(g.sum(), h.sum())
    best = int(gain.argmax())
    return float(gain[best]), best + 1


def tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """The step of a tree of few leaves over ordered bins with gradients ``g`` and weights ``h``."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        cuts = [(*_best_cut(g[a:b], h[a:b]), k) for k, (a, b) in enumerate(parts)]
        gain, at, k = max(cuts)
        if gain <= 0:
            break
        a, b = parts[k]
        parts[k : k + 1] = [(a, a + at), (a + at, b)]
    out = np.empty(len(g))
    for a, b in parts:
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _cut_rows(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ordered bins the worth of its best cut, and that cut's place; 0: uncut."""
    gl, hl = np.cumsum(g, axis=1), np.cumsum(h, axis=1)
    gr, hr = gl[:, -1:] - gl, hl[:, -1:] - hl
    worth = gl * _leaf(gl, hl) + gr * _leaf(gr, hr)
    worth = np.c_[worth[:, -1:], worth[:, :-1]]  # a cut after the last bin is none
    return worth.max(axis=1), worth.argmax(axis=1)


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and step of a tree on a grid: the cut of the rows that leaves the best cuts of the columns on either side.

    So it sees effects that only the two features together have.
    """
    above = np.cumsum(g, axis=0), np.cumsum(h, axis=0)
    worth, columns = _cut_rows(*above)
    below, other = _cut_rows(above[0][-1] - above[0], above[1][-1] - above[1])
    row = int((worth + below).argmax())
    out = np.zeros_like(g)
    for rows, cut in ((slice(0, row + 1), columns[row]), (slice(row + 1, None), other[row])):
        for part in (slice(0, cut), slice(cut, None)):
            if g[rows, part].size:
                out[rows, part] = _leaf(g[rows, part].sum(), h[rows, part].sum())
    return float((worth + below)[row] - g.sum() * _leaf(g.sum(), h.sum())), out


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Boost tables for the rows ``x`` with labels ``y`` (0 or 1)."""
    model = Additive()
    if not len(x):
        return model
    rate = np.clip(y.mean(), 0.001, 0.999)
    model.base = float(np.log(rate / (1 - rate)))
    for i in range(x.shape[1]):
        cuts = np.unique(np.quantile(x[:, i], np.linspace(0, 1, BINS + 1)[1:-1]))
        model.edges.append(cuts)
        model.tables.append(np.zeros(len(cuts) + 1))
    binned = model.bins(x)
    total = np.full(len(x), model.base)

    def unexplained() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for i, table in enumerate(model.tables):
            g, h = unexplained()
            step = RATE * tree(np.bincount(binned[i], g, len(table)), np.bincount(binned[i], h, len(table)))
            table += step
            total += step[binned[i]]

    def grid(g: np.ndarray, h: np.ndarray, rows: np.ndarray, columns: np.ndarray, shape: tuple[int, int]) -> tuple:
        at = rows * shape[1] + columns
        return tuple(np.bincount(at, v, shape[0] * shape[1]).reshape(shape) for v in (g, h))

    g, h = unexplained()
    coarse = [b * COARSE // len(t) for b, t in zip(binned, model.tables, strict=True)]
    gains = []
    for i, j in combinations(range(x.shape[1]), 2):
        small = grid(g, h, coarse[i], coarse[j], (COARSE, COARSE))
        gains.append((pair_tree(*small)[0], i, j))
    chosen = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
    model.pairs = {(i, j): np.zeros((len(model.tables[i]), len(model.tables[j]))) for i, j in chosen}
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in model.pairs.items():
            g, h = unexplained()
            step = RATE * pair_tree(*grid(g, h, binned[i], binned[j], table.shape))[1]
            table += step
            total += step[binned[i], binned[j]]
    return model


ROWS = pa.schema([("doc_id", pa.int64()), ("features", pa.list_(pa.float64()))])
SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def _features(rows: Iterable[tuple]) -> Iterator[tuple]:
    for doc_id, text in rows:
        yield doc_id, features(text)


def feature_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, features`` of every row, written once."""
    found = map_rows(docs.select(F.col(key).cast("long"), utf8(text)), _features, ROWS, "doc_id long, features array<double>")
    return stored(found, "features")


def held_out(doc_id: Column) -> Column:
    """Whether an id belongs to the fold that is never trained on."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(rows: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Additive:
    """Fit on the features and labels of at most ``sample`` ids that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
    known = known.filter(~held_out(F.col("doc_id")) & F.col("label").isNotNull() & F.col("doc_id").isNotNull())
    n = known.count()
    if n > sample:
        # A little less than asked for, so that the limit only guards the bound.
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(0.95 * sample / n * (1 << 30)))
    found = rows.join(known, "doc_id").select("doc_id", "label", "features").limit(sample).toArrow()
    if not found.num_rows:
        return Additive()
    found = found.sort_by([("doc_id", "ascending"), ("label", "ascending")])
    x = np.array(found["features"].to_pylist(), float).reshape(found.num_rows, -1)
    return fit(x, found["label"].to_numpy())


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    rows = feature_table(docs, key, text)
    model = train(rows, labels, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            scores = model.scores(x)
            columns = [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= THRESHOLD).astype("int32"))]
            yield pa.RecordBatch.from_arrays(columns, schema=SCORES)

    ready = rows.select("doc_id", held_out(F.col("doc_id")), "features")
    return on_workers(ready).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
