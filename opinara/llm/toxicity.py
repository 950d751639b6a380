"""Toxic passages by maximum-scoring segments, and the toxicity of whole texts.

Method. Units are words and the first ``STEMS`` letters of longer words. From
labelled documents each unit gets the log-odds of being in a toxic document, with
a Dirichlet prior in proportion to how common the unit is, and the units whose
log-odds are at least ``LEAST_ODDS`` and lie ``LEAST_Z`` standard errors above
zero make the lexicon. A word
scores as its best unit in the lexicon, less when it comes again; any other word has a small negative
score, from how densely toxic documents hold such words. A linear-time scan finds
all maximal scoring segments of a text. In ordinary text the best segment follows
an extreme-value law: its decay solves ``sum p exp(decay * score) = 1`` over the
scores of ordinary words, its scale is fitted to the best segments of documents
that are not toxic. So every segment has the chance of being as good by accident;
minus the logarithms of these chances add up to the figure of a text, and a
logistic curve makes it a score from 0 to 1. Law and curve are fitted on a third
of the documents with a lexicon from the others; the lexicon that scores is then
learned from all.

On Spark. At most about ``SAMPLE`` labelled documents teach, chosen by hash of the
id, and of near copies, which share the least hash of three consecutive words,
one. Their units are counted in tasks and summed; only the lexicon, at most
``LEXICON`` units, and two figures per document of the sample reach the driver.
Scoring is one pass over the texts without a shuffle.

Defined results. A null text is an empty one; texts without words score as any
text without a toxic segment. Without labels every score is 0.5; with labels of
one class the score is near that class. A null id is not held out and teaches
nothing; repeated rows are scored each. A very long text is cut into words a
block at a time; only its toxic words are held. Other columns are not read. An
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import map_rows, stored, text_blocks, utf8

#: Labelled documents that teach, about; and units of the lexicon, at most.
SAMPLE = 20_000
LEXICON = 50_000
FOLDS, HELD_OUT = 4, 2
#: Letters of a word's beginnings that are units of their own.
STEMS = (4, 5, 6)
#: Weight of the prior, in shares of the documents that teach.
PRIOR = 0.05
LEAST_Z = 2.0
LEAST_ODDS = 3.0
THRESHOLD = 0.3
#: Units that a task counts before it sends them on, and words whose scores it remembers.
COUNTED = 1 << 20
REMEMBERED = 1 << 18
#: A segment in a text of any length is at least so unlikely to be an accident.
LEAST_CHANCE = 1e-300

#: Bytes of words to their lower case, all others to a space.
LOWER = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words(text: bytes) -> Iterator[list[bytes]]:
    """All words of a text, a block at a time."""
    for block in text_blocks(text.translate(LOWER)):
        yield block.split()


def units(word: bytes) -> list[bytes]:
    """A word and its beginnings; those end with a star, which no word holds."""
    letters = word.decode("utf-8", "replace")
    return [word, *(letters[:n].encode() + b"*" for n in STEMS if len(letters) > n)]


@dataclass
class Segment:
    """Words ``start`` to ``end`` (not included) of a text; ``low`` and ``high`` are the sums before and at its end."""

    start: int
    end: int
    low: float
    high: float
    #: The nearest segment to the left with a lower sum before it; -1: none.
    left: int = -1

    @property
    def score(self) -> float:
        return self.high - self.low


def segments(hits: Iterable[tuple[int, float]], step: float) -> list[Segment]:
    """All maximal scoring segments of a text in one pass.

    ``hits`` are places and positive scores in ascending order; every other word
    scores ``step``, less than zero. A segment that begins lower and ends lower
    than the new one is joined with it; links to the left skip those that begin
    no lower, so each is passed once.
    """
    found: list[Segment] = []
    total, last = 0.0, -1
    for place, score in hits:
        total += step * (place - last - 1)
        new = Segment(place, place + 1, total, total + score)
        total, last = new.high, place
        while True:
            j = len(found) - 1
            while j >= 0 and found[j].low >= new.low:
                j = found[j].left
            new.left = j
            if j < 0 or found[j].high >= new.high:
                break
            new.start, new.low = found[j].start, found[j].low
            del found[j:]
        found.append(new)
    return found


@dataclass
class Model:
    lexicon: dict[bytes, float] = field(default_factory=dict)
    step: float = -0.1
    decay: float = 1.0
    scale: float = 1.0
    slope: float = 0.0
    base: float = 0.0
    known: dict[bytes, float] = field(default_factory=dict, repr=False)

    def score(self, word: bytes) -> float:
        """Of a word in the lexicon or with a beginning there; else 0."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[word] = max((self.lexicon.get(u, 0.0) for u in units(word)), default=0.0)
        return found

    def hits(self, text: bytes) -> tuple[int, list[tuple[int, float]]]:
        """Number of words, and places and scores of the toxic ones.

        A word's n-th occurrence has the n-th part of its score: a line that is repeated tells little more.
        """
        n, found, seen = 0, [], Counter()
        for some in words(text):
            toxic = {w: s for w in set(some) if (s := self.score(w)) > 0}
            for i, w in enumerate(some) if toxic else ():
                if w in toxic:
                    seen[w] += 1
                    found.append((n + i, toxic[w] / seen[w]))
            n += len(some)
        return n, found

    def chance(self, score: float, n: int) -> float:
        """That ordinary text of ``n`` words has a segment of such a score."""
        return max(LEAST_CHANCE, -math.expm1(-self.scale * n * math.exp(-self.decay * score)))

    def figure(self, n: int, hits: list[tuple[int, float]]) -> float:
        return sum(-math.log(self.chance(s.score, n)) for s in segments(hits, self.step))

    def probability(self, figure: float) -> float:
        return 1 / (1 + math.exp(-min(500.0, max(-500.0, self.slope * figure + self.base))))


def log_odds(toxic: np.ndarray, clean: np.ndarray, all_toxic: int, all_clean: int) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of units in ``toxic`` and ``clean`` documents, and their standard errors."""
    prior = PRIOR * (all_toxic + all_clean)
    own = prior * (toxic + clean) / (all_toxic + all_clean)
    a, b = toxic + own, clean + own
    return np.log(a / (all_toxic + prior - a)) - np.log(b / (all_clean + prior - b)), np.sqrt(1 / a + 1 / b)


def decay(scores: np.ndarray, shares: np.ndarray, step: float) -> float:
    """The positive root of ``sum p exp(decay * score) = 1`` for words of these scores and shares, all others ``step``."""
    rest = 1 - shares.sum()

    def excess(x: float) -> float:
        return float(shares @ np.exp(np.minimum(x * scores, 700.0))) + rest * math.exp(x * step) - 1

    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 1e6:
        low, high = high, high * 2
    if not low:
        while excess(high / 2) > 0 and high > 1e-9:
            high /= 2
        low = high / 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (low, mid) if excess(mid) > 0 else (mid, high)
    return high


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and base for labels ``y``; targets are a little short of 0 and 1, so that no fit runs away."""
    ones = y.sum()
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))
    at = np.zeros(2)
    rows = np.c_[x, np.ones(len(x))]
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ at, -500, 500)))
        slope = rows.T @ (target - p) - np.array([1e-4, 0.0]) * at
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + 1e-6 * np.eye(2)
        move = np.linalg.solve(curve, slope)
        at = at + np.clip(move, -2.0, 2.0)
        if abs(move).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def sketch(text: bytes) -> int | None:
    """The least hash of three consecutive words; most near copies share it."""
    least, before = None, []
    for some in words(text):
        both = before + some
        found = min((xxhash.xxh3_64_intdigest(b" ".join(both[i : i + 3])) for i in range(max(1, len(both) - 2)) if both), default=None)
        least = found if least is None or (found is not None and found < least) else least
        before = both[-2:]
    return None if least is None else least - (1 << 63)


def held_out(doc_id: Column) -> Column:
    """Whether an id belongs to the fold that never teaches."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def teaching(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, toxic, fits, text`` of the documents that teach, as a written table.

    ``fits`` marks those that set the curve instead of the lexicon.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    if n > sample:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(sample / n * (1 << 30)))
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text")).join(known, "doc_id")
    schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("sketch", pa.int64()), ("text", pa.binary())])

    def sketched(rows: Iterable[tuple]) -> Iterator[tuple]:
        return ((doc_id, toxic, sketch(text), text) for doc_id, toxic, text in rows)

    found = map_rows(chosen.select("doc_id", "toxic", "text"), sketched, schema, "doc_id long, toxic int, sketch long, text binary")
    found = stored(found, "sketched")
    first = found.groupBy("sketch").agg(F.min("doc_id").alias("doc_id")).filter("sketch is not null")
    kept = found.join(first.select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    fits = F.pmod(F.xxhash64("sketch", F.lit(1)), F.lit(3)) == 0
    return stored(kept.select("doc_id", "toxic", fits.alias("fits"), "text"), "teaching")


UNITS = pa.schema([("unit", pa.binary()), ("part", pa.int32()), ("n", pa.int64())])
UNITS_DDL = "unit binary, part int, n long"


def _unit_counts(rows: Iterable[tuple]) -> Iterator[tuple]:
    """``unit, part, n``: documents of a task that hold a unit, by part."""
    counts: dict[int, Counter] = {}
    for part, text in rows:
        counts.setdefault(part, Counter()).update(set().union(*map(units, set().union(*words(text)))))
        if sum(map(len, counts.values())) > COUNTED:
            yield from ((unit, p, n) for p, c in counts.items() for unit, n in c.items())
            counts = {}
    yield from ((unit, p, n) for p, c in counts.items() for unit, n in c.items())


def lexicon(counts: DataFrame, toxic: str, clean: str, all_toxic: int, all_clean: int) -> dict[bytes, float]:
    """Units and their log-odds; the bound keeps the surest."""
    if not all_toxic or not all_clean:
        return {}
    # Only units that toxic documents hold clearly more often can be in the lexicon.
    counts = counts.select("unit", F.expr(toxic).alias("toxic"), F.expr(clean).alias("clean"))
    counts = counts.filter(F.col("toxic") * all_clean > 2 * F.col("clean") * all_toxic)
    found = counts.orderBy(F.desc(F.col("toxic") / (F.col("clean") + 1)), "unit").limit(2 * LEXICON).toArrow()
    y, c = (found[name].to_numpy().astype(float) for name in ("toxic", "clean"))
    odds, error = log_odds(y, c, all_toxic, all_clean)
    sure = np.flatnonzero((odds >= LEAST_Z * error) & (odds >= LEAST_ODDS))
    sure = sure[np.argsort(-odds[sure] / error[sure], kind="stable")][:LEXICON]
    return dict(zip(found["unit"].take(pa.array(sure)).to_pylist(), odds[sure].tolist(), strict=True))


HITS = pa.schema([("toxic", pa.int32()), ("n", pa.int64()), ("scores", pa.list_(pa.float64())), ("places", pa.list_(pa.int64()))])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Lexicon, extreme-value law and curve from the labelled documents that are not held out."""
    rows = teaching(docs, labels, sample)
    part = (F.col("fits").cast("int") * 2 + (F.col("toxic") > 0).cast("int")).alias("part")
    sizes = Counter(dict(map(tuple, rows.groupBy(part).agg(F.count(F.lit(1))).collect())))
    model = Model()
    if not sizes:
        return model
    counts = map_rows(rows.select(part, "text"), _unit_counts, UNITS, UNITS_DDL)
    sums = [F.sum(F.when(F.col("part") == p, F.col("n")).otherwise(0)).alias(f"n{p}") for p in range(4)]
    # Units of a single toxic document are never sure.
    counts = stored(counts.groupBy("unit").agg(*sums).filter("n1 + n3 > 1"), "units")
    model.lexicon = lexicon(counts, "n1", "n0", sizes[1], sizes[0])
    labelled = rows.filter("fits") if sizes[2] + sizes[3] else rows
    shared = Model(dict(model.lexicon))

    def hits(part: Iterable[tuple]) -> Iterator[tuple]:
        for toxic, text in part:
            n, found = shared.hits(text)
            yield toxic, n, [s for _, s in found], [p for p, _ in found]

    found = map_rows(labelled.select("toxic", "text"), hits, HITS, "toxic int, n long, scores array<double>, places array<long>")
    # At most as many rows as documents that teach.
    texts = [(int(t > 0), n, list(zip(places, scores, strict=True))) for t, n, scores, places in found.collect()]
    if model.lexicon:
        _fit_law(model, texts)
    figures = np.array([model.figure(n, h) for _, n, h in texts])
    model.slope, model.base = logistic(figures, np.array([t for t, _, _ in texts], float))
    return replace(model, lexicon=lexicon(counts, "n1 + n3", "n0 + n2", sizes[1] + sizes[3], sizes[0] + sizes[2]), known={})


def _fit_law(model: Model, texts: list[tuple[int, int, list[tuple[int, float]]]]) -> None:
    """Step, decay and scale from the texts, each with label, words and toxic words."""

    def density(label: int) -> float:
        some = [(n, len(h)) for t, n, h in texts if t == label]
        return (sum(h for _, h in some) + 0.5) / (sum(n for n, _ in some) + 1)

    model.step = math.log(1 - min(0.5, density(1)))
    # All scores of the lexicon share what ordinary text has of it.
    scores = np.array(list(model.lexicon.values()))
    share = min(density(0), 0.5 * -model.step / float(scores.max()))
    model.decay = decay(scores, np.full(len(scores), share / len(scores)), model.step)
    best = [(n, max((s.score for s in segments(h, model.step)), default=0.0)) for t, n, h in texts if not t]
    weight = sum(n * math.exp(-model.decay * s) for n, s in best)
    model.scale = max(1, len(best)) / max(1.0, weight)


SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = train(docs, labels, sample)

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, held, text in rows:
            score = model.probability(model.figure(*model.hits(text)))
            yield doc_id, held, score, int(score >= THRESHOLD)

    ready = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")), utf8("text"))
    return map_rows(ready, run, SCORES, "doc_id long, held_out boolean, score double, predicted int")


PASSAGES = pa.schema(
    [("doc_id", pa.int64()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("score", pa.float64()), ("chance", pa.float64())]
)


def passages(docs: DataFrame, model: Model, chance: float = 0.01) -> DataFrame:
    """The toxic passages of every text that are no accident: words from ``first_word`` to before ``end_word``."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            n, hits = model.hits(text)
            for s in segments(hits, model.step):
                if model.chance(s.score, n) <= chance:
                    yield doc_id, s.start, s.end, s.score, model.chance(s.score, n)

    ready = docs.select(F.col("doc_id").cast("long"), utf8("text"))
    return map_rows(ready, run, PASSAGES, "doc_id long, first_word long, end_word long, score double, chance double")
