"""Quality rules as a short-circuit cascade.

Method. Each rule looks at one text and either rejects it or not; a text is
kept if no rule rejects it. Rules differ in cost and in how much they reject. On
the first ``SAMPLE`` texts of its partition, every task runs all rules, timing
each and counting rejections; from then on it runs them by rejections per
second, highest first, and stops at the first that rejects. The order decides
only the cost: the verdict is the same in any order, on any partitioning and
after any retry.

On Spark. One pass over the texts in Arrow batches, no shuffle. ``quality_filter``
short-circuits; ``quality_report`` also gives the counts, so there the rules
find most of their work done.

Defined results. Null and empty texts have no words and fail. Rows are judged
each on its own, so ties and repeated rows change nothing. A very long text is
judged whole; its task holds all its words at once. An empty table gives no rows.
Other columns are passed on untouched, whatever their names.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import map_rows, on_workers, slices, utf8
from opinara.llm.pieces import forget_pieces

#: Texts of each partition on which all rules are timed.
SAMPLE = 64
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
FEWEST_WORDS = 20
REPEATED_PERCENT = 30
SYMBOLS_PER_WORD = 0.3
DUPLICATE_LINE_SHARE = 0.5
MEAN_WORD = (2.0, 20.0)
SHOUTED_SHARE = 0.6
LEAST_LETTERS = 0.5
STUTTER_SHARE = 0.3

NOT_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())
NOT_UPPER = bytes(b for b in range(256) if not (b < 128 and chr(b).isupper()))
NOT_LOWER = bytes(b for b in range(256) if not (b < 128 and chr(b).islower()))


class Text:
    """One text; each figure is worked out when a rule first asks for it."""

    def __init__(self, text: bytes) -> None:
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def joined(self) -> bytes:
        return b"".join(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.joined) if self.joined.isascii() else len(self.joined.decode("utf-8", "replace"))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.text) - len(self.text.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.text.split(b"\n") if line and not line.isspace()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        return repeated_words(self.words)

    @cached_property
    def n_stutters(self) -> int:
        """Words equal to the one before."""
        return sum(map(eq, self.words, islice(self.words, 1, None)))

    @cached_property
    def upper(self) -> int:
        return len(self.text.translate(None, NOT_UPPER))

    @cached_property
    def lower(self) -> int:
        return len(self.text.translate(None, NOT_LOWER))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows of ``window`` words that occur twice or more in the text.

    Windows are told apart by a sum of word hashes; those that share one are
    then compared word by word.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    sums = np.zeros(n, np.uint64)
    for i in range(window):
        sums *= np.uint64(0x9E3779B97F4A7C15)
        sums += hashes[i : i + n]
    order = np.argsort(sums, kind="stable")
    equal = sums[order[1:]] == sums[order[:-1]]
    if not equal.any():
        return 0
    alike = np.zeros(n, bool)
    alike[order[1:][equal]] = alike[order[:-1][equal]] = True
    places = np.flatnonzero(alike).tolist()
    seen = Counter(tuple(words[i : i + window]) for i in places)
    covered = np.zeros(len(words) + 1, np.int64)
    for i in places:
        if seen[tuple(words[i : i + window])] > 1:
            covered[i] += 1
            covered[i + window] -= 1
    return int((np.cumsum(covered) > 0).sum())


def too_short(t: Text) -> bool:
    return t.n_words < FEWEST_WORDS


def repetitive(t: Text) -> bool:
    return 100 * t.n_repeat_words > REPEATED_PERCENT * t.n_words


def symbolic(t: Text) -> bool:
    return t.n_symbols > SYMBOLS_PER_WORD * t.n_words


def repeated_lines(t: Text) -> bool:
    return t.n_dup_lines > DUPLICATE_LINE_SHARE * len(t.lines)


def odd_words(t: Text) -> bool:
    return not MEAN_WORD[0] * t.n_words <= t.word_chars <= MEAN_WORD[1] * t.n_words


def shouting(t: Text) -> bool:
    return t.upper > SHOUTED_SHARE * (t.upper + t.lower)


def few_letters(t: Text) -> bool:
    return len(t.joined.translate(None, NOT_LETTERS)) < LEAST_LETTERS * len(t.joined)


def stuttering(t: Text) -> bool:
    return t.n_stutters > STUTTER_SHARE * t.n_words


Rule = Callable[[Text], bool]
BASE: tuple[Rule, ...] = (too_short, repetitive)
RULES: tuple[Rule, ...] = (*BASE, symbolic, repeated_lines, odd_words, shouting, few_letters, stuttering)


class Cascade:
    """Runs rules in the order found best on the first texts."""

    def __init__(self, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> None:
        self.rules, self.left = list(rules), sample
        self.cost = dict.fromkeys(rules, 0.0)
        self.rejected = dict.fromkeys(rules, 0)

    def keeps(self, text: Text) -> bool:
        if self.left <= 0:
            return not any(rule(text) for rule in self.rules)
        verdict = True
        for rule in self.rules:
            alone = Text(text.text)  # a rule's cost holds what it has to work out itself
            began = time.perf_counter()
            rejects = rule(alone)
            self.cost[rule] += time.perf_counter() - began
            self.rejected[rule] += rejects
            verdict &= not rejects
        self.left -= 1
        if self.left == 0:
            self.rules.sort(key=lambda r: self.rejected[r] / max(self.cost[r], 1e-9), reverse=True)
        return verdict


REPORT = pa.schema(
    [("doc_id", pa.int64())]
    + [(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [("base_failed", pa.bool_()), ("kept", pa.bool_())]
)
REPORT_DDL = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean"
)


def _report(rows: Iterable[tuple]) -> Iterator[tuple]:
    cascade = Cascade()
    for doc_id, text in rows:
        t = Text(text)
        counts = (t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words)
        failed = any(rule(t) for rule in BASE)
        kept = cascade.keeps(t)
        yield doc_id, *counts, failed, kept and not failed


def quality_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The counts, ``base_failed`` and ``kept`` of every row of ``docs``."""
    return map_rows(docs.select(F.col(key).cast("long"), utf8(text)), _report, REPORT, REPORT_DDL)


def quality_filter(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, all columns kept."""
    schema = docs.schema
    place = [c.lower() for c in docs.columns].index(text.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_pieces()
        cascade = Cascade(rules)
        for batch in (part for whole in batches for part in slices(whole)):
            # A view of the text's own bytes: a copy beside it would double the batch.
            texts = batch.column(place)
            texts = texts.cast(pa.binary() if pa.types.is_string(texts.type) else pa.large_binary())
            yield batch.filter(pa.array([cascade.keeps(Text(t or b"")) for t in texts.to_pylist()], pa.bool_()))

    return on_workers(docs).mapInArrow(run, schema)


# The window sums compare whole windows as strings; words have no line feed or space in them.
RULES_SQL = """
with w as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words
  from documents),
windows as (
  select doc_id, i, array_to_string(words[i:i + 7], ' ') as win
  from (select doc_id, words, unnest(range(1, len(words) - 6)) as i from w)),
twice as (select doc_id, win from windows group by doc_id, win having count(*) > 1),
places as (
  select doc_id, count(distinct p) as n_repeat_words
  from (select doc_id, unnest(range(i, i + 8)) as p from windows join twice using (doc_id, win))
  group by doc_id),
lines as (
  select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
  from (select doc_id, unnest(string_split(t, chr(10))) as line from w)
  where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by doc_id),
base as (
  select w.doc_id, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_lines, 0) as n_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) as n_upper, length(regexp_replace(t, '[^a-z]', '', 'g')) as n_lower,
    strlen(regexp_replace(array_to_string(words, ''), '[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]', '', 'g')) as n_letters,
    strlen(array_to_string(words, '')) as n_bytes,
    len(list_filter(range(1, len(words)), lambda i: words[i] = words[i + 1])) as n_stutters
  from w left join lines using (doc_id) left join places using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
  not (n_words < 20 or 100 * n_repeat_words > 30 * n_words or n_symbols > 0.3::double * n_words
    or n_dup_lines > 0.5::double * n_lines or word_chars < 2.0::double * n_words or word_chars > 20.0::double * n_words
    or n_upper > 0.6::double * (n_upper + n_lower) or n_letters < 0.5::double * n_bytes
    or n_stutters > 0.3::double * n_words) as kept
from base
"""
