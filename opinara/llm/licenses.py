"""Licence scan: identifier tags, notice phrases and licence expressions.

Method. An Aho-Corasick automaton holds all notice phrases and the words of the
identifier tag, and finds every place of every one in a single pass over a
text's words. After a tag the raw text is read as a licence expression: a
shunting-yard parser turns identifiers, parentheses and the operators ``WITH``,
``AND`` and ``OR`` (binding in this order) into postfix form, which is then
evaluated: ``OR`` takes the freer side, ``AND`` the stricter one, an exception
loosens its licence. A phrase inside a longer one found at the same place (the
general in the lesser general public license) keeps its base label, but adds
nothing else. A text's ``score`` is the freedom of the strictest thing found in
it, from 0 to 1; 0 also where nothing is found.

On Spark. One pass over the texts, no shuffle; the automaton is built once in
each worker from a fixed list.

Defined results. A null text is an empty one: no words, nothing found, places
null. An unknown identifier has the label of its name and a freedom of 0.5. An
expression ends where its grammar does; what stands before counts. It ends with
its line unless a bracket is open, which goes over line ends and the comment signs
after them. Operators in lower case are words of a sentence unless a known
identifier follows. Very long texts are read whole, in memory in proportion to the
text. Repeated rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import map_rows, utf8

#: The phrases every scan counts, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Further notice phrases and their labels.
NOTICES = {
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "isc license": "isc",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "licensed under cc by": "cc-by",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by sa": "cc-by-sa",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
}
#: Freedom of a label: how little a licence asks of those who use a text.
FREEDOM = {
    "public-domain": 1.0,
    "cc0": 1.0,
    "unlicense": 1.0,
    "mit": 0.95,
    "isc": 0.95,
    "zlib": 0.95,
    "bsd": 0.9,
    "apache": 0.9,
    "cc-by": 0.85,
    "epl": 0.6,
    "mpl": 0.6,
    "lgpl": 0.5,
    "cc-by-sa": 0.4,
    "gpl": 0.3,
    "agpl": 0.2,
    "cc-by-nc": 0.1,
    "proprietary": 0.05,
}
UNKNOWN = 0.5
EXCEPTION = 0.2
TAG = "spdx license identifier"
TAG_TEXT = re.compile(r"spdx[^0-9a-z\n]+license[^0-9a-z\n]+identifier[^0-9a-z(\n]*", re.IGNORECASE)
TOKEN = r"(?:([()])|([0-9A-Za-z][0-9A-Za-z.:+-]*))"
#: The next part of an expression: on its line, or, inside brackets, beyond line ends and comment signs.
ON_LINE = re.compile(r"[ \t]*+" + TOKEN)
BRACKETED = re.compile(r"(?:[ \t\r]|\n[ \t]*+(?:#++|\*++(?!/)|/{2,}+|;++|--)?)*+" + TOKEN)
BINDS = {"OR": 1, "AND": 2, "WITH": 3}

#: Words as they are scanned: A-Z lower-cased; everything but digits, letters and non-ASCII is a space.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@cache
def automaton():
    """Finds phrases, each between spaces, in words joined by one space."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase, label in {**BASE, **NOTICES, TAG: None}.items():
        found.add_word(f" {phrase} ", (phrase, label))
    found.make_automaton()
    return found


def joins(text: str, at: int, name: str, bracketed: bool) -> bool:
    """Whether ``name``, which ends at ``at``, is an operator there: in capitals, or before a known identifier."""
    if name.upper() not in BINDS or name.isupper():
        return name.upper() in BINDS
    while match := (BRACKETED if bracketed else ON_LINE).match(text, at):
        bracket, following = match.groups()
        if following:
            return family(following) in FREEDOM or name.upper() == "WITH" and "exception" in following.lower()
        if bracket == ")":
            break
        at, bracketed = match.end(), True
    return False


def postfix(text: str, start: int) -> list[str]:
    """The licence expression at ``start``, in postfix form, by shunting-yard."""
    out: list[str] = []
    waiting: list[str] = []
    operand, at = True, start  # whether an operand has to come next
    while match := (BRACKETED if "(" in waiting else ON_LINE).match(text, at):
        bracket, name = match.groups()
        if operand and bracket == "(":
            waiting.append("(")
        elif operand and name and name.upper() not in BINDS:
            out.append(name)
            operand = False
        elif not operand and bracket == ")" and "(" in waiting:
            while (top := waiting.pop()) != "(":
                out.append(top)
        elif not operand and name and joins(text, match.end(), name, "(" in waiting):
            operator = name.upper()
            while waiting and waiting[-1] != "(" and BINDS[waiting[-1]] >= BINDS[operator]:
                out.append(waiting.pop())
            waiting.append(operator)
            operand = True
        else:
            break
        at = match.end()
    if operand and waiting and waiting[-1] != "(":
        waiting.pop()  # an operator without its right side
    return out + [w for w in reversed(waiting) if w != "("]


def family(identifier: str) -> str:
    """The label of an identifier: the longest known family it begins with, else its own name."""
    name = identifier.lower().rstrip("+.")
    known = [f for f in FREEDOM if name == f or name.startswith(f + "-")]
    return max(known, key=len, default=name)


def evaluate(items: list[str]) -> tuple[float, set[str]]:
    """Freedom and labels of an expression in postfix form."""
    stack: list[tuple[float, set[str]]] = []
    for item in items:
        if item not in BINDS:
            label = family(item)
            stack.append((FREEDOM.get(label, UNKNOWN), {label}))
            continue
        if len(stack) < 2:
            continue  # what an unclosed bracket leaves
        right, left = stack.pop(), stack.pop()
        if item == "WITH":
            stack.append((min(1.0, left[0] + EXCEPTION), left[1]))
        else:
            pick = max if item == "OR" else min
            stack.append((pick(left[0], right[0]), left[1] | right[1]))
    return min((s[0] for s in stack), default=1.0), set().union(*(s[1] for s in stack))


def scan(text: bytes) -> tuple[int, int, int | None, int | None, str, str, float]:
    """Words, base places, first and last of them, base labels, all labels, score."""
    words = text.translate(FOLDED).split()
    # One character a byte keeps positions; the phrases are ASCII.
    joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
    places, base_labels, labels, freedom = [], set(), set(), []
    longest: list[tuple[int, int, str]] = []  # begin, end and label of phrases that lie in no other
    word, upto, tagged = 0, 0, False
    for end, (phrase, label) in automaton().iter(joined):
        begin = end - len(phrase) - 1
        if label is None:
            tagged = True
            continue
        # Ends come in order: a phrase can only lie in one with the same end, or hold those before it.
        if not longest or longest[-1][1] < end or longest[-1][0] > begin:
            while longest and longest[-1][0] >= begin:
                longest.pop()
            longest.append((begin, end, label))
        if phrase in BASE:
            # Ends come in order, starts nearly so: count on from the last place, or anew.
            if begin < upto:
                word, upto = 0, 0
            word += joined.count(" ", upto, begin)
            upto = begin
            places.append(word)
            base_labels.add(label)
    labels |= base_labels.union(label for _, _, label in longest)
    freedom += [FREEDOM[label] for _, _, label in longest]
    if tagged:
        raw = text.decode("utf-8", "replace")
        for tag in TAG_TEXT.finditer(raw):
            if items := postfix(raw, tag.end()):
                value, names = evaluate(items)
                labels |= names
                freedom.append(value)
    first, last = (min(places), max(places)) if places else (None, None)
    score = float(min(freedom, default=0.0))
    return len(words), len(places), first, last, ",".join(sorted(base_labels)), ",".join(sorted(labels)), score


FOUND = pa.schema(
    [("doc_id", pa.int64())]
    + [(c, pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")]
    + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
)
FOUND_DDL = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double"
)


def _scanned(rows: Iterable[tuple]) -> Iterator[tuple]:
    for doc_id, text in rows:
        yield doc_id, *scan(text)


def license_scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """What ``scan`` finds in every row of ``docs``."""
    return map_rows(docs.select(F.col(key).cast("long"), utf8(text)), _scanned, FOUND, FOUND_DDL)
