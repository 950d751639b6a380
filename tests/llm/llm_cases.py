"""Rows with all that may go wrong."""

from __future__ import annotations

import random

import xxhash
from pyspark.sql import types as T

#: Columns of ``documents``, and more whose names the operators use inside.
EXTRA = ["digest", "bits", "utf8", "Pieces", "part", "queue", "digest_"]
DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("lang", "source")]
    + [T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in EXTRA]
)
WORDS = "the of and in to a is it for that with as was on be by at from this are über été señor naïve".split()


def prose(seed: int, n: int) -> str:
    """Made-up sentences that share no long passage with those of another seed."""
    rng = random.Random(seed)
    words = [rng.choice(WORDS) + rng.choice(["", "", "x", "zen", "ly"]) + str(rng.randrange(40) if rng.random() < 0.1 else "") for _ in range(n)]
    return " ".join(w + ("." if i % 11 == 10 else "") for i, w in enumerate(words))


LONG = prose(1, 60_000)
#: id and text of rows with all that may go wrong.
ODD = [
    (10, prose(2, 120)),
    (11, prose(2, 120).upper()),  # equal to 10 but for case, save beyond ASCII
    (12, prose(3, 200) + " " + prose(2, 120)),  # holds all of 10
    (13, prose(4, 80)),
    (14, prose(4, 80)),  # equal to 13
    (14, prose(4, 80)),  # a repeated row
    (15, ""),
    (16, None),
    (17, " \n\t \n"),
    (18, LONG),
    (19, "tail " + LONG),
    (20, "one"),
    (21, "one two"),
    (22, "MIT License\nMIT LICENSE mit-license"),
    (23, "  wide spaces　and\x0bold\x1cones ﻿\U0001f600 é"),
    (24, "same same same " * 40),
    (None, prose(4, 80)),  # equal to 13, without an id
    (None, None),
    (25, prose(5, 70) + "\r\n" + prose(4, 80)[:-3]),
    (9, prose(6, 30) + "\n" + prose(3, 200)),  # holds what 12 begins with
]


def documents(spark, rows=ODD):
    filled = [(i, t, "en", None if i == 13 else f"src{(i or 0) % 3}", None if t is None else len(t), *EXTRA) for i, t in rows]
    return spark.createDataFrame(filled, DOCS)


def one_each(rows, group, id_of):
    """The row that stays of each group: the id ``id_of`` picks, of ties the smallest hash of the text, of equals one."""
    groups = {}
    for i, t in rows:
        groups.setdefault(group(t), []).append((i, t))
    out = []
    for members in groups.values():
        ids = [i for i, _ in members if i is not None]
        name = id_of(ids) if ids else None
        signed = {t: xxhash.xxh64_intdigest((t or "").encode(), 42) for i, t in members if i == name}
        signed = {t: h - (1 << 64) if h >> 63 else h for t, h in signed.items()}
        out.append((name, min(signed, key=signed.get)))
    return out


#: The same row many times over, rows that tie for an id, and groups without any id.
REPEATED = [
    *[(400, prose(101, 90))] * 50,
    (400, prose(101, 90).upper()),
    *[(None, prose(102, 90))] * 9,
    (None, prose(102, 90).upper()),
    *[(401, prose(103, 300))] * 3,
    (401, prose(103, 300) + " tail"),
    (399, prose(103, 300)),
]
