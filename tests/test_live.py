"""Live windows with watermark and state, and the rows that come too late for them."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from opinara.session import work_folder
from opinara.streaming import windows
from opinara.streaming.store import start_store

SCHEMA = "processed_ts timestamp_ntz, label string, confidence double"
LABELS = ("positive", "neutral", "negative", "unknown", None)
START = dt.datetime(2024, 1, 1, 23, 0)
LATENESS = "10 minutes"


def row(minutes, i=0):
    return START + dt.timedelta(minutes=minutes), LABELS[i % 5], None if i % 7 == 0 else 0.5


# Three micro-batches; the second and third hold rows far behind the newest ones before them, and some just in time.
PARTS = [
    [row(i / 3, i) for i in range(120)],
    [row(40 + i / 3, i) for i in range(90)] + [row(m, int(m)) for m in (3, 5, 29, 29.5, 31, 38)],
    [row(75 + i, i) for i in range(20)] + [row(2, 1), row(58.9, 2), row(59.1, 3), row(70, 4)],
]


def minute(time):
    return time.replace(second=0, microsecond=0)


def expected():
    """Late rows with their batch, the others, and up to where minutes are closed, by the rule."""
    late, kept, newest = [], [], None
    for i, part in enumerate(PARTS):
        bound = newest and newest - dt.timedelta(minutes=10)
        for r in part:
            end = minute(r[0]) + dt.timedelta(minutes=1)
            if bound and end <= bound:
                late.append((i, r))
            else:
                kept.append(r)
        newest = max(r[0] for r in part + ([(newest,)] if newest else []))
    bound = newest - dt.timedelta(minutes=10)
    return late, kept, bound


@pytest.fixture(scope="module")
def arrived(spark):
    """Each part is sent and read by queries that are started anew."""
    folder, closed, sliding, late, bounds = (work_folder(spark, f"live-{n}") for n in ("in", "closed", "sliding", "late", "bounds"))
    checkpoints = [work_folder(spark, f"live-c{i}") for i in range(3)]
    states = []
    for part in PARTS:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(SCHEMA).parquet(folder)
        minutes = windows.flat_minutes(windows.closing_minutes(stream, LATENESS))
        queries = [
            start_store(minutes, closed, checkpoints[0], {"availableNow": True}, time=windows.MINUTE),
            start_store(windows.closing_headlines(stream, LATENESS), sliding, checkpoints[1], {"availableNow": True}, time=None),
            windows.start_late_rows(stream, late, bounds, checkpoints[2], LATENESS, availableNow=True),
        ]
        for q in queries:
            q.awaitTermination()
        states.append(queries[0].recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    return {n: spark.read.parquet(p) for n, p in (("closed", closed), ("sliding", sliding), ("late", late), ("bounds", bounds))}, states


def test_closed_minutes_are_written_once(arrived):
    late, kept, bound = expected()
    closed = [r for r in kept if minute(r[0]) + dt.timedelta(minutes=1) <= bound]
    found = arrived[0]["closed"].collect()
    assert Counter({r.minute: r.total_reviews for r in found}) == Counter(minute(r[0]) for r in closed)
    assert len({r.minute for r in found}) == len(found)
    for name in ("positive", "neutral", "negative"):
        assert sum(r[name] for r in found) == sum(r[1] == name for r in closed)
    assert sum(r.confidence_sum for r in found) == pytest.approx(sum(r[2] or 0 for r in closed))


def test_closed_minutes_late_rows_and_open_state_are_all_rows(arrived):
    _, kept, bound = expected()
    waiting = sum(minute(r[0]) + dt.timedelta(minutes=1) > bound for r in kept)
    counted = arrived[0]["closed"].agg(F.sum("total_reviews")).first()[0]
    assert counted + arrived[0]["late"].count() + waiting == sum(map(len, PARTS))


def test_state_holds_open_minutes_only(arrived):
    assert len(arrived[1]) == 3 and max(arrived[1]) <= 11


def test_late_rows_are_set_aside_as_they_are(arrived):
    late, _, _ = expected()
    found = arrived[0]["late"].select("processed_ts", "label", "confidence").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(str(r) for _, r in late)
    observed = {r.batch_id: (r.rows, r.late_rows) for r in arrived[0]["bounds"].collect()}
    counts = Counter(i for i, _ in late)
    assert observed == {i: (len(part), counts[i]) for i, part in enumerate(PARTS)}


def test_headlines_slide_over_closed_minutes(arrived):
    _, kept, bound = expected()
    want = Counter()
    for r in kept:
        for back in range(5):
            start = minute(r[0]) - dt.timedelta(minutes=back)
            if start + dt.timedelta(minutes=5) <= bound:
                want[start] += 1
    found = arrived[0]["sliding"].collect()
    assert {r.window_start: r.total_reviews for r in found} == dict(want)
    assert all(r.window_end - r.window_start == dt.timedelta(minutes=5) for r in found)


def test_a_repeated_batch_of_late_rows_replaces_the_first_attempt(spark):
    path, bounds, checkpoint = (work_folder(spark, f"late-{n}") for n in ("rows", "bounds", "c"))
    spark.createDataFrame([('{"id":"q"}',)], "value string").coalesce(1).write.text(f"{checkpoint}/metadata")
    write = windows._late_sink(path, bounds, checkpoint, LATENESS)
    frames = [spark.createDataFrame(p, SCHEMA) for p in PARTS]
    write(frames[0], 0)
    write(frames[1], 1)
    write(frames[1], 1)
    empty = frames[1].limit(0)
    write(empty, 2)
    write(frames[2], 3)
    assert spark.read.parquet(path).count() == len(expected()[0])
    assert spark.read.parquet(bounds).count() == 4
