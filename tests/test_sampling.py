"""Balancing, cutting and splitting."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from opinara.operators import sampling
from opinara.operators.ranking import first_of_group, group_cuts, mark_first


def labelled(spark, sizes, partitions=4):
    rows, key = [], 0
    for label, n in sizes.items():
        for _ in range(n):
            rows.append((key, label))
            key += 1
    return spark.createDataFrame(rows, "id long, label string").repartition(partitions)


def md5(key):
    return hashlib.md5(str(key).encode()).hexdigest()


@pytest.mark.parametrize("hex_digits", [1, 2, 4])
@pytest.mark.parametrize("quota", [0, 1, 37, 100, 500])
def test_marks_the_first_in_hash_order(spark, hex_digits, quota):
    df = labelled(spark, {"a": 300, "b": 100, "c": 5})
    cuts = group_cuts(df, "label", "id", lambda n, largest: F.lit(quota), hex_digits)
    marked = mark_first(df, "label", "id", cuts).collect()
    assert len(marked) == 405
    for label, n in {"a": 300, "b": 100, "c": 5}.items():
        mine = [r for r in marked if r.label == label]
        first = set(sorted((r.id for r in mine), key=md5)[:quota])
        assert {r.id for r in mine if r.chosen} == first
        assert {(r.group_rows, r.largest_rows) for r in mine} == {(n, 300)}


def test_selection_does_not_depend_on_partitions(spark):
    one = first_of_group(labelled(spark, {"a": 50, "b": 20}, 1), "label", "id", lambda *_: F.lit(10))
    many = first_of_group(labelled(spark, {"a": 50, "b": 20}, 7), "label", "id", lambda *_: F.lit(10))
    assert sorted(one.collect()) == sorted(many.collect())


def test_exact_balance(spark):
    df = labelled(spark, {"a": 103, "b": 10, "c": 1})
    out = sampling.balance_exact(df, "id").collect()
    assert Counter(r.label for r in out) == {"a": 103, "b": 103, "c": 103}
    per_row = Counter(r.id for r in out if r.label == "b")
    assert set(per_row.values()) == {10, 11}
    assert {r.id for r in out} == {r.id for r in df.collect()}
    assert all(set(r.copy for r in out if r.id == i) == set(range(1, n + 1)) for i, n in per_row.items())


def test_many_copies_are_spread(spark, monkeypatch):
    monkeypatch.setattr(sampling, "CHUNK", 7)
    out = sampling.balance_exact(labelled(spark, {"a": 100, "b": 3}), "id").collect()
    assert Counter(r.label for r in out) == {"a": 100, "b": 100}
    assert len({(r.id, r.copy) for r in out}) == 200


def test_sampled_balance_stays_within_bounds(spark):
    df = labelled(spark, {"a": 400, "b": 90, "c": 20})
    df = df.withColumn("label", F.when(F.col("label") == "a", "positive").when(F.col("label") == "b", "neutral").otherwise("negative"))
    out = sampling.balance_sampled(df, "id").collect()
    counts = Counter(r.label for r in out)
    assert counts["positive"] == 400
    assert 250 < counts["neutral"] <= 400
    assert 200 < counts["negative"] <= 400
    assert len({(r.id, r.copy) for r in out}) == len(out)


def test_equal_classes_need_no_sampling(spark):
    df = spark.createDataFrame([(0, "positive"), (1, "neutral"), (2, "negative")], "id long, label string")
    assert sampling.balance_sampled(df, "id").count() == 3


def test_downsample_by_number_and_share(spark):
    df = labelled(spark, {"a": 100, "b": 10})
    assert Counter(r.label for r in sampling.downsample(df, "a", "id", rows=30).collect()) == {"a": 70, "b": 10}
    assert Counter(r.label for r in sampling.downsample(df, "a", "id", share=0.5).collect()) == {"a": 50, "b": 10}
    assert Counter(r.label for r in sampling.downsample(df, "a", "id", rows=1000).collect()) == {"b": 10}
    assert Counter(r.label for r in sampling.downsample(df, "a", "id", share=1.0).collect()) == {"b": 10}


def test_random_split_is_complete_and_disjoint(spark):
    df = labelled(spark, {"a": 1500, "b": 500})
    parts = {n: {r.id for r in p.collect()} for n, p in sampling.split_random(df).items()}
    assert sum(len(p) for p in parts.values()) == 2000
    assert set.union(*parts.values()) == set(range(2000))
    assert 1500 < len(parts["train"]) < 1700
    assert 130 < len(parts["val"]) < 270


def test_hash_split_does_not_depend_on_partitions(spark):
    splits = [dict((r.id, r.split) for r in sampling.split_hash(labelled(spark, {"a": 1000}, p), "id").collect()) for p in (1, 5)]
    assert splits[0] == splits[1]
    counts = Counter(splits[0].values())
    assert 740 < counts["train"] < 860 and 60 < counts["val"] < 140 and 60 < counts["test"] < 140


def test_no_copy_crosses_the_split(spark):
    df = labelled(spark, {"a": 300, "b": 30})
    out = sampling.balanced_splits(df, "id").collect()
    homes = {}
    for r in out:
        homes.setdefault(r.id, set()).add(r.split)
    assert all(len(h) == 1 for h in homes.values())
    train = Counter(r.label for r in out if r.split == "train")
    assert train["a"] == train["b"]


def test_leaky_order_spreads_copies(spark):
    out = sampling.balanced_splits(labelled(spark, {"a": 300, "b": 30}), "id", leaky=True).collect()
    assert Counter(r.label for r in out) == {"a": 300, "b": 300}
    homes = {}
    for r in out:
        homes.setdefault(r.id, set()).add(r.split)
    assert any(len(h) > 1 for h in homes.values())


def test_null_and_unknown_classes_stay(spark):
    rows = [(i, "positive") for i in range(9)] + [(20 + i, None) for i in range(4)] + [(30 + i, "other") for i in range(2)]
    df = spark.createDataFrame(rows, "id long, label string")
    assert Counter(r.label for r in sampling.union_classes(df).collect()) == {"positive": 9, None: 4, "other": 2}
    assert Counter(r.label for r in sampling.balance_exact(df, "id").collect()) == {"positive": 9, None: 9, "other": 9}
    assert Counter(r.label for r in sampling.limit_class(df, 3, "id").collect()) == {"positive": 3, None: 3, "other": 2}
    drawn = Counter(r.label for r in sampling.balance_sampled(df, "id").collect())
    assert set(drawn) <= {"positive", None, "other"} and drawn["positive"] == 9 and max(drawn.values()) == 9


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, label string")
    for out in (sampling.balance_sampled(df, "id"), sampling.balance_exact(df, "id"), sampling.union_classes(df)):
        assert out.count() == 0


def test_a_tiny_class_is_drawn_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sampling, "CHUNK", 50)
    out = sampling.balance_sampled(labelled(spark, {"a": 1000, "b": 2}), "id").collect()
    drawn = Counter(r.label for r in out)
    assert 700 < drawn["b"] <= drawn["a"] == 1000
    assert len({(r.id, r.copy) for r in out}) == len(out)


def test_hashed_draws_do_not_depend_on_partitions(spark):
    df = labelled(spark, {"a": 300, "b": 40, "c": 3, None: 7})
    first, second = (sorted(map(str, sampling.balance_hashed(df.repartition(p), "id").collect())) for p in (1, 7))
    assert first == second
    assert first != sorted(map(str, sampling.balance_hashed(df, "id", seed=7).collect()))
    whole = Counter(r.label for r in sampling.balance_hashed(df, "id").collect())
    assert whole["a"] == 300 and all(150 < whole[c] <= 300 for c in ("b", "c", None))
    rows = sampling.balance_hashed(df, "id").collect()
    assert len({(r.id, r.copy) for r in rows}) == len(rows)


def test_hashed_draws_follow_the_poisson_distribution(spark):
    df = labelled(spark, {"a": 40_000, "b": 16_000})
    drawn = sampling.balance_hashed(df, "id", cut=False).filter("label = 'b'").groupBy("id").count().groupBy("count").count()
    found = {r["count"]: r[1] for r in drawn.toLocalIterator()}
    found[0] = 16_000 - sum(found.values())
    for k in range(6):
        share = math.exp(-2.5) * 2.5**k / math.factorial(k)
        assert abs(found[k] - 16_000 * share) < 5 * math.sqrt(16_000 * share)


def test_hashed_draws_of_a_tiny_class_come_in_parts(spark):
    df = labelled(spark, {"a": 5_000, "b": 2})
    found = Counter(r.id for r in sampling.balance_hashed(df, "id", cut=False).filter("label = 'b'").collect())
    assert len(found) == 2 and all(2_200 < n < 2_800 for n in found.values())
    assert sampling.balance_hashed(df.limit(0), "id").count() == 0
