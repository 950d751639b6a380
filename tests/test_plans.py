"""Physical plans: pruned scans, pushed filters, no Python, top-k without a full sort."""

from __future__ import annotations

import re

import pytest
from plan_text import plan
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from opinara.operators import panels
from opinara.operators.filters import of_class, recent
from opinara.plans import fixtures
from opinara.schema import PREDICTION
from opinara.session import work_folder
from opinara.sources.sinks import write_batch
from opinara.sources.tables import scan_predictions

PYTHON_NODES = re.compile(r"PythonUDF|ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas|MapInArrow")


@pytest.fixture(scope="module")
def stored(spark, small):
    path = work_folder(spark, "plan-predictions")
    columns = [f.name for f in PREDICTION.fields if f.name != "kafka_timestamp"]
    write_batch(fixtures.predictions(spark, small, *columns), path, 0, time="processed_ts")
    return scan_predictions(spark, path)


def schema_read(text):
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*?)>(?:\n|$|,? )", text).group(1)))


def test_scan_reads_only_what_a_panel_needs(stored):
    assert schema_read(plan(panels.top_by_key(stored, "asin"))) == {"asin", "label", "processed_ts"}
    assert schema_read(plan(panels.by_rating(stored))) == {"overall", "label"}


def test_filters_reach_the_scan(stored):
    text = plan(of_class(stored, "neutral"))
    assert "PushedFilters: [IsNotNull(label), EqualTo(label,neutral)]" in text


def test_recent_rows_skip_the_others(spark):
    """Row groups outside the window are not read."""
    path = work_folder(spark, "plan-times")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("decimal(18,6)"))
    rows = spark.range(500_000).select("id", (start + step).alias("processed_ts"), F.lit(True).alias("is_realtime"))
    rows.coalesce(1).write.option("parquet.block.size", str(1 << 20)).parquet(path)
    last = F.lit("2024-01-06 18:53:19").cast("timestamp")
    found = recent(spark.read.parquet(path), last, "5 MINUTES")
    assert len(found.collect()) == 301
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numOutputRows").value() < 100_000


def test_top_rows_need_no_full_sort(stored):
    assert "TakeOrderedAndProject" in plan(panels.top_by_key(stored, "asin"))
    assert "TakeOrderedAndProject" in plan(panels.recent_cards(stored, "asin"))


def test_all_panels_scan_once_and_limit_before_ranking(stored):
    text = plan(panels.all_panels(stored))
    assert "WindowGroupLimit" in text
    assert text.count("FileScan") == 1


def test_counts_are_combined_before_the_shuffle(stored):
    assert "partial_count" in plan(panels.top_by_key(stored, "asin"))


@pytest.mark.parametrize("name", ["offline_panels", "balance_exact", "lemma_fold", "tfidf", "train_nb", "score_nb", "kde_length", "clean_serve"])
def test_no_python_and_no_cross_join(spark, small, name):
    text = plan(entry_points.queries()[name](spark, small))
    assert not PYTHON_NODES.search(text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_recent_rows_read_their_days_only(stored):
    text = plan(recent(stored, F.lit("2024-01-01 02:00:00").cast("timestamp"), "1 HOUR"))
    assert re.search(r"PartitionFilters: \[[^]]*date", text)
