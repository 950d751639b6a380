"""The registered queries of the operators, each with its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from opinara.llm import bpe, divergence, exact, licenses, packing, quality, resampling, rules, simhash, substrings, toxicity, urls, warc
from opinara.llm.common import table
from opinara.plans.registry import Registry

CATALOG = Registry()


@CATALOG.add("op1_simhash_near_dedup")
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("row_hash")


@CATALOG.add("op2_substring_dedup", substrings.SUBSTRINGS_SQL)
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_duplicates(table(spark, sf_dir, "documents"))


@CATALOG.add("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@CATALOG.add("op4_url_filter", urls.URLS_SQL)
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


@CATALOG.add("op5_warc_bundles", warc.WARC_SQL)
def op5_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


@CATALOG.add("op6_license_scan")
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


@CATALOG.add("op7_mixture_packing")
def op7_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


EXACT_SQL = """
with t as (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz')) as text_sha256 from documents)
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size, doc_id = max(doc_id) over g as kept,
  text_sha256
from t window g as (partition by text_sha256)
"""


@CATALOG.add("op8_exact_dedup", EXACT_SQL)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents")).drop("row_hash")


@CATALOG.add("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@CATALOG.add("op10_quality_rules", rules.RULES_SQL)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_report(table(spark, sf_dir, "documents"))


@CATALOG.add("op11_importance_resampling", resampling.RESAMPLING_SQL)
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@CATALOG.add("op12_source_divergence", divergence.DIVERGENCE_SQL)
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


@CATALOG.add("op13_toxic_passages")
def op13_toxic_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
