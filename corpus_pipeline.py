"""A training corpus from raw documents, in five stages.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor
kept, and returns a DataFrame, which is written as Parquet to the shared folder
and read again as the next one's ``docs``; so a lost executor costs a read. All
but the last return the columns of ``documents``, with whatever other columns
came along.

1. quality rules: documents that a rule rejects go.
2. exact dedup: of equal texts the one with the largest id stays.
3. near-dedup: of each group of documents whose SimHash fingerprints of 3-word
   shingles are linked at two or fewer differing bits the one with the smallest
   id stays.
4. substring dedup: passages that an earlier document holds are cut out.
5. packing: one row per piece of a document in a training sequence.

Nulls and empty texts are treated as each operator states. Of rows that tie for
a group, repeated rows among them, the dedup stages keep one.
An empty table passes through all stages as an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from opinara.llm import exact, packing, rules, simhash, substrings
from opinara.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.quality_filter(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.remove_substrings(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", pack),
]

#: Tokens and fingerprints are beyond SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
