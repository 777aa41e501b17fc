"""Corpus pipeline: five stages over ``documents``, each written and read again.

quality rules -> exact dedup -> n-gram Jaccard join -> mixing -> packing. Every
stage works on all rows its predecessor kept; all but the last return the
columns of ``documents``. The last needs a tokenizer, which SQL cannot express,
so the whole is tested against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from warcsift.llm import exact_dedup, jaccard_join, mixing, packing, quality
from warcsift.llm.common import materialise, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays (null ranks lowest, null
    text is empty); of repeated rows one."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: least doc_id (null last), then least
    text hash, one of repeated rows; rows without a word stay."""
    return jaccard_join.keep_one_per_group(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every time the mix takes a document, by output shard in its order."""
    return mixing.in_mix_order(mixing.mix(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece with its place in a sequence."""
    return packing.best_fit_pack(docs, TOKENIZER)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing", source_mix),
    ("best-fit packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
