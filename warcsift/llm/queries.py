"""The registered query of each operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import class_lm, disclosure, divergence, exact_dedup, jaccard_join, language_id, mixing, packing, quality, secret_scan, simhash, url_filter, whitening
from .common import table
from .sql import ORACLES  # noqa: F401

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights, intercept = url_filter.train(url_filter.labelled_urls(spark))
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), weights, intercept)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = mixing.sizes(table(spark, sf_dir, "documents"))
    return mixing.taken(mixing.plan_mix(sized)).withColumn("shards", F.array_join("shards", ","))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != secret_scan.METHOD_KIND)
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in secret_scan.BASE],
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = disclosure.find_private(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != disclosure.METHOD_KIND)
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in disclosure.PATTERNS],
        F.sha2(disclosure.listed(base), 256).alias("base_sha256"),
        disclosure.listed(F.col("spans")).alias("spans"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = class_lm.remainder(F.col("doc_id"), 5) == 0
    found = language_id.predict(docs, language_id.fit(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_marks", "n_lines", "n_stop")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op10_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = class_lm.remainder(F.col("doc_id"), 7) == 2
    found = class_lm.score(docs, class_lm.train(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
                        "base_score", "score", "perplexity")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_url_filters, op2_mixing, op3_secret_scans, op4_pii, op5_language_id, op6_exact_dedup, op7_jaccard_join, op8_quality_rules,
    op9_best_fit_packing, op10_class_lm, op11_simhash,
    op12_whitening, op13_source_divergence)}
