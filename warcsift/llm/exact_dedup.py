"""Operator 6: exact dedup by content-defined chunk recipes.

1. Every text is cut natively into chunks: a chunk ends at the first sentence
   or line end past ``MIN_CHUNK`` characters, or at ``MAX_CHUNK``. Only the
   chunk's 64-bit hash and SHA-256 leave the scan; texts are never moved.
2. A dictionary deduplicates chunks to verified identifiers: a hash stands for
   itself while every chunk that has it shares one digest; where digests
   clash, each gets a number of its own within that hash.
3. Documents with equal ordered identifier lists are equal. A group is one
   partially aggregated row; only groups of two or more are joined back, from
   a written table, so that Spark may split a hot group's partition.

Defined results: null text counts as empty, and all empty texts are one group;
a null doc_id ranks below every other; of repeated rows (same doc_id and text)
exactly one is kept; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, release_newer, rows_that_stay, scratch_tables, text_of

MIN_CHUNK, MAX_CHUNK = 256, 8192


def chunks(text: Column, min_chars: int = MIN_CHUNK, max_chars: int = MAX_CHUNK) -> Column:
    """The text cut into content-defined chunks; joined they give the text."""
    ends = rf"(?s).{{{min_chars},{max_chars - 2}}}?(?:[.!?]\x20|\n)|.{{1,{max_chars}}}"
    return F.regexp_extract_all(text, F.lit(ends), F.lit(0))


def chunk_table(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """``rid, doc_id, text_sha256, chunks`` (hash and digest of each), one row per row."""
    h = (lambda c: F.xxhash64(c)) if hash_bits == 64 else (lambda c: F.pmod(F.xxhash64(c), F.lit(1 << hash_bits)))
    return docs.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id",
        F.sha2(text_of(), 256).alias("text_sha256"),
        F.transform(chunks(text_of()), lambda c: F.struct(
            h(c).alias("h"), F.unhex(F.sha2(c, 256)).alias("d"))).alias("chunks"))


def clashes(cut: DataFrame) -> DataFrame:
    """``h, d, k``: a number k > 0 for every digest but the first of a hash that has several."""
    dictionary = cut.select(F.explode("chunks").alias("c")).select("c.h", "c.d").distinct()
    several = dictionary.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    rank = F.row_number().over(Window.partitionBy("h").orderBy("d")) - 1
    return dictionary.join(several, "h", "left_semi").withColumn("k", rank).filter("k > 0")


def recipes(cut: DataFrame, clash: DataFrame) -> DataFrame:
    """``cut`` with ``recipe``: the ordered verified identifiers (hash, then number)."""
    if clash.isEmpty():  # every hash stands for one chunk
        return cut.withColumn("recipe", F.transform("chunks", lambda c: c["h"])).drop("chunks")
    rows = (cut.select("rid", F.posexplode("chunks").alias("pos", "c")).select("rid", "pos", "c.h", "c.d")
            .join(clash, ["h", "d"], "left").fillna(0, ["k"]))
    lists = rows.groupBy("rid").agg(
        F.sort_array(F.collect_list(F.struct("pos", "h", "k"))).alias("ids"))
    numbered = F.flatten(F.transform("ids", lambda x: F.array(x["h"], x["k"].cast("long"))))
    return (cut.drop("chunks").join(lists, "rid", "left")
            .withColumn("recipe", F.coalesce(numbered, F.array().cast("array<bigint>"))).drop("ids"))


def exact_groups(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """One row per row: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    cut = materialise(chunk_table(docs.select("doc_id", "text"), hash_bits), "chunks")
    listed = recipes(cut, materialise(clashes(cut), "clashes"))
    several = materialise(
        listed.groupBy("recipe").agg(F.max(F.struct("doc_id", "rid")).alias("keep"),
                                     F.count("*").alias("group_size"))
        .filter("group_size > 1"), "copies")
    both = listed.join(several, "recipe", "left")
    return both.select(
        "doc_id",
        F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("keep.rid") == F.col("rid"), F.lit(True)).alias("kept"),
        "text_sha256")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were.

    Only the copies that go are joined, by doc_id and digest; repeated rows
    (same doc_id and text) of a kept document are merged into one of them.
    """
    before = scratch_tables()
    verdict = (exact_groups(docs).filter("group_size > 1").groupBy("doc_id", F.col("text_sha256").alias("key"))
               .agg(F.count("*").alias("rows"), F.max("kept").alias("stays")))
    verdict = release_newer(before, materialise(verdict, "copy-verdicts"))
    return rows_that_stay(docs, F.sha2(text_of(), 256), verdict)
