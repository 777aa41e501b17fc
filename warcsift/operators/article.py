"""Classified records -> article fields, language and disposition.

Plan shape (one exchange in total):

1. per record, in its own row: blocks, title, main text, publish date,
   source domain, crawl date (narrow, no shuffle; the HTML never leaves the
   scan stage);
2. the small result (keys + article fields, no HTML, no payload) is hash
   partitioned on the record key ``(warc_path, rec_idx)`` and written once as
   a table bucketed on that key in the shared checkpoint folder;
3. language: word count -> trigram explode -> broadcast join with the
   profile -> aggregate on key+lang -> arg-max on key, all on that
   partitioning, written once as a narrow table with the same buckets;
4. left join back on the key, again on that partitioning: the sink, the totals
   and the per-file counters all read the two tables, so neither the scan and
   the HTML work nor the detection run twice.

Rows that tell of damage in an archive file (``rec_type = '_error'``) are kept
out of the records and given as ``errors``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.paths import crawl_date, crawl_ts
from ..functions.text import detect_input, source_domain
from ..schemas import ARTICLE_FIELDS
from ..session import checkpoint_root, delete_path
from ..sources.warc import ERROR_TYPE
from . import html as H
from .language import detect_language
from .records import KEYS, disposition

EXTRA = ["rec_offset", "file_size", "rec_type", "payload_error"]


def with_fields(classified: DataFrame, prefix: str = "CC-NEWS") -> DataFrame:
    """Article fields for rows whose ``html`` is present (NULL elsewhere)."""
    html = F.col("html")
    has = html.isNotNull()
    # Values used more than once are staged as columns: inside CASE branches
    # and lambdas Spark would evaluate a repeated expression again.
    staged = classified.select(
        *KEYS, *[c for c in EXTRA if c in classified.columns], "url", "valid", "html",
        F.when(has, H.blocks(html)).alias("_blocks"),
        F.when(has, H.title_text(html)).alias("_title"),
        F.when(has, H.og_title(html)).alias("_og"))
    return staged.select(
        *KEYS, *[c for c in EXTRA if c in classified.columns], "url", "valid",
        has.alias("decoded"),
        F.when(has, H.choose_title(F.col("_title"), F.col("_blocks"), F.col("_og")))
        .alias("title"),
        F.when(has, H.main_text(F.col("_blocks"))).alias("main_text"),
        F.when(has, source_domain(F.col("url"))).alias("source_domain"),
        F.when(has, H.publish_date(F.col("url"), html)).alias("date_publish"),
        crawl_date(crawl_ts(F.col("warc_path"), prefix)).alias("date_crawled"),
    )


@dataclass
class Staged:
    """Dispositions of a run and what was stored for them."""

    disp: DataFrame                 # records with article fields, language, disposition
    errors: DataFrame               # warc_path, rec_offset, message of every gap
    spark: SparkSession
    tables: dict[str, str] = field(default_factory=dict)     # name -> path
    frames: list[DataFrame] = field(default_factory=list)    # persisted

    def release(self) -> None:
        """Drop the stored tables with their files, and every persisted frame."""
        for name, path in self.tables.items():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            delete_path(self.spark, path)
        for frame in self.frames:
            frame.unpersist()
        self.tables.clear()
        self.frames.clear()


def key_table(fields: DataFrame, n: int, staged: Staged, scratch: str | None = None) -> DataFrame:
    """Write ``fields`` as a Parquet table bucketed on the record key into the
    shared checkpoint folder (or ``scratch``) and read it back.

    The write cuts the lineage (a lost executor never forces the archives to
    be parsed again), the bucketing tells Spark the rows are hash partitioned
    on the key (so the aggregates and the join back need no exchange), and
    each reader scans only the columns it needs.
    """
    spark = fields.sparkSession
    name = f"warcsift_fields_{uuid.uuid4().hex[:12]}"
    path = f"{(scratch or checkpoint_root(spark)).rstrip('/')}/tables/{name}"
    staged.tables[name] = path
    (fields.repartition(n, *KEYS).write.format("parquet").bucketBy(n, *KEYS)
     .option("path", path).saveAsTable(name))
    return spark.table(name)


def stage(classified: DataFrame, profile: DataFrame, prefix: str = "CC-NEWS",
          num_partitions: int | None = None, materialize: str = "table",
          scratch: str | None = None) -> Staged:
    """Scan, extract and detect now, once, and store the result.

    ``materialize``: ``table`` (default) writes the extracted fields and the
    languages once each as key-bucketed tables; ``cache`` persists them on the
    executors instead (faster on one machine, but a lost executor's blocks are
    rebuilt from the archive scan).
    """
    fields = with_fields(classified, prefix)
    spark = classified.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = Staged(fields, fields, spark)

    def store(df: DataFrame) -> DataFrame:
        if materialize == "table":
            return key_table(df, n, staged, scratch)
        # An explicit partition count pins the hash partitioning (AQE may not
        # coalesce it), so the cached relation reports it to later plans.
        kept = df.repartition(n, *KEYS).persist(StorageLevel.MEMORY_AND_DISK)
        staged.frames.append(kept)
        kept.count()
        return kept

    if materialize not in ("table", "cache"):
        raise ValueError("materialize must be 'table' or 'cache'")
    part = store(fields)
    is_gap = F.lit(False) if "rec_type" not in part.columns else F.col("rec_type").eqNullSafe(ERROR_TYPE)
    if "rec_type" in part.columns:
        staged.errors = part.where(is_gap).select("warc_path", "rec_offset", F.col("payload_error").alias("message"))
    else:
        staged.errors = part.select("warc_path", F.lit(0).cast("long").alias("rec_offset"),
                                    F.lit("").alias("message")).limit(0)
    records = part.where(~is_gap)
    # The detection text (body, else title) is derived on the fly, not stored.
    texts = records.select(*KEYS, detect_input(F.col("main_text"), F.col("title"))
                           .alias("detect_text")).where(F.col("detect_text").isNotNull())
    lang = store(detect_language(texts, KEYS, "detect_text", profile))
    # Hash join on the narrow side: neither side is sorted.
    out = records.drop("payload_error").join(lang.hint("shuffle_hash"), KEYS, "left")
    staged.disp = out.withColumn(
        "disposition", disposition(F.col("valid"), F.col("decoded"), F.col("language")))
    return staged


def dispositions(classified: DataFrame, profile: DataFrame, prefix: str = "CC-NEWS",
                 num_partitions: int | None = None, materialize: str = "table"
                 ) -> DataFrame:
    """Every record with its article fields, language and disposition (see
    :func:`stage`, which this runs)."""
    return stage(classified, profile, prefix, num_partitions, materialize).disp


def articles(disp: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """The 7 article fields, in contract order, of extracted records."""
    return (disp.where(F.col("disposition") == "extracted")
            .select(*ARTICLE_FIELDS, *(extra or [])))
