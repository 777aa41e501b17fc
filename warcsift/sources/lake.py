"""The article lake: partitioned Parquet, append by default.

Write: one job for the whole run. Rows are co-located by the partition keys
before writing so each key directory gets few files; by default this is an
AQE ``REBALANCE`` on the keys, which splits a hot key (one language can be a
third of a day) over several tasks instead of funnelling it into one, and
merges tiny partitions. ``maxRecordsPerFile`` caps file size.

Read: an explicit schema, so partition directories such as
``date_crawled=2021-01-01`` come back as strings, not dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..contracts import check_max_records, check_partitions
from ..schemas import ARTICLE, ARTICLE_FIELDS

DEFAULT_KEYS = ("date_crawled", "language")
MODES = ("append", "overwrite_partitions", "overwrite")
COLOCATE = ("rebalance", "hash", "none")


def write_lake(articles: DataFrame, url: str, keys: tuple[str, ...] = DEFAULT_KEYS,
               max_records: int | None = None, mode: str = "append",
               colocate: str = "rebalance", extra: tuple[str, ...] = ()) -> None:
    """Write articles (7 fields + ``extra`` columns) partitioned by ``keys``."""
    if extra:
        if type(keys) is not tuple or not keys or any(
                k not in ARTICLE_FIELDS + tuple(extra) for k in keys):
            raise ValueError("One of the keys doesn't exist.")
    else:
        check_partitions(keys)
    if max_records is not None:
        check_max_records(max_records)
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if colocate not in COLOCATE:
        raise ValueError(f"colocate must be one of {COLOCATE}")
    df = articles.select(*ARTICLE_FIELDS, *[c for c in extra if c not in ARTICLE_FIELDS])
    if colocate == "rebalance":
        df = df.hint("rebalance", *keys)
    elif colocate == "hash":
        df = df.repartition(*keys)
    w = df.write.partitionBy(*keys)
    if max_records is not None:
        w = w.option("maxRecordsPerFile", max_records)
    if mode == "overwrite_partitions":
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode(mode)
    w.parquet(url)


def bucket_url(bucket: str, scheme: str = "s3a") -> str:
    """Lake location for an object-store bucket, e.g. ``s3a://<bucket>/``."""
    from ..contracts import check_bucket
    return f"{scheme}://{check_bucket(bucket)}/"


def lake_schema(extra: tuple[str, ...] = ()) -> T.StructType:
    fields = list(ARTICLE.fields) + [T.StructField(c, T.StringType()) for c in extra]
    return T.StructType(fields)


def read_lake(spark: SparkSession, url: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Articles of a lake, 7 fields in contract order (plus ``extra``)."""
    df = spark.read.schema(lake_schema(extra)).parquet(url)
    return df.select(*ARTICLE_FIELDS, *extra)


def rows_per_file(lake: DataFrame) -> DataFrame:
    """(file_path, n) for every Parquet file behind a lake DataFrame."""
    return (lake.select(F.col("_metadata.file_path").alias("file_path"))
            .groupBy("file_path").count())
