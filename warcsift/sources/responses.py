"""``responses``: raw web-archive records derived from the driver table ``pages``.

A fixed, documented decoration turns each page into one record of the
``RAW_RECORDS`` schema, so every operator can be checked on the given data
without archive files. The same rule is written once more in DuckDB SQL for
the oracles (see ``plans/oracles.py``).

* ``file_no = page_id div 20``, ``rec_idx = page_id % 20``
* ``crawl_ts = 2021-01-01 00:00:00 + file_no * 7331 s``
* ``warc_path = crawl-data/CC-NEWS/yyyy/MM/CC-NEWS-<yyyyMMddHHmmss>-<file_no:05>.warc.gz``
* ``rec_type``: ``request`` if ``page_id % 11 = 0``; else ``warcinfo`` if
  ``page_id % 13 = 0`` (no HTTP headers); else ``response``
* content type by ``page_id % 7``: 0 ``text/html``; 1 ``text/html;charset=UTF-8``;
  2 ``application/json; charset=utf-8``; 3 ``text/html; charset=iso-8859-1``;
  4 none; 5, 6 ``text/html; charset=utf-8``
* ``payload`` = UTF-8 bytes of ``html`` plus byte ``FF`` if ``page_id % 17 = 0``
* ``rec_offset = rec_idx * 4096``; ``file_size = 81920``, unknown (NULL) when
  ``file_no % 4 = 3``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.headers import make_headers

RECORDS_PER_FILE = 20
SECONDS_PER_FILE = 7331

# Content types by page_id % 7.
CONTENT_TYPES = (
    "text/html",
    "text/html;charset=UTF-8",
    "application/json; charset=utf-8",
    "text/html; charset=iso-8859-1",
    None,
    "text/html; charset=utf-8",
    "text/html; charset=utf-8",
)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over the cores if its files give fewer tasks than there are (one
    Parquet row group is one task): extracting a page costs far more than moving it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def decorate(pages: DataFrame) -> DataFrame:
    pid = F.col("page_id")
    file_no = F.floor(pid / RECORDS_PER_FILE).cast("long")
    # Zone-free arithmetic (TIMESTAMP_NTZ), so paths do not depend on the
    # session time zone.
    ts = (F.lit("2021-01-01 00:00:00").cast("timestamp_ntz")
          + F.make_dt_interval(secs=(file_no * SECONDS_PER_FILE).cast("decimal(18,6)")))
    path = F.concat(
        F.lit("crawl-data/CC-NEWS/"), F.date_format(ts, "yyyy/MM"), F.lit("/CC-NEWS-"),
        F.date_format(ts, "yyyyMMddHHmmss"), F.lit("-"),
        F.lpad(file_no.cast("string"), 5, "0"), F.lit(".warc.gz"))
    rec_type = (F.when(pid % 11 == 0, F.lit("request"))
                .when(pid % 13 == 0, F.lit("warcinfo"))
                .otherwise(F.lit("response")))
    ct = F.element_at(F.array(*[F.lit(c).cast("string") for c in CONTENT_TYPES]),
                      (pid % 7 + 1).cast("int"))
    warc_date = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rec_headers = make_headers(("WARC-Type", rec_type),
                               ("WARC-Target-URI", F.when(rec_type != "warcinfo", F.col("url"))),
                               ("WARC-Date", warc_date))
    http_headers = (F.when(rec_type == "warcinfo", F.lit(None))
                    .when(rec_type == "request", make_headers())
                    .otherwise(make_headers(("Content-Type", ct))))
    body = F.encode(F.col("html"), "UTF-8")
    payload = F.when(pid % 17 == 0, F.concat(body, F.unhex(F.lit("FF")))).otherwise(body)
    rec_idx = (pid % RECORDS_PER_FILE).cast("long")
    return pages.select(
        path.alias("warc_path"),
        rec_idx.alias("rec_idx"),
        (rec_idx * 4096).alias("rec_offset"),
        F.when(file_no % 4 == 3, F.lit(None).cast("long"))
         .otherwise(F.lit(RECORDS_PER_FILE * 4096).cast("long")).alias("file_size"),
        rec_type.alias("rec_type"),
        rec_headers.alias("rec_headers"),
        F.when(rec_type == "response", F.lit(200)).cast("int").alias("http_status"),
        http_headers.alias("http_headers"),
        payload.alias("payload"),
        F.lit(None).cast("string").alias("payload_error"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records over the ``pages`` table of ``sf_dir``."""
    return decorate(spread(load_table(spark, sf_dir, "pages")))
