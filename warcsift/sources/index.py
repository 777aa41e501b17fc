"""Monthly archive indexes: one gzip text file of WARC paths per month.

``warc_index`` reads the listings of every month touched by ``[start, end)``
in one ``spark.read.text`` call, parses crawl time, serial, basename and
absolute URL from each path, and keeps the paths whose crawl time lies in
the window. Listings that do not exist are skipped with a warning (zero
rows, not a failure).
"""

from __future__ import annotations

import logging
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import paths as P
from ..schemas import WARC_INDEX

log = logging.getLogger(__name__)

# "{root}/crawl-data/CC-NEWS/{yyyy}/{MM}/warc.paths.gz"
DEFAULT_LAYOUT = "{root}/" + P.DEFAULT_ROUTE + "/{yyyy}/{MM}/" + P.INDEX_NAME


def months(start: datetime, end: datetime) -> list[datetime]:
    """First day of every month holding a time in ``[start, end)``."""
    last = end - timedelta(microseconds=1)
    out, cur = [], datetime(start.year, start.month, 1)
    while cur <= last:
        out.append(cur)
        cur = datetime(cur.year + cur.month // 12, cur.month % 12 + 1, 1)
    return out


def month_rows(start: Column, end: Column) -> Column:
    """Spark form of :func:`months` (an array of dates) for use in queries."""
    return F.sequence(F.trunc(start, "MM").cast("date"),
                      F.trunc(end - F.expr("INTERVAL 1 SECOND"), "MM").cast("date"),
                      F.expr("INTERVAL 1 MONTH"))


def listing_path(root: str, month: datetime, layout: str = DEFAULT_LAYOUT) -> str:
    return layout.format(root=root.rstrip("/"), yyyy=f"{month.year:04d}",
                         MM=f"{month.month:02d}")


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark can resolve the listing (file or directory) at ``path``."""
    from pyspark.errors import AnalysisException
    try:
        spark.read.text(path)
        return True
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return False
        raise


def parse_paths(lines: DataFrame, domain: str = P.DEFAULT_DOMAIN,
                prefix: str = P.DEFAULT_PREFIX) -> DataFrame:
    """``value`` lines -> WARC_INDEX columns (blank lines dropped)."""
    path = F.trim(F.col("value"))
    return (lines.select(path.alias("warc_path")).where(F.col("warc_path") != "")
            .select(
                "warc_path",
                P.absolute_url(F.col("warc_path"), domain).alias("warc_url"),
                P.basename(F.col("warc_path")).alias("basename"),
                P.crawl_ts(F.col("warc_path"), prefix).alias("crawl_ts"),
                P.serial(F.col("warc_path"), prefix).alias("serial")))


def read_listings(spark: SparkSession, listing_paths: list[str]) -> DataFrame:
    """All lines of the existing listings; missing ones are skipped."""
    present = []
    for p in listing_paths:
        if _exists(spark, p):
            present.append(p)
        else:
            log.warning("archive index %s not found; skipped", p)
    if not present:
        return spark.createDataFrame([], "value string")
    return spark.read.text(present)


def warc_index(spark: SparkSession, root: str, start: datetime, end: datetime,
               layout: str = DEFAULT_LAYOUT, domain: str = P.DEFAULT_DOMAIN,
               prefix: str = P.DEFAULT_PREFIX) -> DataFrame:
    """Index rows of the files crawled in ``[start, end)``."""
    lines = read_listings(spark, [listing_path(root, m, layout) for m in months(start, end)])
    return prune(parse_paths(lines, domain, prefix), start, end).select(
        *[F.col(f.name).cast(f.dataType) for f in WARC_INDEX.fields])


def prune(index: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Files crawled in ``[start, end)``."""
    return index.where(P.in_window(F.col("crawl_ts"), start, end))


def warc_count(index: DataFrame) -> DataFrame:
    """(n_warcs): how many files an index names."""
    return index.agg(F.count(F.lit(1)).alias("n_warcs"))
