"""Web-archive file names: crawl time, serial, basename, absolute URL."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Archive layout of the public news crawl.
DEFAULT_PREFIX = "CC-NEWS"
DEFAULT_ROUTE = "crawl-data/CC-NEWS"
DEFAULT_DOMAIN = "https://data.commoncrawl.org"
INDEX_NAME = "warc.paths.gz"


def name_rx(prefix: str = DEFAULT_PREFIX) -> str:
    return re.escape(prefix).replace("\\-", "-") + "-([0-9]{14})-([0-9]{5})"


def crawl_ts(path: Column, prefix: str = DEFAULT_PREFIX) -> Column:
    """Crawl time from the first ``<prefix>-<14 digits>-<5 digits>`` in the path.

    A wall-clock time without zone (TIMESTAMP_NTZ), as written in the name,
    so nothing depends on the session time zone. No match, or digits that
    are not a date (month 13, ...), give NULL.
    """
    d = F.regexp_extract(path, name_rx(prefix), 1)
    part = lambda a, b: F.substring(d, a, b).cast("int")
    ts = F.try_make_timestamp_ntz(part(1, 4), part(5, 2), part(7, 2), part(9, 2),
                                  part(11, 2), part(13, 2).cast("decimal(8,6)"))
    return F.when(d != "", ts)


def serial(path: Column, prefix: str = DEFAULT_PREFIX) -> Column:
    return F.nullif(F.regexp_extract(path, name_rx(prefix), 2), F.lit("")).cast("int")


def basename(path: Column) -> Column:
    """File name up to its first dot."""
    return F.split_part(F.element_at(F.split(path, "/"), -1), F.lit("."), F.lit(1))


def absolute_url(path: Column, domain: str = DEFAULT_DOMAIN) -> Column:
    """Domain + relative path, unless the path already has a scheme."""
    rel = F.regexp_replace(path, "\\A/+", "")
    return F.when(path.rlike("\\A[A-Za-z][A-Za-z0-9+.-]*:"), path).otherwise(
        F.concat(F.lit(domain.rstrip("/") + "/"), rel))


def crawl_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def ntz(dt) -> Column:
    """A Python (naive) datetime as a TIMESTAMP_NTZ literal."""
    return F.lit(dt.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def in_window(ts: Column, start, end) -> Column:
    """Half-open window ``[start, end)`` on wall-clock times; NULL times fall out."""
    return (ts >= ntz(start)) & (ts < ntz(end))
