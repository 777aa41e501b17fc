"""Argument contracts of the public API, checked on the driver.

Exception classes and messages are part of the interface (callers and tests
match them): the texts below are fixed values.
"""

from __future__ import annotations

import logging
from datetime import datetime

from .schemas import ARTICLE_FIELDS

log = logging.getLogger(__name__)


def check_url(url) -> str:
    if type(url) is not str:
        raise TypeError("WARC URL is not a string.")
    return url


def check_patterns(patterns) -> list[str]:
    if type(patterns) is not list:
        raise TypeError("URL patterns is not a list.")
    if any(type(p) is not str for p in patterns):
        raise ValueError("Not all URL patterns are strings.")
    if not patterns:
        log.warning("Empty patterns list. All source URLs will be rejected.")
    return patterns


def check_date_crawled(d, now: datetime | None = None) -> datetime:
    if type(d) is not datetime:
        raise TypeError("Date is not a datetime object.")
    if d > (now or datetime.now()):
        raise ValueError("Date is in the future.")
    return d


def check_window(start, end, now: datetime | None = None) -> tuple[datetime, datetime]:
    if type(end) is not datetime:
        raise TypeError("End date isn't type 'datetime'.")
    if end > (now or datetime.now()):
        raise ValueError("End date is in the future.")
    if type(start) is not datetime:
        raise TypeError("Start date isn't type 'datetime'.")
    if start >= end:
        raise ValueError("Start date is on or after the end date.")
    return start, end


def check_report_every(n) -> int:
    if type(n) is not int:
        raise TypeError("Report Every is not an integer.")
    if n <= 0:
        raise ValueError("Report Every must be greater than zero.")
    return n


def check_max_records(n) -> int:
    if type(n) is not int:
        raise TypeError("Max records is not an integer.")
    if n <= 0:
        raise ValueError("Max records must be greater than 0.")
    return n


def check_partitions(keys) -> tuple[str, ...]:
    if type(keys) is not tuple or len(keys) == 0:
        raise TypeError("Partition keys is not a tuple.")
    if any(type(k) is not str for k in keys):
        raise ValueError("Not all keys are strings.")
    if any(k not in ARTICLE_FIELDS for k in keys):
        raise ValueError("One of the keys doesn't exist.")
    if len(set(keys)) < len(keys):
        raise ValueError("Cannot have duplicate keys.")
    return keys


def check_bucket(name) -> str:
    if type(name) is not str:
        raise TypeError("Bucket name is not a string.")
    return name


def check_limit(limit) -> int | None:
    if limit is None:
        return None
    if type(limit) is not int:
        raise TypeError("Limit is not an integer.")
    if limit < 0:
        raise ValueError("Limit must not be negative.")
    return limit


def default_window(today: datetime | None = None) -> tuple[datetime, datetime]:
    """[yesterday 00:00, today 00:00) of the given (or current) day."""
    from datetime import timedelta
    t = today or datetime.now()
    end = datetime(t.year, t.month, t.day)
    return end - timedelta(days=1), end


def window_from_env(start: str | None, end: str | None,
                    today: datetime | None = None) -> tuple[datetime, datetime]:
    """ISO start/end when both are given, else the default day."""
    if start is not None and end is not None:
        return datetime.fromisoformat(start), datetime.fromisoformat(end)
    return default_window(today)


def patterns_from_env(value: str | None) -> list[str]:
    """JSON list of globs; absent means every URL."""
    import json
    return json.loads(value) if value is not None else ["*"]
