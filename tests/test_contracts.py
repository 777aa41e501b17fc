from datetime import datetime, timedelta

import pytest

from warcsift import contracts as K


def test_url_must_be_string():
    with pytest.raises(TypeError, match="WARC URL is not a string."):
        K.check_url(123)
    assert K.check_url("s3://x/y.warc.gz") == "s3://x/y.warc.gz"


def test_patterns():
    with pytest.raises(TypeError, match="URL patterns is not a list."):
        K.check_patterns("*")
    with pytest.raises(ValueError, match="Not all URL patterns are strings."):
        K.check_patterns(["*", 1])
    assert K.check_patterns([]) == []


def test_date_crawled():
    with pytest.raises(TypeError, match="Date is not a datetime object."):
        K.check_date_crawled("2021-01-01")
    with pytest.raises(ValueError, match="Date is in the future."):
        K.check_date_crawled(datetime.now() + timedelta(days=2))


def test_window():
    with pytest.raises(TypeError, match="End date isn't type 'datetime'."):
        K.check_window(datetime(2021, 1, 1), "2021-01-02")
    with pytest.raises(ValueError, match="End date is in the future."):
        K.check_window(datetime(2021, 1, 1), datetime.now() + timedelta(days=3))
    with pytest.raises(TypeError, match="Start date isn't type 'datetime'."):
        K.check_window("2021-01-01", datetime(2021, 1, 2))
    with pytest.raises(ValueError, match="Start date is on or after the end date."):
        K.check_window(datetime(2021, 1, 2), datetime(2021, 1, 2))


def test_report_every_and_max_records():
    with pytest.raises(TypeError, match="Report Every is not an integer."):
        K.check_report_every("5")
    with pytest.raises(ValueError, match="Report Every must be greater than zero."):
        K.check_report_every(0)
    assert K.check_max_records(50) == 50
    with pytest.raises(TypeError, match="Max records is not an integer."):
        K.check_max_records("Not too many records pls")
    with pytest.raises(ValueError, match="Max records must be greater than 0."):
        K.check_max_records(-1)


def test_partitions():
    assert K.check_partitions(("title", "source_domain")) == ("title", "source_domain")
    with pytest.raises(TypeError, match="Partition keys is not a tuple."):
        K.check_partitions("source_domain")
    with pytest.raises(TypeError, match="Partition keys is not a tuple."):
        K.check_partitions(())
    with pytest.raises(ValueError, match="Not all keys are strings."):
        K.check_partitions((123, "title"))
    with pytest.raises(ValueError, match="One of the keys doesn't exist."):
        K.check_partitions(("url", "no such field"))
    with pytest.raises(ValueError, match="Cannot have duplicate keys."):
        K.check_partitions(("title", "title", "date_crawled"))


def test_bucket_and_limit():
    with pytest.raises(TypeError, match="Bucket name is not a string."):
        K.check_bucket(1)
    assert K.check_limit(None) is None
    assert K.check_limit(0) == 0
    with pytest.raises(ValueError):
        K.check_limit(-1)


def test_default_window_is_yesterday():
    s, e = K.default_window(datetime(2021, 3, 1, 15, 30))
    assert (s, e) == (datetime(2021, 2, 28), datetime(2021, 3, 1))
    s, e = K.window_from_env("2021-01-02T06:00:00", None, datetime(2021, 3, 1, 1))
    assert (s, e) == (datetime(2021, 2, 28), datetime(2021, 3, 1))
    s, e = K.window_from_env("2021-01-02T06:00:00", "2021-01-02T09:00:00")
    assert (s, e) == (datetime(2021, 1, 2, 6), datetime(2021, 1, 2, 9))


def test_patterns_from_env():
    assert K.patterns_from_env(None) == ["*"]
    assert K.patterns_from_env('["*bbc.co.uk*", "*"]') == ["*bbc.co.uk*", "*"]
