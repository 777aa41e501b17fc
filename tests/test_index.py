"""Archive index: crawl window, file names, months, missing listings.

All file names and dates are invented; a file belongs to a run when the time
stamp in its base name lies in the half-open window.
"""

import gzip
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from warcsift.functions import paths as P
from warcsift.sources.index import months, parse_paths, prune, warc_count, warc_index

NOON = datetime(2019, 6, 30, 12, 0, 0)


def file_of(when, serial=7, folder="crawl-data/CC-NEWS/2019/06"):
    return f"{folder}/CC-NEWS-{when:%Y%m%d%H%M%S}-{serial:05}.warc.gz"


def kept(spark, names, start, end):
    index = parse_paths(spark.createDataFrame([(n,) for n in names], "value string"))
    return sorted(r["warc_path"] for r in prune(index, start, end).collect())


@pytest.mark.parametrize("shift, inside", [(-1, False), (0, True), (1, True), (3599, True), (3600, False), (3601, False)])
def test_window_is_half_open_to_the_second(spark, shift, inside):
    name = file_of(NOON + timedelta(seconds=shift))
    assert (kept(spark, [name], NOON, NOON + timedelta(hours=1)) == [name]) is inside


def test_the_first_stamp_in_a_path_decides(spark):
    stamped_folder = file_of(NOON, folder="crawl-data/CC-NEWS-20300101000000-00001")
    assert kept(spark, [stamped_folder], NOON, NOON + timedelta(days=1)) == []
    assert kept(spark, [stamped_folder], datetime(2030, 1, 1), datetime(2030, 1, 2)) == [stamped_folder]


@pytest.mark.parametrize("name", ["", "   ", "listing.txt", "CC-NEWS-2019-7.warc.gz", "CC-NEWS-20190631120000-00001.warc.gz",
                                  "CC-NEWS-20190630256161-00001.warc.gz", "OTHER-20190630120000-00001.warc.gz"])
def test_names_without_a_real_time_are_never_in_a_window(spark, name):
    assert kept(spark, [name], datetime(1990, 1, 1), datetime(2090, 1, 1)) == []


def test_two_files_of_a_morning(spark):
    """Of five consecutive files the two of 06:00-09:00."""
    day = datetime(2021, 1, 2)
    times = [day - timedelta(minutes=7), day + timedelta(hours=2, minutes=34), day + timedelta(hours=6, minutes=3),
             day + timedelta(hours=8, minutes=42), day + timedelta(hours=11, minutes=11)]
    names = [file_of(t, 31 + i) for i, t in enumerate(times)]
    assert kept(spark, names, day + timedelta(hours=6), day + timedelta(hours=9)) == names[2:4]


def test_fields_of_a_name(spark):
    name = file_of(NOON, 204)
    row = parse_paths(spark.createDataFrame([(f"  {name} ",)], "value string")).first()
    assert (row["warc_path"], row["serial"], row["crawl_ts"]) == (name, 204, NOON)
    assert row["basename"] == "CC-NEWS-20190630120000-00204"
    assert row["warc_url"] == f"{P.DEFAULT_DOMAIN}/{name}"
    absolute = "s3://own-bucket/" + name
    assert parse_paths(spark.createDataFrame([(absolute,)], "value string")).first()["warc_url"] == absolute


@pytest.mark.parametrize("start, end, want", [
    (datetime(2019, 6, 30), datetime(2019, 7, 1), [(2019, 6)]),
    (datetime(2019, 6, 30), datetime(2019, 7, 1, 0, 0, 1), [(2019, 6), (2019, 7)]),
    (datetime(2019, 11, 3), datetime(2020, 2, 9), [(2019, 11), (2019, 12), (2020, 1), (2020, 2)]),
])
def test_months_of_a_window(start, end, want):
    assert [(m.year, m.month) for m in months(start, end)] == want


def test_listings_are_read_and_missing_ones_skipped(spark, tmp_dir):
    names = [file_of(NOON + timedelta(hours=h), h) for h in range(4)]
    folder = os.path.join(tmp_dir, "crawl-data", "CC-NEWS", "2019", "06")
    os.makedirs(folder)
    with gzip.open(os.path.join(folder, "warc.paths.gz"), "wt") as f:
        f.write("\n".join(names) + "\n\n")
    around = warc_index(spark, tmp_dir, datetime(2019, 5, 9), datetime(2019, 8, 1))
    assert sorted(r["warc_path"] for r in around.collect()) == names
    assert warc_count(around).first()["n_warcs"] == 4
    before = warc_index(spark, tmp_dir, datetime(2019, 3, 1), datetime(2019, 4, 2))
    assert before.columns == around.columns and before.count() == 0
    assert before.agg(F.count("*")).first()[0] == 0
