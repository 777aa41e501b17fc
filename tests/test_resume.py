"""Runs that are ended anywhere and started again: every article once."""

import gzip
import os
from collections import Counter
from datetime import datetime

import pytest

from warcsift.operators.language import train_profile
from warcsift.plans.pipeline import run
from warcsift.plans.resume import batch_rows, run_resumable
from warcsift.sources import ledger as L
from warcsift.sources.lake import read_lake

from helpers import PAGE, request, response, write

DAY = (datetime(2021, 1, 1), datetime(2021, 1, 2))


def name(n):
    return f"CC-NEWS-2021010100{n:02}00-{n:05}.warc.gz"


def records(n):
    return [response(url=f"https://news.example.com/{n}/{i}", body=PAGE.replace("Council", f"Council {n} {i}").encode()) for i in range(3)] + [request()]


@pytest.fixture(scope="module")
def profile(spark):
    p = train_profile(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).persist()
    p.count()
    return p


@pytest.fixture()
def archive(tmp_dir):
    """Five listed files, of which 3 has a corrupt record and 4 is not there yet."""
    folder = os.path.join(tmp_dir, "crawl-data", "CC-NEWS", "2021", "01")
    for n in range(3):
        write(folder, name(n), records(n))
    parts = [gzip.compress(r, mtime=0) for r in records(3)]
    bad = bytearray(parts[1])
    bad[len(bad) // 2] ^= 0x55
    with open(os.path.join(folder, name(3)), "wb") as f:
        f.write(parts[0] + bytes(bad) + parts[2] + parts[3])
    with gzip.open(os.path.join(folder, "warc.paths.gz"), "wt") as f:
        f.write("".join(f"crawl-data/CC-NEWS/2021/01/{name(n)}\n" for n in range(5)))
    return tmp_dir


def go(spark, archive, profile, **kw):
    return run_resumable(spark, archive, ["*"], *DAY, f"{archive}/lake", f"{archive}/ledger", profile=profile, files_per_commit=2, num_partitions=2, **kw)


def lake(spark, archive):
    return Counter(tuple(r) for r in read_lake(spark, f"{archive}/lake").collect())


def leftovers(archive):
    """Files that a commit should have moved or deleted."""
    return [os.path.join(d, f) for root in ("lake", "ledger") for d, _, fs in os.walk(os.path.join(archive, root)) for f in fs
            if {L.STAGING, L.PENDING} & set(d.split(os.sep))]


def once(spark, archive, profile):
    run(spark, archive, ["*"], *DAY, f"{archive}/whole", profile=profile, num_partitions=2).release()
    return Counter(tuple(r) for r in read_lake(spark, f"{archive}/whole").collect())


def test_a_run_goes_on_where_the_last_one_ended(spark, archive, profile):
    first = go(spark, archive, profile, max_commits=1)
    assert first.commits == 1 and [f[-13:-8] for f in first.read] == ["00000", "00001"] and first.open == 3
    assert sum(lake(spark, archive).values()) == 6
    second = go(spark, archive, profile)
    assert second.commits == 2 and [f[-13:-8] for f in second.read] == ["00002", "00003", "00004"] and second.open == 1
    want = once(spark, archive, profile)
    assert lake(spark, archive) == want and sum(want.values()) == 11 and set(want.values()) == {1}
    rows = {r["warc_path"][-13:-8]: r for r in second.ledger.collect()}
    assert {k: r["status"] for k, r in rows.items()} == {"00000": "done", "00001": "done", "00002": "done", "00003": "damaged", "00004": "missing"}
    assert "corrupt" in rows["00003"]["message"] and rows["00003"]["total"] == 3 and rows["00000"]["extracted"] == 3
    # the missing file arrives; nothing else is read again
    write(os.path.join(archive, "crawl-data", "CC-NEWS", "2021", "01"), name(4), records(4))
    third = go(spark, archive, profile)
    assert [f[-13:-8] for f in third.read] == ["00004"] and third.open == 0
    assert sum(lake(spark, archive).values()) == 14 and max(lake(spark, archive).values()) == 1
    fourth = go(spark, archive, profile)
    assert fourth.read == [] and fourth.commits == 0 and sum(lake(spark, archive).values()) == 14
    assert leftovers(archive) == []


class Killed(Exception):
    pass


@pytest.mark.parametrize("method, after", [("_write", 1), ("_move", 1)])
def test_a_killed_commit_is_finished_or_dropped(spark, archive, profile, monkeypatch, method, after):
    """Before the commit file nothing of the batch counts; after it, everything."""
    calls, real = [], getattr(L.Ledger, method)

    def dies(self, *args):
        calls.append(args)
        if len(calls) > after:
            raise Killed
        return real(self, *args)

    with monkeypatch.context() as m:
        m.setattr(L.Ledger, method, dies)
        with pytest.raises(Killed):
            go(spark, archive, profile)
    again = go(spark, archive, profile)
    assert lake(spark, archive) == once(spark, archive, profile)
    assert len(again.read) == (3 if method == "_write" and after == 1 or method == "_move" else 5)
    assert Counter(r["warc_path"] for r in again.ledger.collect()).most_common(1)[0][1] == 1
    assert leftovers(archive) == []


def test_status_of_files(spark):
    files = spark.createDataFrame([(c,) for c in "abcde"], "warc_path string")
    counts = spark.createDataFrame([(c, 1, 2, 3, 6) for c in "abce"], "warc_path string, extracted long, discarded long, errored long, total long")
    errors = spark.createDataFrame([("b", 0, "corrupt gzip member"), ("c", 0, "corrupt gzip member"), ("c", 9, "unreadable: OSError: reset"),
                                    ("d", 0, "missing file")], "warc_path string, rec_offset long, message string")
    rows = {r["warc_path"]: (r["status"], r["message"], r["total"]) for r in batch_rows("x", files, counts, errors).collect()}
    assert rows == {"a": ("done", None, 6), "b": ("damaged", "corrupt gzip member", 6), "c": ("failed", "unreadable: OSError: reset", 0),
                    "d": ("missing", "missing file", 0), "e": ("done", None, 6)}


def test_arguments(spark, archive, profile):
    for bad in (0, -1, 1.5, "2"):
        with pytest.raises(ValueError):
            run_resumable(spark, archive, ["*"], *DAY, "l", "g", profile=profile, files_per_commit=bad)
    with pytest.raises(ValueError):
        run_resumable(spark, archive, ["*"], *DAY, "l", "g")
