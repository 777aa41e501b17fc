"""Archive files read in byte ranges, in bounded memory."""

import gzip
import os
import random
import subprocess
import sys
import zlib

import pytest
from pyspark.sql import functions as F

from warcsift.operators.records import classify
from warcsift.sources import framing, warc
from warcsift.sources.fixtures import http_bytes, warc_bytes
from warcsift.sources.framing import _decode_body
from warcsift.sources.warc import plan_splits, read_warc

from helpers import request, response, warcinfo, write


def records(n, seed=1):
    r = random.Random(seed)
    return [warcinfo()] + [r.choice([response, request])(url=f"https://news.example.com/{i}" + "x" * r.randrange(300)) for i in range(n)]


def nested():
    """A page that shows a whole archive record, and one that mentions the first line."""
    inner = response(url="https://inner.example.com/")
    return [response(url="https://a.example.com/", body=b"\n" + inner + b"\n" + inner * 3), response(), response(body=b"x\nWARC/1.0\r\nno header\r\n"),
            response(url="https://b.example.com/"), request()]


def arc():
    def one(url, body):
        return f"{url} 192.0.2.1 20210102084234 text/html {len(body)}\n".encode() + body + b"\n"
    page = http_bytes("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8")], b"<html>x</html>")
    return [one("filedesc://x.arc", b"1 0 test\n")] + [one(f"http://e.org/{i}", page + b"y" * i) for i in range(25)]


def damaged():
    parts = [gzip.compress(r, mtime=0) for r in records(30, 7)]
    for i in (5, 6, 17):
        b = bytearray(parts[i])
        b[len(b) // 2] ^= 0x55
        parts[i] = bytes(b)
    return b"".join(parts)[:-20]


@pytest.fixture(scope="module")
def files():
    import tempfile
    d = tempfile.mkdtemp(prefix="warcsift-splits-")

    def raw(name, data):
        path = os.path.join(d, name)
        with open(path, "wb") as f:
            f.write(data)
        return path

    many = records(60)
    return {
        "members": write(d, "a.warc.gz", many), "plain": write(d, "b.warc", many, gz=False),
        "one member": raw("c.warc.gz", gzip.compress(b"".join(many))),
        "some members": raw("d.warc.gz", b"".join(gzip.compress(b"".join(many[i:i + 7])) for i in range(0, 60, 7))),
        "nested plain": write(d, "e.warc", nested() * 4, gz=False),
        "nested stored": raw("f.warc.gz", b"".join(gzip.compress(gzip.compress(r) + r, 0) if i % 3 == 0 else gzip.compress(r, 0)
                                                   for i, r in enumerate(many))),
        "nested members": write(d, "g.warc.gz", [response(body=b"\n".join(gzip.compress(x) for x in many[:9]))] + many[:20]),
        "damaged": raw("h.warc.gz", damaged()), "cut": raw("i.warc", b"".join(many)[:-40]),
        "garbage": raw("j.warc", b"no record\nhere\n" + b"".join(many[:9]) + b"\x00" * 3000 + b"\n" + b"".join(many[9:])),
        "arc": write(d, "k.arc", arc(), gz=False), "arc.gz": write(d, "l.arc.gz", arc()), "empty": raw("m.warc", b""),
    }


COLS = ["warc_path", "rec_idx", "rec_offset", "file_size", "rec_type", "rec_headers", "http_status", "http_headers", "payload", "payload_error"]


def rows(df):
    key = lambda r: (r["warc_path"], r["rec_idx"], r["rec_offset"], r["payload_error"] or "")
    return sorted(df.select(*COLS).collect(), key=key)


@pytest.mark.parametrize("parts", [1, 8, 40])
def test_ranges_give_the_rows_of_whole_files(spark, files, parts):
    paths = list(files.values())
    want = rows(read_warc(spark, paths))
    assert len(want) > 500 and any(r["rec_type"] == "_error" for r in want)
    by_path = {}
    for r in want:
        by_path.setdefault(r["warc_path"], []).append(r)
    for p in paths:  # rec_idx numbers the records of a file
        own = [r["rec_idx"] for r in by_path.get(p, []) if r["rec_type"] != "_error"]
        assert own == list(range(len(own)))
    for name, path in files.items():
        size = os.path.getsize(path)
        if parts == 40 or name in ("members", "plain", "nested plain", "damaged"):
            got = read_warc(spark, path, split_bytes=max(1, size // parts))
            assert rows(got) == by_path.get(path, []), name


def test_sound_files_are_really_split(spark, files):
    plan = plan_splits(spark, list(files.values()), 2000)
    n = {name: len(plan.get(path, [0])) for name, path in files.items()}
    assert n["members"] >= 4 and n["plain"] >= 8 and n["arc"] > 1 and n["empty"] == 1
    cuts = plan[files["plain"]]
    assert cuts[0][0] == 0 and cuts[-1][1] is None and [a for a, _, _ in cuts[1:]] == [b for _, b, _ in cuts[:-1]]
    assert read_warc(spark, files["plain"], split_bytes=2000).rdd.getNumPartitions() == len(cuts)
    with pytest.raises(ValueError):
        plan_splits(spark, [], 0)


def test_limit_and_pushdown_count_from_the_file(spark, files):
    path = files["members"]
    assert [r["rec_idx"] for r in rows(read_warc(spark, path, split_bytes=700, limit=13))] == list(range(13))
    some = read_warc(spark, path, split_bytes=700).where((F.col("rec_idx") < 9) & (F.col("rec_type") == "response"))
    assert rows(some) == rows(read_warc(spark, path).where((F.col("rec_idx") < 9) & (F.col("rec_type") == "response")))


def test_a_failed_range_is_named(spark, files):
    with pytest.raises(Exception, match="h.warc.gz"):
        read_warc(spark, files["damaged"], split_bytes=500, mode="FAILFAST").collect()


# --- bounds ----------------------------------------------------------------------------------

def test_bombs_are_payload_errors(spark, tmp_dir):
    bomb = zlib.compress(b"\0" * (8 << 20), 9)

    def stored(body, coding):
        head = [("Content-Type", "text/html; charset=utf-8")] + ([("Content-Encoding", coding)] if coding else [])
        block = http_bytes("HTTP/1.1 200 OK", head, body)
        return warc_bytes([("WARC-Type", "response"), ("WARC-Target-URI", "https://e.org/"),
                           ("Content-Type", "application/http; msgtype=response")], block)

    twice = zlib.compress(zlib.compress(b"\0" * (64 << 20), 9), 9)
    path = write(tmp_dir, "bombs.warc.gz", [stored(bomb, "deflate"), stored(gzip.compress(b"\0" * (8 << 20)), "gzip"), stored(twice, "deflate, deflate"),
                                            stored(b"z" * (2 << 20), None), stored(b"fine", None)])
    got = rows(read_warc(spark, path, max_payload=1 << 20))
    assert [r["payload"] for r in got] == [None] * 4 + [b"fine"]
    assert all("more than 1048576 bytes" in r["payload_error"] for r in got[:4]) and got[4]["payload_error"] is None
    judged = classify(read_warc(spark, path, max_payload=1 << 20), ["*"]).orderBy("rec_idx").select("valid", "html").collect()
    assert [r["html"] for r in judged] == [None] * 4 + ["fine"] and all(r["valid"] for r in judged)


def test_inflation_stops_at_the_bound():
    body = gzip.compress(b"\0" * (64 << 20))
    assert _decode_body(body, [("Content-Encoding", "gzip")], 1 << 20) == (None, "payload of more than 1048576 bytes")
    exact = b"a" * (1 << 20)
    assert _decode_body(gzip.compress(exact), [("Content-Encoding", "gzip")], 1 << 20) == (exact, None)


SKIP = """
import io, resource, sys
sys.path.insert(0, {root!r})
from warcsift.sources.framing import ByteStream, Reading, Record, iter_records

class Raw:
    "A record of 1 GiB, then a small one; made as it is read."
    def __init__(self):
        head = b"WARC/1.0\\r\\nWARC-Type: response\\r\\nContent-Type: application/http\\r\\nContent-Length: %d\\r\\n\\r\\nHTTP/1.1 200 OK\\r\\nA: b\\r\\n\\r\\n"
        body = 1 << 30
        self.parts = [io.BytesIO(head % (body + 25)), body, io.BytesIO(b"\\r\\n\\r\\n" + b"WARC/1.0\\r\\nWARC-Type: metadata\\r\\nContent-Length: 2\\r\\n\\r\\nok\\r\\n\\r\\n")]
    def read(self, n):
        while self.parts:
            if isinstance(self.parts[0], int):
                m = min(n, self.parts[0])
                if m:
                    self.parts[0] -= m
                    return b"x" * m
            elif got := self.parts[0].read(n):
                return got
            self.parts.pop(0)
        return b""

before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
found = [x for x in iter_records(ByteStream(Raw(), False), Reading(wants=lambda rec: rec.rec_type == "metadata")) if isinstance(x, Record)]
assert [(x.rec_type, x.payload) for x in found] == [("response", None), ("metadata", b"ok")], found
assert found[0].http_headers == [("A", "b")]
assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 30_000
"""


def test_a_gibibyte_record_is_skipped_in_constant_memory():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", SKIP.format(root=root)], check=True, timeout=120)


def test_endless_lines_and_heads_are_damage(spark, tmp_dir, monkeypatch):
    long_head = b"WARC/1.0\r\n" + b"A: b\r\n" * 300_000 + b"\r\n"
    path = os.path.join(tmp_dir, "long.warc")
    with open(path, "wb") as f:
        f.write(b"y" * (3 << 20) + b"\n" + response() + long_head + response(url="https://e.org/2"))
    got = rows(read_warc(spark, path))
    assert [r["rec_type"] for r in got if r["rec_type"] != "_error"] == ["response", "response"]
    assert sorted(r["payload_error"].split(" of ")[0] for r in got if r["rec_type"] == "_error") == ["header line", "record headers"]


def test_a_large_http_head_without_end():
    import io
    block = b"HTTP/1.1 200 OK\r\n" + b"X: y\r\n" * 400_000
    data = warc_bytes([("WARC-Type", "response"), ("Content-Type", "application/http")], block)
    rec = next(iter(framing.iter_records(framing.ByteStream(io.BytesIO(data), False), framing.Reading(wants=lambda r: False))))
    assert rec.http_status == 200 and rec.payload is None and len(rec.http_headers) < 400_000


def test_angle_brackets_round_the_target(spark, tmp_dir):
    path = write(tmp_dir, "n.warc.gz", [response(url="<https://news.example.com/a>"), response(url="https://news.example.com/b>")])
    got = classify(read_warc(spark, path), ["https://news.*[ab]"]).orderBy("rec_idx").select("url", "valid").collect()
    assert [tuple(r) for r in got] == [("https://news.example.com/a", True), ("https://news.example.com/b>", False)]
    from warcsift.functions.globs import globs_to_python_regex
    kept = read_warc(spark, path, payload="html", url_regex=globs_to_python_regex(["https://news.*[ab]"])).orderBy("rec_idx").collect()
    assert [r["payload"] is not None for r in kept] == [True, False]


def test_many_small_ranges_are_dealt_over_few_tasks(spark, tmp_path):
    """The same rows from hundreds of ranges, neighbours in different tasks, without a task for each."""
    path = write(str(tmp_path), "many.warc", records(700), gz=False)
    plan = plan_splits(spark, [path], 400)[path]
    assert len(plan) > warc.MANY_RANGES
    many = read_warc(spark, path, split_bytes=400)
    assert many.rdd.getNumPartitions() == warc.MANY_RANGES
    assert rows(many) == rows(read_warc(spark, path))
    assert warc.tasks_for(350_000, 500 << 20) == 256 and warc.tasks_for(9, 100) == 9
    assert warc.tasks_for(100_000, 100_000 * (64 << 20)) == 100_000
    parts = [warc.FilePartition("f", 100, False, i, i + 1, i) for i in range(300)]
    dealt = warc.deal(parts)
    assert len(dealt) == 256 and sorted(p.start for d in dealt for p in d.parts) == list(range(300))
    assert all(b.start - a.start > 1 for d in dealt for a, b in zip(d.parts, d.parts[1:]))
