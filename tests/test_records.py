"""Record validity (reference cases), framing, decoding and scan errors."""

import os
import zlib

from pyspark.sql import functions as F

from helpers import PAGE, request, response, warcinfo, write
from warcsift.operators.records import classify
from warcsift.sources.warc import read_warc, scan_errors

NAME = "CC-NEWS-20210102084234-01434.warc.gz"


def _valid(spark, tmp_dir, rec, patterns=("*",)):
    path = write(tmp_dir, NAME, [rec])
    c = classify(read_warc(spark, path), list(patterns))
    return [r["valid"] for r in c.collect()]


def test_request_is_not_valid(spark, tmp_dir):
    assert _valid(spark, tmp_dir, request()) == [False]


def test_no_source_url(spark, tmp_dir):
    assert _valid(spark, tmp_dir, response(with_uri=False)) == [False]


def test_no_content_type(spark, tmp_dir):
    assert _valid(spark, tmp_dir, response(ct=None)) == [False]


def test_not_utf8(spark, tmp_dir):
    assert _valid(spark, tmp_dir, response(ct="text/html; charset=iso-8859-1")) == [False]


def test_not_text_html(spark, tmp_dir):
    assert _valid(spark, tmp_dir, response(ct="application/json; charset=utf-8")) == [False]


def test_no_matching_pattern(spark, tmp_dir):
    assert _valid(spark, tmp_dir, response(), ["*bbc.co.uk*"]) == [False]


def test_valid_record(spark, tmp_dir):
    assert _valid(spark, tmp_dir, response()) == [True]


def test_warcinfo_has_no_http_headers(spark, tmp_dir):
    path = write(tmp_dir, NAME, [warcinfo()])
    r = read_warc(spark, path).collect()[0]
    assert r["rec_type"] == "warcinfo" and r["http_headers"] is None


def test_framing_plain_gzip_and_codings(spark, tmp_dir):
    recs = [warcinfo(), request(), response(coding=0), response(coding=1),
            response(coding=2), response(coding=3)]
    for gz in (True, False):
        d = os.path.join(tmp_dir, "gz" if gz else "plain")
        path = write(d, NAME if gz else NAME[:-3], recs, gz=gz)
        rows = read_warc(spark, path).orderBy("rec_idx").collect()
        assert [r["rec_type"] for r in rows] == ["warcinfo", "request"] + ["response"] * 4
        assert [r["rec_idx"] for r in rows] == list(range(6))
        offs = [r["rec_offset"] for r in rows]
        assert offs == sorted(offs) and offs[0] == 0
        for r in rows[2:]:
            assert bytes(r["payload"]) == PAGE.encode("utf-8")
            assert r["payload_error"] is None and r["http_status"] == 200


def test_gzip_member_offsets_match_file_layout(spark, tmp_dir):
    import gzip
    recs = [warcinfo(), response(), response()]
    path = write(tmp_dir, NAME, recs)
    sizes = [len(gzip.compress(r, mtime=0)) for r in recs]
    rows = read_warc(spark, path).orderBy("rec_idx").collect()
    assert [r["rec_offset"] for r in rows] == [0, sizes[0], sizes[0] + sizes[1]]
    assert rows[0]["file_size"] == sum(sizes)


def test_limit_and_pushdown_stop_early(spark, tmp_dir):
    path = write(tmp_dir, NAME, [response()] * 7)
    assert read_warc(spark, path, limit=3).count() == 3
    df = read_warc(spark, path).where(F.col("rec_idx") < 2)
    assert df.count() == 2
    assert df.where(F.col("rec_type") == "response").count() == 2


def test_bad_bytes_are_errored(spark, tmp_dir):
    path = write(tmp_dir, NAME, [response(body=PAGE.encode() + b"\xff")])
    c = classify(read_warc(spark, path), ["*"]).collect()[0]
    assert c["valid"] and c["html"] is None


def test_unknown_coding_sets_payload_error(spark, tmp_dir):
    from warcsift.sources.fixtures import http_bytes, warc_bytes
    block = http_bytes("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"),
                                           ("Content-Encoding", "br")], b"\x00\x01")
    rec = warc_bytes([("WARC-Type", "response"), ("WARC-Target-URI", "https://a.example/x"),
                      ("Content-Type", "application/http; msgtype=response")], block)
    path = write(tmp_dir, NAME, [rec])
    r = classify(read_warc(spark, path), ["*"]).collect()[0]
    assert r["payload_error"].startswith("unsupported content-encoding")
    assert r["valid"] and r["html"] is None


def test_truncated_file_is_reported(spark, tmp_dir):
    import gzip
    good = gzip.compress(response(), mtime=0)
    bad = gzip.compress(response(), mtime=0)[:-40]
    path = os.path.join(tmp_dir, NAME)
    with open(path, "wb") as f:
        f.write(good + bad)
    recs = read_warc(spark, path)
    assert recs.where("rec_type = 'response'").count() == 1
    errs = scan_errors(recs).collect()
    assert len(errs) == 1 and "truncated" in errs[0]["message"]
    import pytest
    with pytest.raises(Exception):
        read_warc(spark, path, mode="FAILFAST").collect()


def test_arc_records(spark, tmp_dir):
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + \
        PAGE.encode("utf-8")
    arc = (b"filedesc://x.arc 0.0.0.0 20210102084234 text/plain 4\nabc\n\n"
           + b"https://news.example.com/a 1.2.3.4 20210102084234 text/html "
           + str(len(block)).encode() + b"\n" + block + b"\n")
    path = os.path.join(tmp_dir, "CC-NEWS-20210102084234-01434.arc")
    with open(path, "wb") as f:
        f.write(arc)
    rows = read_warc(spark, path).orderBy("rec_idx").collect()
    assert [r["rec_type"] for r in rows] == ["warcinfo", "response"]
    c = classify(read_warc(spark, path), ["*"]).where("valid").collect()
    assert len(c) == 1 and c[0]["url"] == "https://news.example.com/a"


def test_header_lookup_case_and_first_hit(spark, tmp_dir):
    rec = response(rec_headers=[("warc-target-uri", "https://second.example/")])
    path = write(tmp_dir, NAME, [rec])
    r = classify(read_warc(spark, path), ["*"]).collect()[0]
    assert r["url"] == "https://news.example.com/2021/01/02/bridge"


def test_deflate_raw_stream(spark, tmp_dir):
    from warcsift.sources.framing import _decode_body
    raw = zlib.compressobj(wbits=-15)
    data = raw.compress(b"hello") + raw.flush()
    assert _decode_body(data, [("Content-Encoding", "deflate")]) == (b"hello", None)


def test_header_only_scan(spark, tmp_dir):
    path = write(tmp_dir, NAME, [response(), request()])
    rows = read_warc(spark, path, payload=False).collect()
    assert all(r["payload"] is None for r in rows)
    assert [r["rec_type"] for r in sorted(rows, key=lambda r: r["rec_idx"])] == [
        "response", "request"]


def test_reader_without_pushdown(spark, tmp_dir):
    from warcsift.sources.warc import register
    register(spark)
    path = write(tmp_dir, NAME, [response(), request(), response()])
    df = (spark.read.format("warc").option("pushdown", "false").load(path)
          .where((F.col("rec_type") == "response") & (F.col("rec_idx") < 2)))
    assert [r["rec_idx"] for r in df.collect()] == [0]
