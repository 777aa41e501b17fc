"""Hand-made archive records for tests."""

import gzip
import os

from warcsift.sources.fixtures import encode_body, http_bytes, warc_bytes

PAGE = ("<html><head><title>Council approves the new harbour bridge plan</title>"
        '<meta property="article:published_time" content="2021-01-02T10:00:00Z"></head>'
        "<body><nav><a href='/'>Home</a></nav><article><h1>Council approves the new harbour "
        "bridge plan</h1><p>The council voted on Monday and the plan was approved by a large "
        "majority of the members.</p><p>It is the first time that the city has built a bridge "
        "of this size in more than fifty years.</p></article><footer>(c) paper</footer>"
        "</body></html>")


def response(url="https://news.example.com/2021/01/02/bridge", ct="text/html; charset=utf-8",
             body=PAGE.encode("utf-8"), coding=0, rec_headers=None, with_uri=True):
    rh = [("WARC-Type", "response"), ("WARC-Date", "2021-01-02T08:42:34Z")]
    if with_uri:
        rh.append(("WARC-Target-URI", url))
    rh += list(rec_headers or [])
    hh = [] if ct is None else [("Content-Type", ct)]
    payload, extra = encode_body(body, coding)
    block = http_bytes("HTTP/1.1 200 OK", hh + extra, payload)
    return warc_bytes(rh + [("Content-Type", "application/http; msgtype=response")], block)


def request(url="https://news.example.com/a"):
    rh = [("WARC-Type", "request"), ("WARC-Target-URI", url),
          ("WARC-Date", "2021-01-02T08:42:34Z")]
    block = http_bytes("GET /a HTTP/1.1", [("Host", "news.example.com")], b"")
    return warc_bytes(rh + [("Content-Type", "application/http; msgtype=request")], block)


def warcinfo():
    return warc_bytes([("WARC-Type", "warcinfo"), ("WARC-Date", "2021-01-02T08:42:34Z"),
                       ("Content-Type", "application/warc-fields")], b"software: test\r\n")


def write(dirpath, name, records, gz=True):
    os.makedirs(dirpath, exist_ok=True)
    path = os.path.join(dirpath, name)
    with open(path, "wb") as f:
        for r in records:
            f.write(gzip.compress(r, mtime=0) if gz else r)
    return path
