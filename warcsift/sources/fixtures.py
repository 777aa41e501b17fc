"""Write archive files from ``responses`` rows, to check the ``warc`` source.

Each output file is one group of the fixture decoration (20 records, fixed by
``page_id div 20``), written by one task with ``applyInPandas``; nothing goes
through the driver. Formats: WARC with one gzip member per record (default)
or plain, optionally with HTTP bodies coded (or mislabelled) by a rule chosen
by ``rec_idx % 10``, see ``encode_body``, or ARC v1 (response records only, after a
``filedesc://`` record).
"""

from __future__ import annotations

import gzip
import zlib

from pyspark.sql import DataFrame

RESULT_SCHEMA = "warc_path string, n_records long, n_bytes long"


def warc_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers)
    head += f"Content-Length: {len(block)}\r\n\r\n"
    return head.encode("utf-8") + block + b"\r\n\r\n"


def http_bytes(first_line: str, headers: list[tuple[str, str]], body: bytes) -> bytes:
    head = first_line + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode("utf-8") + body


def encode_body(body: bytes, rule: int) -> tuple[bytes, list[tuple[str, str]]]:
    """Body coding by rule: 1 chunked, 2 gzip, 3 deflate, 4 plain but labelled gzip,
    5 plain but labelled chunked, 6 two gzip members, 7 a coding list with identity,
    8 gzip cut before its checksum, 9 gzip inside deflate, else identity."""
    if rule == 1:
        parts, step = [], 1000
        for i in range(0, len(body), step):
            c = body[i:i + step]
            parts.append(b"%x\r\n" % len(c) + c + b"\r\n")
        return b"".join(parts) + b"0\r\n\r\n", [("Transfer-Encoding", "chunked")]
    if rule == 2:
        return gzip.compress(body, mtime=0), [("Content-Encoding", "gzip")]
    if rule == 3:
        return zlib.compress(body), [("Content-Encoding", "deflate")]
    half, packed = len(body) // 2, gzip.compress(body, mtime=0)
    return {
        4: (body, [("Content-Encoding", "gzip")]),
        5: (body, [("Transfer-Encoding", "chunked")]),
        6: (gzip.compress(body[:half], mtime=0) + gzip.compress(body[half:], mtime=0), [("Content-Encoding", "gzip")]),
        7: (packed, [("Content-Encoding", "gzip, identity")]),
        8: (packed[:-8], [("Content-Encoding", "x-gzip")]),
        9: (zlib.compress(packed), [("Content-Encoding", "gzip, deflate")]),
    }.get(rule, (body, []))


def damaged(members: list[bytes], file_no: int) -> list[bytes]:
    """Gzip members with damage by file: 1 of 4 has bytes flipped in the middle
    record, 2 of 4 is cut within the last record; 3 of 4 is left to be missing."""
    out = list(members)
    if file_no % 4 == 1:
        m = bytearray(out[len(out) // 2])
        for i in range(len(m) // 2, len(m) // 2 + 4):
            m[i] ^= 0xFF
        out[len(out) // 2] = bytes(m)
    elif file_no % 4 == 2:
        out[-1] = out[-1][:len(out[-1]) // 2]
    return out


def _pairs(h) -> list[tuple[str, str]] | None:
    if h is None:
        return None
    return [(x["name"], x["value"]) for x in h]


def _record_bytes(r, encodings: bool) -> bytes:
    rec_type = r["rec_type"]
    rh = [(k, v) for k, v in (_pairs(r["rec_headers"]) or []) if k.lower() != "content-length"]
    hh = _pairs(r["http_headers"])
    payload = bytes(r["payload"]) if r["payload"] is not None else b""
    if hh is None:
        return warc_bytes(rh + [("Content-Type", "application/warc-fields")], payload)
    extra: list[tuple[str, str]] = []
    if encodings and rec_type == "response":
        payload, extra = encode_body(payload, int(r["rec_idx"]) % 10)
    if rec_type == "request":
        block = http_bytes("GET / HTTP/1.1", hh + extra, payload)
    else:
        block = http_bytes(f"HTTP/1.1 {int(r['http_status'] or 200)} OK", hh + extra, payload)
    return warc_bytes(rh + [("Content-Type", f"application/http; msgtype={rec_type}")], block)


def _arc_bytes(pdf) -> bytes:
    out = [b"filedesc://fixture.arc 0.0.0.0 20210101000000 text/plain 9\nfixture\n\n"]
    for _, r in pdf.iterrows():
        if r["rec_type"] != "response":
            continue
        hh = _pairs(r["http_headers"]) or []
        block = http_bytes("HTTP/1.1 200 OK", hh, bytes(r["payload"]))
        rh = dict(_pairs(r["rec_headers"]) or [])
        date = rh.get("WARC-Date", "2021-01-01T00:00:00Z")
        d14 = "".join(ch for ch in date if ch.isdigit())[:14]
        mime = dict((k.lower(), v) for k, v in hh).get("content-type", "-") or "-"
        mime = mime.replace(" ", "")
        line = f"{rh.get('WARC-Target-URI', '-')} 0.0.0.0 {d14} {mime} {len(block)}\n"
        out.append(line.encode("utf-8") + block + b"\n")
    return b"".join(out)


def write_fixture(responses: DataFrame, root: str, fmt: str = "warc.gz",
                  encodings: bool = False, damage: bool = False) -> DataFrame:
    """Write one archive file per ``warc_path`` below ``root``; returns a report.

    ``fmt``: ``warc.gz`` (gzip member per record), ``warc`` (plain) or ``arc``.
    ``damage`` breaks some files (see ``damaged``) and does not write others.
    The call is lazy like any DataFrame; collect or count the report to run it.
    """
    root = root.rstrip("/")

    def write(pdf):
        import pandas as pd

        from ..session import fs_and_path

        pdf = pdf.sort_values("rec_idx")
        rel = pdf["warc_path"].iloc[0]
        if fmt == "arc":
            rel = rel.replace(".warc.gz", ".arc.gz")
            data = gzip.compress(_arc_bytes(pdf), mtime=0)
        else:
            parts = [_record_bytes(r, encodings) for _, r in pdf.iterrows()]
            if fmt == "warc":
                rel = rel.replace(".warc.gz", ".warc")
                data = b"".join(parts)
            else:
                members = [gzip.compress(p, mtime=0) for p in parts]
                file_no = int(rel.rsplit("-", 1)[1].split(".")[0])
                data = b"".join(damaged(members, file_no) if damage else members)
                if damage and file_no % 4 == 3:
                    return pd.DataFrame({"warc_path": [f"{root}/{rel}"], "n_records": [0], "n_bytes": [0]})
        uri = f"{root}/{rel}"
        fs, path = fs_and_path(uri)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(path, compression=None) as f:
            f.write(data)
        return pd.DataFrame({"warc_path": [uri], "n_records": [len(pdf)],
                             "n_bytes": [len(data)]})

    return responses.groupBy("warc_path").applyInPandas(write, RESULT_SCHEMA)
