"""Property test: any records written as WARC (plain or gzip members) read back."""

import gzip
import io

from hypothesis import given, settings, strategies as st

from warcsift.sources.fixtures import encode_body, http_bytes, warc_bytes
from warcsift.sources.framing import ByteStream, Record, iter_records

names = st.text(alphabet="ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz-", min_size=1,
                max_size=12).filter(lambda s: s.lower() not in (
                    "content-length", "content-type", "warc-type", "transfer-encoding",
                    "content-encoding"))
values = st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0x2FF,
                                        blacklist_characters="\x7f"), max_size=20).map(str.strip)
record = st.tuples(
    st.sampled_from(["response", "request", "warcinfo", "metadata"]),
    st.lists(st.tuples(names, values), max_size=4),
    st.binary(max_size=3000),
    st.integers(min_value=0, max_value=3),
)


def _bytes(rec):
    kind, hdrs, body, coding = rec
    rh = [("WARC-Type", kind)] + hdrs
    if kind in ("response", "request"):
        payload, extra = encode_body(body, coding if kind == "response" else 0)
        first = "HTTP/1.1 200 OK" if kind == "response" else "GET / HTTP/1.1"
        block = http_bytes(first, [("X-Test", "1")] + extra, payload)
        ct = f"application/http; msgtype={kind}"
    else:
        block, ct = body, "application/warc-fields"
    return warc_bytes(rh + [("Content-Type", ct)], block)


@settings(max_examples=60, deadline=None)
@given(st.lists(record, min_size=1, max_size=6), st.booleans(), st.integers(8, 4096))
def test_roundtrip(recs, gz, chunk):
    data = b"".join(gzip.compress(_bytes(r), mtime=0) if gz else _bytes(r) for r in recs)
    out = [x for x in iter_records(ByteStream(io.BytesIO(data), gz, chunk=chunk)) if isinstance(x, Record)]
    assert [o.rec_type for o in out] == [r[0] for r in recs]
    for o, (kind, hdrs, body, coding) in zip(out, recs):
        assert o.payload == body
        assert o.payload_error is None
        got = [(k, v) for k, v in o.rec_headers if k not in ("WARC-Type", "Content-Type",
                                                              "Content-Length")]
        assert got == [(k, v) for k, v in hdrs]
        if kind == "response":
            assert o.http_status == 200
        elif kind == "request":
            assert o.http_status is None and o.http_headers[0] == ("X-Test", "1")
        else:
            assert o.http_headers is None
    offs = [o.offset for o in out]
    assert offs == sorted(offs) and offs[0] == 0
