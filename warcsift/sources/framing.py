"""Record framing for web-archive files (WARC 0.x/1.x, ARC v1), streaming.

Used only inside the ``warc`` data source's tasks: a file, or a byte range of
it, is read front to back. Memory is bounded whatever the size of the file and of
its records: lines, record heads and kept payloads have a greatest size, and
what is not kept is skipped as it streams by.

* a reader of the byte range ``[start, end)`` owns the records whose offset lies
  in it: it looks for the first record start at or after ``start`` and goes on
  until the next record would start at or after ``end``;

* ``.gz`` input may hold many gzip members (usually one per record); the
  offset of a record is the compressed offset of the member it starts in,
  or the byte offset for plain files;
* WARC: version line, ``Name: value`` headers (folded lines joined), a
  ``Content-Length`` block, blank lines between records;
* ARC v1: ``url ip date mime length`` header line; the ``filedesc://``
  record becomes ``warcinfo``, all others ``response`` with WARC headers
  synthesised from the ARC line;
* HTTP records (``application/http``): status or request line, headers, then
  the body, de-chunked and decoded for ``gzip``/``deflate`` the way crawls need
  it: a coding list is undone from right to left, all gzip members are read, a
  body cut short keeps what could be decoded, and a body that is not in the
  declared coding (crawlers often store it decoded) is passed through;
* damage (corrupt or cut gzip, bad headers, a short block) is yielded as a
  :class:`Damage` in place of the record, and reading goes on at the next
  gzip member (or plain line) that starts a record.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field

CHUNK = 1 << 16   # small: what follows a gzip member in its chunk is copied once more
GZIP_START = b"\x1f\x8b\x08"
WARC_START = re.compile(rb"WARC/[0-9.]+\r?\n")
ARC_START = re.compile(rb"[a-z][a-z0-9+.-]*:[^ \r\n]* [^ \r\n]+ [0-9]{14} [^\r\n]+ [0-9]+\r?\n")
LONGEST_START = 1 << 13
MAX_HEAD = 1 << 20            # bytes of a header line, and of a block's HTTP head
MAX_PAYLOAD = 256 << 20       # bytes of a payload, as stored and as decoded


class DamagedError(ValueError):
    """Bytes that cannot be read as a record."""


class TruncatedError(DamagedError):
    pass


@dataclass
class Damage:
    """A gap in a file: where reading stopped, and why."""

    offset: int
    message: str


class ByteStream:
    """Forward-only reader over plain or multi-member gzip bytes.

    ``raw`` stands at byte ``at`` of its file. It is read up to multiples of
    ``chunk``, so that readers that start at different bytes see the same chunks.
    """

    def __init__(self, raw, gz: bool, chunk: int = CHUNK, at: int = 0):
        self.raw, self.gz, self.chunk = raw, gz, chunk
        self.buf = bytearray()
        self.pos = 0              # read position in buf
        self.base = 0 if gz else at   # (decompressed) offset of buf[0]
        self.raw_pos = at         # raw bytes consumed
        self.raw_read = at        # raw bytes read
        self.members: list[tuple[int, int]] = []   # (decompressed start, raw offset)
        self.eof = False
        self._d = None
        self._pending = b""       # raw bytes not yet fed to a decompressor
        self._fed = b""           # the raw bytes fed last

    # -- filling
    def _read_raw(self) -> bytes:
        data = self.raw.read(self.chunk - self.raw_read % self.chunk) or b""
        self.raw_read += len(data)
        return data

    def _fill(self) -> bool:
        if self.eof:
            return False
        while True:
            if self.gz:
                if self._d is None:
                    if not self._pending:
                        self._pending = self._read_raw()
                        if not self._pending:
                            self.eof = True
                            return False
                    start_raw = self.raw_pos
                    self._d = zlib.decompressobj(31)
                    self.members.append((self.base + len(self.buf), start_raw))
                data = self._pending or self._read_raw()
                self._pending = b""
                if not data:
                    self._d = None
                    self.eof = True
                    raise TruncatedError("truncated gzip member")
                self._fed = data
                try:
                    out = self._d.decompress(data)
                except zlib.error as e:
                    self._d = None
                    raise DamagedError(f"corrupt gzip member: {e}") from e
                self._fed = b""
                used = len(data) - len(self._d.unused_data)
                self.raw_pos += used
                if self._d.eof:
                    self._pending = self._d.unused_data
                    self._d = None
                if out:
                    self.buf += out
                    return True
            else:
                data = self._read_raw()
                if not data:
                    self.eof = True
                    return False
                self.raw_pos += len(data)
                self.buf += data
                return True

    def _compact(self):
        if self.pos > (1 << 20):
            del self.buf[:self.pos]
            self.base += self.pos
            self.pos = 0

    def settle(self) -> None:
        """Read on to the end of a member of which only blank lines are left, so
        that its checksum is tested before its record is given out."""
        while self.gz and self._d is not None and not self.eof and not bytes(self.buf[self.pos:]).strip(b"\r\n"):
            self._fill()

    def resync(self, start: re.Pattern) -> bool:
        """Drop what is buffered and go on at the next record start; False at the end."""
        return self._next_member(start) if self.gz else self._next_line(start)

    def _next_member(self, start: re.Pattern) -> bool:
        data = self._fed[1:] + self._pending
        at = self.raw_pos + len(self._fed) - len(self._fed[1:])   # raw offset of data[0]
        self._fed = self._pending = b""
        self._d = None
        while True:
            i = data.find(GZIP_START)
            while 0 <= i and len(data) - i < LONGEST_START:
                more = self._read_raw()
                data += more
                if not more:
                    self.eof = True
                    break
            if i < 0:
                keep = len(GZIP_START) - 1
                more = b"" if self.eof else self._read_raw()
                if not more:
                    self.eof = True
                    self._drop(at + len(data))
                    return False
                at += max(0, len(data) - keep)
                data = data[-keep:] + more
                continue
            try:
                head = zlib.decompressobj(31).decompress(data[i:i + LONGEST_START], LONGEST_START)
            except zlib.error:
                head = b""
            if start.match(head):
                self._drop(at + i)
                self._pending = data[i:]
                self.eof = False
                return True
            at, data = at + i + 1, data[i + 1:]

    def _next_line(self, start: re.Pattern) -> bool:
        while True:
            i = self.buf.find(b"\n", self.pos)
            if i < 0:
                self.pos = len(self.buf)
                self._compact()
                if not self._fill():
                    return False
                continue
            self.pos = i + 1
            if start.match(self.peek(LONGEST_START)):
                return True

    def _drop(self, raw_pos: int) -> None:
        self.base += len(self.buf)
        self.buf.clear()
        self.pos, self.raw_pos = 0, raw_pos
        self.members.clear()

    def at_boundary(self) -> bool:
        """Nothing is buffered, and no gzip member is open."""
        return self._d is None and self.pos == len(self.buf)

    def tell(self) -> int:
        return self.base + self.pos

    def raw_offset(self) -> int:
        """Compressed offset of the member holding the current position."""
        if not self.gz:
            return self.tell()
        here = self.tell()
        best = 0
        for start, raw in self.members:
            if start <= here:
                best = raw
            else:
                break
        # forget members that end before here
        while len(self.members) > 1 and self.members[1][0] <= here:
            self.members.pop(0)
        return best

    # -- reading
    def peek(self, n: int) -> bytes:
        while len(self.buf) - self.pos < n and self._fill():
            pass
        return bytes(self.buf[self.pos:self.pos + n])

    def readline(self) -> bytes:
        seen = 0
        while True:
            i = self.buf.find(b"\n", self.pos + seen)
            if i >= 0:
                line = bytes(self.buf[self.pos:i + 1])
                self.pos = i + 1
                self._compact()
                return line
            seen = len(self.buf) - self.pos
            if seen > MAX_HEAD:
                raise DamagedError(f"header line of more than {MAX_HEAD} bytes")
            if not self._fill():
                line = bytes(self.buf[self.pos:])
                self.pos = len(self.buf)
                return line

    def read(self, n: int) -> bytes:
        while len(self.buf) - self.pos < n and self._fill():
            pass
        out = bytes(self.buf[self.pos:self.pos + n])
        self.pos += len(out)
        self._compact()
        return out

    def skip(self, n: int) -> int:
        """Pass over ``n`` bytes, holding one chunk at a time; how many there were."""
        left = n
        while left:
            here = len(self.buf) - self.pos
            if here >= left:
                self.pos += left
                self._compact()
                return n
            left -= here
            self.base += len(self.buf)
            self.buf.clear()
            self.pos = 0
            if not self._fill():
                break
        return n - left


class Block:
    """The next ``length`` bytes of a stream, read piece by piece."""

    def __init__(self, stream: ByteStream, length: str | None):
        if not re.fullmatch("[0-9]+", length or "0"):
            raise DamagedError(f"bad record length: {length[:40]}")
        self.stream, self.left = stream, int(length or 0)

    def read(self, n: int) -> bytes:
        n = min(n, self.left)
        out = self.stream.read(n)
        if len(out) < n:
            raise TruncatedError("truncated record block")
        self.left -= n
        return out

    def peek(self, n: int) -> bytes:
        return self.stream.peek(min(n, self.left))[:self.left]

    def close(self) -> None:
        """Pass over what has not been read."""
        if self.stream.skip(self.left) < self.left:
            raise TruncatedError("truncated record block")
        self.left = 0


@dataclass
class Record:
    rec_type: str | None
    offset: int
    rec_headers: list[tuple[str, str]] | None
    http_status: int | None = None
    http_headers: list[tuple[str, str]] | None = None
    payload: bytes | None = None
    payload_error: str | None = None
    extra: dict = field(default_factory=dict)


def _get(headers, name):
    name = name.lower()
    for k, v in headers or ():
        if k.lower() == name:
            return v
    return None


def _parse_header_lines(lines: list[bytes]) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for raw in lines:
        line = raw.decode("utf-8", "replace").rstrip("\r\n")
        if line[:1] in (" ", "\t") and out:
            k, v = out[-1]
            out[-1] = (k, v + " " + line.strip())
            continue
        if ":" in line:
            k, v = line.split(":", 1)
            out.append((k.strip(), v.strip()))
    return out


def _dechunk(body: bytes) -> bytes:
    """Chunks joined; what is not chunked is passed through, a cut body kept so far."""
    out, i = bytearray(), 0
    while True:
        j = body.find(b"\r\n", i)
        size = body[i:j].split(b";")[0].strip() if j >= 0 else b""
        if not re.fullmatch(rb"[0-9a-fA-F]{1,15}", size):
            return bytes(out) if i else body
        n = int(size, 16)
        if n == 0:
            return bytes(out)
        out += body[j + 2:j + 2 + n]
        i = j + 2 + n + 2
        if i >= len(body):
            return bytes(out)


class TooLargeError(ValueError):
    """A payload beyond its greatest size."""

    def __init__(self, most: int):
        super().__init__(f"payload of more than {most} bytes")


def _inflate(body: bytes, wbits: int, most: int = MAX_PAYLOAD) -> bytes | None:
    """All members of a compressed body; None if not even the first bytes fit."""
    out, data = bytearray(), body
    while data:
        d = zlib.decompressobj(wbits)
        at, fed = 0, data[:CHUNK]
        try:
            while fed and not d.eof:
                out += d.decompress(fed, CHUNK)
                if len(out) > most:
                    raise TooLargeError(most)
                fed = d.unconsumed_tail
                if not fed:
                    at += CHUNK
                    fed = data[at:at + CHUNK]
        except zlib.error:
            # after complete members: trailing bytes that are no member
            return bytes(out) if out else None
        if not d.eof:
            out += d.flush()
            return bytes(out)
        rest = d.unused_data + data[at + CHUNK:]
        data = rest if wbits == 31 and rest.startswith(GZIP_START[:2]) else b""
    return bytes(out)


def _decode_body(body: bytes, headers, most: int = MAX_PAYLOAD) -> tuple[bytes | None, str | None]:
    te = (_get(headers, "Transfer-Encoding") or "").lower()
    ce = (_get(headers, "Content-Encoding") or "").lower()
    if "chunked" in te:
        body = _dechunk(body)
    for coding in reversed([c.strip() for c in ce.split(",")]):
        try:
            if coding in ("gzip", "x-gzip"):
                found = _inflate(body, 31, most)
            elif coding == "deflate":
                found = _inflate(body, 15, most)
                if found is None:
                    found = _inflate(body, -15, most)
            elif coding in ("", "identity"):
                continue
            else:
                return body, f"unsupported content-encoding {coding}"
        except TooLargeError as e:
            return None, str(e)
        if found is None:  # stored in another coding than declared
            break
        body = found
    return body, None


def _http_head(block: Block) -> bytes:
    """An HTTP message's head, read from its block up to the blank line; without
    one, the first ``MAX_HEAD`` bytes of the block."""
    size = 1 << 13
    while True:
        seen = block.peek(size)
        ends = [i + len(sep) for sep in (b"\r\n\r\n", b"\n\n") if (i := seen.find(sep)) >= 0]
        if ends or len(seen) < size or size >= MAX_HEAD:
            return block.read(min(ends) if ends else len(seen))
        size = min(size * 8, MAX_HEAD)


def _parse_head(head: bytes, is_response: bool):
    """(status, headers) of an HTTP message; status None for requests."""
    lines = head.rstrip(b"\r\n").split(b"\n")
    first = lines[0].decode("utf-8", "replace").strip()
    status = None
    if is_response and first.upper().startswith("HTTP/"):
        parts = first.split(None, 2)
        if len(parts) > 1 and re.fullmatch("[0-9]{1,9}", parts[1]):
            status = int(parts[1])
    return status, _parse_header_lines(lines[1:])


HTTP_TYPES = ("response", "request", "revisit")


@dataclass
class Reading:
    """How the records of a file, or of a byte range of it, are read."""

    arc: bool | None = None                # ARC v1; None: by the first line
    wants: Callable[[Record], bool] = lambda rec: True   # from its headers: is a record's payload read?
    end: int | None = None                 # offset from which on records are another reader's
    max_payload: int = MAX_PAYLOAD


def _take(rec: Record, block: Block, how: Reading) -> bytes | None:
    """The rest of the block if it is wanted and not too large."""
    if not how.wants(rec):
        return None
    if block.left > how.max_payload:
        rec.payload_error = str(TooLargeError(how.max_payload))
        return None
    return block.read(block.left)


def _finish_http(rec: Record, block: Block, how: Reading):
    ct = (_get(rec.rec_headers, "Content-Type") or "").lower()
    if rec.rec_type in HTTP_TYPES and ct.startswith("application/http"):
        rec.http_status, rec.http_headers = _parse_head(_http_head(block), rec.rec_type != "request")
        body = _take(rec, block, how)
        if body is not None:
            rec.payload, rec.payload_error = _decode_body(body, rec.http_headers, how.max_payload)
    else:
        rec.payload = _take(rec, block, how)


def _arc_date(d: str) -> str | None:
    if len(d) >= 14 and d[:14].isdigit():
        return f"{d[0:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"
    return None


@dataclass
class Stop:
    """Offset of the first record that belongs to the next reader; None at the file's end."""

    offset: int | None


def iter_records(stream: ByteStream, how: Reading | None = None, resync: bool = False):
    """Yield a :class:`Record` or :class:`Damage` for each record, in file order,
    and a :class:`Stop` at the end. With ``resync`` the first one is looked for."""
    how = how or Reading()
    start = ARC_START if how.arc else WARC_START
    if resync and not stream.resync(start):
        yield Stop(None)
        return
    while True:
        offset = stream.raw_pos if stream.at_boundary() else stream.raw_offset()
        try:
            # blank lines between records
            while stream.peek(2) == b"\r\n" or stream.peek(1) == b"\n":
                stream.readline()
            if not stream.peek(1):
                yield Stop(None)
                return
            offset = stream.raw_offset()
            if how.end is not None and offset >= how.end:
                yield Stop(offset)
                return
            first = stream.readline()
            text = first.decode("utf-8", "replace").strip()
            is_arc = how.arc if how.arc is not None else not text.startswith("WARC/")
            rec = (_arc_record if is_arc else _warc_record)(stream, text, offset, how)
            stream.settle()
        except ValueError as e:
            yield Damage(offset, str(e))
            if not stream.resync(start):
                yield Stop(None)
                return
        else:
            yield rec


def _warc_record(stream: ByteStream, text: str, offset: int, how: Reading) -> Record:
    lines, size = [], 0
    while True:
        line = stream.readline()
        if not line:
            raise TruncatedError("truncated record headers")
        if line in (b"\r\n", b"\n"):
            break
        size += len(line)
        if size > MAX_HEAD:
            raise DamagedError(f"record headers of more than {MAX_HEAD} bytes")
        lines.append(line)
    hdrs = _parse_header_lines(lines)
    rec = Record(_get(hdrs, "WARC-Type"), offset, hdrs)
    block = Block(stream, _get(hdrs, "Content-Length"))
    _finish_http(rec, block, how)
    block.close()
    return rec


def _arc_record(stream: ByteStream, text: str, offset: int, how: Reading) -> Record:
    parts = text.split(" ")
    if len(parts) < 5 or not parts[-1].isdigit():
        raise DamagedError(f"bad record start: {text[:80]}")
    url, ip, date, mime, length = (parts[0], parts[1], parts[2], " ".join(parts[3:-1]), parts[-1])
    block = Block(stream, length)
    if url.startswith("filedesc://"):
        rec = Record("warcinfo", offset, [
            ("WARC-Type", "warcinfo"), ("WARC-Date", _arc_date(date) or ""),
            ("Content-Type", "text/plain"), ("Content-Length", length)])
        rec.payload = _take(rec, block, how)
    else:
        rec = Record("response", offset, [
            ("WARC-Type", "response"), ("WARC-Target-URI", url), ("WARC-Date", _arc_date(date) or ""),
            ("WARC-IP-Address", ip), ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", length)])
        if block.peek(5).upper() == b"HTTP/":
            _finish_http(rec, block, how)
        else:
            rec.http_headers = [("Content-Type", mime)]
            rec.payload = _take(rec, block, how)
    block.close()
    return rec
