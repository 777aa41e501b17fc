"""``spark.read.format("warc")``: web-archive files as a DataFrame.

One input partition per file, or, with ``read_warc(split_bytes=...)``, one per
byte range of at most about that size (very many small ranges are dealt over fewer
partitions, see ``deal``): archives are compressed record by record
(or not at all), so a task can find the first record of its range and read on to
the first one of the next. A task streams its range and yields Arrow batches of
``batch_size`` records or about ``batch_bytes`` bytes; a record's head and payload
have a greatest size and what is not wanted is skipped, so memory is bounded,
whatever the size of files and records.

Files are opened through pyarrow, not through Hadoop: credentials and
endpoints come from the environment of the executors, not from
``spark.hadoop.fs.*`` settings.

Options:

``path`` / ``load(path)``  file, directory (its .warc/.arc[.gz] files), glob,
                            or comma-separated list
``paths``                   JSON list of files (e.g. from ``warc_index``)
``limit``                   read at most this many records per file
``payload``                 ``false`` skips bodies (header-only jobs); ``html``
                            reads them only for responses whose headers may
                            make an article: UTF-8 HTML, and a URL that
                            matches ``url_regex`` where given. Every record
                            is still emitted.
``arc``                     ``true``/``false`` forces the ARC v1 reader
                            (default: by file name / first line)
``mode``                    ``PERMISSIVE`` (default): damage yields one
                            ``rec_type='_error'`` row and reading goes on at
                            the next record that can be found; a missing or
                            unreadable file yields one such row; ``FAILFAST``
                            raises in all these cases
``max_payload``             greatest size of a payload in bytes, as stored and
                            as decoded (default 256 MiB); a larger one (such as
                            a decompression bomb) is a ``payload_error``
``splits``                  JSON object: byte ranges of files, from
                            :func:`plan_splits`
``batch_size``              records per Arrow batch (default 256)
``batch_bytes``             payload bytes after which a batch is given out
                            (default 32 MiB)

Pushed filters (when the session enables Python filter pushdown;
``read_warc`` passes that on as option ``pushdown``): ``rec_type = / IN`` and
``rec_idx < / <=`` (the latter stop reading early, like ``limit``).
"""

from __future__ import annotations

import fnmatch
import json
import re

from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, In,
                                    InputPartition, IsNotNull, LessThan, LessThanOrEqual)

from ..schemas import RAW_RECORDS

NAME = "warc"
MANY_RANGES, TASK_BYTES = 256, 16 << 20
UNREADABLE = "unreadable: "   # start of the message where a file could not be read, or not to its end
ERROR_TYPE = "_error"   # rows that tell of damage; never counted as records
# A directory contributes only its archive files (listings and markers next
# to them are skipped); explicit files and globs are taken as given.
ARCHIVE_SUFFIXES = (".warc", ".warc.gz", ".arc", ".arc.gz")
_GLOB = re.compile(r"[*?\[]")


class FilePartition(InputPartition):
    """A file, or the records of it that start in the bytes ``[start, end)``, of
    which ``base`` records stand before."""

    def __init__(self, path: str, size: int | None, missing: bool = False,
                 start: int = 0, end: int | None = None, base: int = 0):
        super().__init__((path, start))
        self.path, self.size, self.missing = path, size, missing
        self.start, self.end, self.base = start, end, base


class DealtPartition(InputPartition):
    """Ranges read one after the other by one task."""

    def __init__(self, parts: list[FilePartition]):
        super().__init__((parts[0].path, parts[0].start))
        self.parts = parts


def tasks_for(n: int, total: int) -> int:
    """Tasks for ``n`` ranges of ``total`` bytes: one each, but beyond ``MANY_RANGES`` only
    one per ``TASK_BYTES`` (starting a task costs more than reading a small range)."""
    return min(n, max(MANY_RANGES, -(-total // TASK_BYTES)))


def deal(parts: list[FilePartition]) -> list[InputPartition]:
    """One partition a range where there are few; else ranges dealt in turn, so that
    neighbours (the ranges of a file) are read by different tasks."""
    n = tasks_for(len(parts), sum(size or 0 for size in {p.path: p.size for p in parts}.values()))
    return list(parts) if n == len(parts) else [DealtPartition(parts[i::n]) for i in range(n)]


def _fs_and_path(uri: str):
    from ..session import fs_and_path
    return fs_and_path(uri)


def _scheme(uri: str) -> str:
    if uri.startswith("file:") or "://" not in uri:
        return ""
    return uri.split("://", 1)[0] + "://"


def list_files(spec: str) -> list[tuple[str, int | None]]:
    """Expand a path / directory / glob into (uri, size) pairs, sorted."""
    from pyarrow import fs as pafs
    out = []
    for one in [s.strip() for s in spec.split(",") if s.strip()]:
        fs, p = _fs_and_path(one)
        pre = _scheme(one)
        if _GLOB.search(p):
            m = _GLOB.search(p)
            base = p[:m.start()].rsplit("/", 1)[0] or "/"
            infos = fs.get_file_info(pafs.FileSelector(base, recursive=True))
            for i in infos:
                if i.type == pafs.FileType.File and fnmatch.fnmatchcase(i.path, p):
                    out.append((pre + i.path, i.size))
            continue
        info = fs.get_file_info(p)
        if info.type == pafs.FileType.Directory:
            for i in fs.get_file_info(pafs.FileSelector(p, recursive=True)):
                name = i.base_name
                if (i.type == pafs.FileType.File and not name.startswith((".", "_"))
                        and name.lower().endswith(ARCHIVE_SUFFIXES)):
                    out.append((pre + i.path, i.size))
        elif info.type == pafs.FileType.File:
            out.append((pre + info.path, info.size))
    return sorted(set(out))


def stat_files(paths: list[str]) -> list[tuple[str, int | None, bool]]:
    """(uri, size, missing) of explicit files: one metadata call per filesystem, not
    per file (globs and directories in the list are expanded as usual)."""
    from pyarrow import fs as pafs
    out: list[tuple[str, int | None, bool]] = []
    plain: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for uri in paths:
        fs, p = _fs_and_path(uri)
        if _GLOB.search(p):
            out.extend((*f, False) for f in list_files(uri))
            continue
        pre = _scheme(uri)
        bucket = uri[len(pre):].split("/", 1)[0] if pre else ""
        plain.setdefault((pre, bucket), []).append((uri, p))
    for (pre, _), items in plain.items():
        fs, _ = _fs_and_path(items[0][0])
        infos = fs.get_file_info([p for _, p in items])
        for (uri, _), info in zip(items, infos):
            if info.type == pafs.FileType.File:
                out.append((pre + info.path, info.size, False))
            elif info.type == pafs.FileType.Directory:
                out.extend((*f, False) for f in list_files(uri))
            else:
                out.append((uri, None, True))
    return sorted(set(out), key=lambda f: f[0])


def _arrow_schema():
    import pyarrow as pa
    hdr = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
    return pa.schema([
        ("warc_path", pa.string()), ("rec_idx", pa.int64()), ("rec_offset", pa.int64()),
        ("file_size", pa.int64()), ("rec_type", pa.string()), ("rec_headers", hdr),
        ("http_status", pa.int32()), ("http_headers", hdr), ("payload", pa.binary()),
        ("payload_error", pa.string()),
    ])


def _hdrs(h):
    return None if h is None else [{"name": k, "value": v} for k, v in h]


class WarcReader(DataSourceReader):
    """Reader without filter pushdown (used when the session disables it)."""

    def __init__(self, options: dict):
        self.options = options
        self.rec_types: set[str] | None = None
        self.max_idx: int | None = None   # exclusive bound on rec_idx
        self.type_not_null = False

    def partitions(self):
        if "paths" in self.options:
            files = stat_files(json.loads(self.options["paths"]))
        else:
            files = stat_files([p.strip() for p in self.options.get("path", "").split(",") if p.strip()])
        splits = json.loads(self.options.get("splits") or "{}")
        parts = [FilePartition(*f, *cut) for f in files for cut in splits.get(f[0], [()])]
        return deal(parts) if splits else parts

    # ---- execution (executors)
    def read(self, partition: InputPartition):
        import pyarrow as pa

        opts = self.options
        batch, batch_bytes = int(opts.get("batch_size", 256)), int(opts.get("batch_bytes", 32 << 20))
        schema = _arrow_schema()
        rows, held = [], 0
        for part in getattr(partition, "parts", [partition]):
            for row in self._rows(part, schema):
                rows.append(row)
                held += len(row["payload"] or b"")
                if len(rows) >= batch or held >= batch_bytes:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def _rows(self, partition: FilePartition, schema):
        """The rows of one file or range."""
        from .framing import MAX_PAYLOAD, Damage, Reading, Stop

        opts = self.options
        limit = int(opts["limit"]) if opts.get("limit") not in (None, "") else None
        if self.max_idx is not None:
            limit = self.max_idx if limit is None else min(limit, self.max_idx)
        path = partition.path
        how = Reading(is_arc(path, opts.get("arc")), _wants(opts), partition.end, int(opts.get("max_payload", MAX_PAYLOAD)))
        failfast = str(opts.get("mode", "PERMISSIVE")).upper() == "FAILFAST"
        size = partition.size

        def row(idx, offset, rec_type, **values):
            return dict.fromkeys(schema.names) | {
                "warc_path": path, "rec_idx": idx, "rec_offset": offset, "file_size": size,
                "rec_type": rec_type, **values}

        def error(idx, offset, message):
            if failfast:
                raise OSError(f"{path}: {message}")
            return row(idx, offset, ERROR_TYPE, payload_error=message)

        def records():
            if partition.missing:
                yield Damage(0, "missing file")
                return
            yield from read_range(path, partition.start, how)

        if limit is not None:
            limit -= partition.base
        if limit is not None and limit <= 0:
            return
        idx = 0
        for rec in records():
            if isinstance(rec, Stop):
                break
            if isinstance(rec, Damage):
                if failfast or self.rec_types is None or ERROR_TYPE in self.rec_types:
                    yield error(partition.base + idx, rec.offset, rec.message)
                continue
            if (self.rec_types is None or rec.rec_type in self.rec_types) and not (
                    self.type_not_null and rec.rec_type is None):
                yield row(
                    partition.base + idx, rec.offset, rec.rec_type, rec_headers=_hdrs(rec.rec_headers),
                    http_status=rec.http_status, http_headers=_hdrs(rec.http_headers),
                    payload=rec.payload, payload_error=rec.payload_error)
            idx += 1
            if limit is not None and idx >= limit:
                break


def is_arc(path: str, option: str | None) -> bool | None:
    """ARC v1 by option or file name; None: by the first line."""
    if option:
        return str(option).lower() == "true"
    return True if path.lower().endswith((".arc", ".arc.gz")) else None


def read_range(path: str, start: int, how):
    """Records, damage and the stop of a file from its byte ``start`` on."""
    from .framing import ByteStream, Damage, Stop, iter_records
    try:
        fs, p = _fs_and_path(path)
        with fs.open_input_file(p) as raw:
            gz = raw.read(2) == b"\x1f\x8b"
            at = start if gz else max(start - 1, 0)   # a plain range starts after a line end
            raw.seek(at)
            yield from iter_records(ByteStream(raw, gz, at=at), how, resync=start > 0)
    except OSError as e:
        yield Damage(start, f"{UNREADABLE}{type(e).__name__}: {e}")
        yield Stop(None)


# ---- splits (driver): planned like a file listing, from a few numbers a range

RANGE = "path string, start long, end long"
COUNTED = f"{RANGE}, first long, stop long, records long"


def _count_ranges(batches):
    """One row per range: offset of its first record, where the next reader's begin,
    and the number of records, from heads alone."""
    import pyarrow as pa
    from .framing import Damage, Reading, Record, Stop
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            first = stop = None
            records = 0
            for x in read_range(r["path"], r["start"], Reading(r["arc"], lambda rec: False, r["end"])):
                if isinstance(x, Stop):
                    stop = x.offset
                else:
                    first = x.offset if first is None else first
                    records += isinstance(x, Record)
            if first is None:
                first = stop
            rows.append({k: r[k] for k in ("path", "start", "end")} | {"first": first, "stop": stop, "records": records})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([(n, pa.string() if n == "path" else pa.int64()) for n in (
            "path", "start", "end", "first", "stop", "records")]))


def plan_splits(spark, paths: list[str], split_bytes: int, arc: str | None = None) -> dict[str, list[list[int | None]]]:
    """``{path: [[start, end, base], ...]}`` for the files larger than ``split_bytes``.

    One Spark job reads each range's record heads. A range is good if the
    next one begins where it stopped; where a range took bytes inside a record
    for a record's start, or the other way, it is joined with its neighbour and
    read again, so that the ranges together hold exactly the rows of the whole
    file. ``base`` is the number of records before a range, so that
    ``rec_idx`` is the record's place in its file.
    """
    if split_bytes < 1:
        raise ValueError("split_bytes must be positive.")
    plan, sizes = {}, {}
    for path, size, missing in stat_files(paths):
        if not missing and size and size > split_bytes:
            sizes[path] = size
            n = -(-size // split_bytes)
            cuts = [size * i // n for i in range(n)]
            plan[path] = list(zip(cuts, [*cuts[1:], None]))
    found: dict[tuple, tuple] = {}
    while True:
        todo = [(p, a, b, is_arc(p, arc)) for p, ranges in plan.items() for a, b in ranges if (p, a, b) not in found]
        if not todo:
            break
        work = spark.createDataFrame(todo, RANGE + ", arc boolean").repartition(
            tasks_for(len(todo), sum(sizes[p] for p in {t[0] for t in todo})))
        for r in work.mapInArrow(_count_ranges, COUNTED).collect():
            found[r["path"], r["start"], r["end"]] = (r["first"], r["stop"], r["records"])
        for path, ranges in plan.items():
            joined = [ranges[0]]
            before = ranges[0]
            for a, b in ranges[1:]:
                if found[path, a, b][0] == found[(path, *before)][1]:
                    joined.append((a, b))
                else:
                    joined[-1] = (joined[-1][0], b)
                before = (a, b)
            plan[path] = joined
    out = {}
    for path, ranges in plan.items():
        base, out[path] = 0, []
        for a, b in ranges:
            out[path].append([a, b, base])
            base += found[path, a, b][2]
    return out


def _wants(opts: dict):
    """From a record's headers: is its payload read?"""
    from .framing import _get

    payload = str(opts.get("payload", "true")).lower()
    if payload != "html":
        return lambda rec: payload != "false"
    url_rx = re.compile(opts["url_regex"]) if opts.get("url_regex") else None

    def html(rec) -> bool:
        url, kind = _get(rec.rec_headers, "WARC-Target-URI"), _get(rec.http_headers, "Content-Type")
        if url is not None and url[:1] == "<" and url[-1:] == ">":
            url = url[1:-1]
        # wider than the record test (which decides): no valid record is left out
        return (rec.rec_type == "response" and url is not None and kind is not None
                and kind.lower().startswith("text/html;") and "utf-8" in kind.lower()
                and (url_rx is None or url_rx.match(url) is not None))

    return html


class WarcPushdownReader(WarcReader):
    """Reader that takes ``rec_type`` and ``rec_idx`` predicates into the scan."""

    def pushFilters(self, filters):
        for f in filters:
            col = f.attribute[0] if len(f.attribute) == 1 else None
            if isinstance(f, IsNotNull) and col == "rec_idx":
                continue                      # never NULL
            if isinstance(f, IsNotNull) and col == "rec_type":
                self.type_not_null = True
                continue
            if col == "rec_type" and isinstance(f, EqualTo) and isinstance(f.value, str):
                self.rec_types = {f.value} if self.rec_types is None else self.rec_types & {f.value}
            elif col == "rec_type" and isinstance(f, In) and all(isinstance(v, str) for v in f.value):
                vals = set(f.value)
                self.rec_types = vals if self.rec_types is None else self.rec_types & vals
            elif col == "rec_idx" and isinstance(f, (LessThan, LessThanOrEqual)) \
                    and isinstance(f.value, int):
                bound = f.value + (1 if isinstance(f, LessThanOrEqual) else 0)
                self.max_idx = bound if self.max_idx is None else min(self.max_idx, bound)
            else:
                yield f


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return NAME

    def schema(self):
        return RAW_RECORDS

    def reader(self, schema):
        opts = dict(self.options)
        # Spark refuses a reader with pushFilters() while the session has
        # Python filter pushdown off, so it is only offered when on.
        if str(opts.get("pushdown", "false")).lower() == "true":
            return WarcPushdownReader(opts)
        return WarcReader(opts)


def register(spark) -> None:
    """Make ``spark.read.format("warc")`` available in this session."""
    spark.dataSource.register(WarcDataSource)


def read_warc(spark, paths, split_bytes: int | None = None, **options):
    """Records of the given archive files (path, glob, dir, or list of them).

    ``split_bytes`` reads files larger than that by several tasks, at the price of
    one more pass over them that reads heads only (see :func:`plan_splits`).
    """
    register(spark)
    if split_bytes is not None:
        listed = list(paths) if isinstance(paths, (list, tuple)) else [p.strip() for p in paths.split(",") if p.strip()]
        options["splits"] = json.dumps(plan_splits(spark, listed, split_bytes, options.get("arc")))
    r = spark.read.format(NAME)
    push = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    r = r.option("pushdown", str(push).lower())
    for k, v in options.items():
        if v is not None:
            r = r.option(k, str(v).lower() if isinstance(v, bool) else str(v))
    if isinstance(paths, (list, tuple)):
        return r.option("paths", json.dumps(list(paths))).load()
    return r.load(paths)


def scan_errors(records):
    """(warc_path, rec_offset, message) of every gap met while reading."""
    return records.where(records["rec_type"] == ERROR_TYPE).select(
        "warc_path", "rec_offset", records["payload_error"].alias("message"))
