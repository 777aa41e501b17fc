"""Operator 4: personal data, and the terms that would give it away.

Protected entities are the base spans (e-mail, IP address, card and phone
numbers). Information-theoretic sanitisation then looks at all words of the
texts that hold an entity. From document counts over the whole corpus,

    PMI(e, t) = log2 P(e, t) / (P(e) P(t)),      IC(e) = -log2 P(e),

and a term whose PMI reaches ``THRESHOLD`` of the entity's information IC(e),
in one text with it in ``SUPPORT`` documents or more, reveals the entity almost
alone: it becomes a span of kind ``term`` wherever it stands, in texts without
the entity too. ``sanitise`` replaces entities by their kind, generalises
revealing terms that hold digits to their shape, and removes the others.

PMI >= THRESHOLD x IC asks for at most total ^ (1 - THRESHOLD) x entity_docs ^
THRESHOLD documents with the term, so more frequent terms form no pairs;
equal texts are paired once, with their number; entities (and terms) that
stand in the same texts are paired as one. The table of revealing terms is
written and joined with the words of all texts. Before either join, tasks drop
words whose checksum is not among those of the wanted terms (``BITS`` bits).

Defined results: null and empty texts have no spans; a null doc_id is carried
along; repeated rows are scanned each on its own (and count as documents);
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialise, text_of

THRESHOLD, SUPPORT = 0.9, 2
BITS = 1 << 25
METHOD_KIND = "term"
FLUSH = 500_000

_LOCAL, _LABEL = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
# Possessive, and begun only where a run begins: the same matches in linear time.
EMAIL = rf"{_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++"
PATTERNS = {
    "email": (re.compile(rf"(?<!{_LOCAL}){EMAIL}"), re.compile(EMAIL)),
    "ip": (re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"), None),
    "card": (re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++"), None),
    "phone": (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), None),
}
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _valid(kind: str, token: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in token.split("."))
    digits = sum("0" <= c <= "9" for c in token)
    if kind == "card":
        return 16 <= digits <= 19 and luhn(re.sub("[^0-9]", "", token))
    return kind == "email" or 8 <= digits <= 15


def _matches(kind: str, text: str) -> Iterator[tuple[int, int]]:
    if (kind == "email" and "@" not in text) or (kind == "phone" and "+" not in text):
        return
    begin, follow = PATTERNS[kind]
    m = begin.search(text)
    while m:
        yield m.span()
        # a run may begin right where the last match ended
        m = (follow and follow.match(text, m.end())) or begin.search(text, m.end())


def entities(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every base span, by kind as listed, then start."""
    return [(kind, s, e) for kind in PATTERNS for s, e in _matches(kind, text) if _valid(kind, text[s:e])]


def _value(kind: str, token: str) -> str:
    return f"{kind}:{token.translate(LOWER) if kind in ('email', 'ip') else re.sub('[^0-9]', '', token)}"


def terms_of(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) of the words outside ``spans``."""
    covered = sorted((s, e) for _, s, e in spans)
    for m in WORD.finditer(text):
        word = m[0]
        term = word.strip(EDGES)
        if len(term) > 1:
            a = m.start() + word.index(term)
            b = a + len(term)
            if not _touches(covered, a, b):
                yield term.translate(LOWER), a, b


def beside(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, str, int, int]]:
    """(entity, term, start, end) of the words in one text with each span."""
    return [(_value(kind, text[s:e]), *t) for kind, s, e in spans for t in terms_of(text, spans)]


def _touches(covered: list[tuple[int, int]], a: int, b: int) -> bool:
    from bisect import bisect_left

    i = bisect_left(covered, (b, 0))
    return any(e > a for _, e in covered[max(0, i - 4):i])


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
PLACE = pa.struct([("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
SCAN = pa.schema([("text_key", pa.int64()), ("entities", pa.list_(pa.string())), ("terms", pa.list_(pa.string()))])
MARKED = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("spans", pa.list_(SPAN)), ("places", pa.list_(PLACE))])


def scan(docs: DataFrame) -> DataFrame:
    """``text_key, entities, terms``, one row per row; the distinct terms of texts that hold an entity."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = part.column(1).to_pylist()
                found = [entities(t) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    pa.array([sorted({_value(k, t[a:b]) for k, a, b in s}) for t, s in zip(texts, found, strict=True)], SCAN.field("entities").type),
                    pa.array([sorted({x for x, *_ in terms_of(t, s)}) if s else [] for t, s in zip(texts, found, strict=True)],
                             SCAN.field("terms").type)], schema=SCAN)

    return docs.select(F.xxhash64(text_of()), text_of()).mapInArrow(read, "text_key long, entities array<string>, terms array<string>")


def checksums(terms: DataFrame) -> bytes:
    """Bit h is set if a row of the column ``term`` has crc32 mod ``BITS`` h."""
    h = F.crc32(F.col("term").cast("binary")) % BITS
    sums = (terms.select(h.alias("h")).groupBy(F.shiftright("h", 6).alias("at"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(h & 63 AS int)))").alias("bits")).toPandas())
    out = np.zeros(BITS // 64, dtype="<i8")
    out[sums["at"].to_numpy(dtype=np.int64)] = sums["bits"].to_numpy(dtype=np.int64)
    return out.tobytes()


def _among(bits: bytes, term: bytes) -> int:
    h = zlib.crc32(term) % (8 * len(bits))
    return bits[h >> 3] >> (h & 7) & 1


def mark(docs: DataFrame, bits: bytes) -> DataFrame:
    """``doc_id, text_key, spans, places``, one row per row; every place of the terms that ``bits`` may hold."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = EDGES.encode()

        def places(text: str, raw: bytes, spans: list[tuple[str, int, int]]) -> list[dict]:
            cores = {w.strip(edges) for w in set(raw.translate(LOWER_BYTES).split())}
            wanted = {w.decode() for w in cores if _among(bits, w)}
            return [{"term": t, "start": a, "end": b} for t, a, b in terms_of(text, spans) if t in wanted] if wanted else []

        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = part.column(2).to_pylist()
                raws = part.column(2).cast(pa.binary()).to_pylist()
                found = [entities(t) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1),
                    pa.array([[dict(zip(("kind", "start", "end"), x, strict=True)) for x in s] for s in found], MARKED.field("spans").type),
                    pa.array([places(*x) for x in zip(texts, raws, found, strict=True)], MARKED.field("places").type)], schema=MARKED)

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text_of()), text_of()).mapInArrow(
        read, "doc_id long, text_key long, spans array<struct<kind:string,start:int,end:int>>, "
              "places array<struct<term:string,start:int,end:int>>")


def document_counts(docs: DataFrame) -> DataFrame:
    """``term, docs``: in how many rows of ``docs`` each term occurs."""
    schema = pa.schema([("term", pa.string()), ("docs", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = EDGES.encode()
        found: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()).cast(pa.string()),
                                              pa.array(found.values(), pa.int64())], schema=schema)
            found.clear()
            return out

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for text in batch.column(0).slice(start, 256).cast(pa.binary()).to_pylist():
                    found.update({w.strip(edges) for w in set(text.translate(LOWER_BYTES).split())})
                    if len(found) > FLUSH:
                        yield flush()
        if found:
            yield flush()

    return docs.select(text_of()).mapInArrow(count, "term string, docs long").groupBy("term").agg(F.sum("docs").alias("docs"))


def _together(rows: DataFrame, name: str, label: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` (text_key, copies, ``name``, numbers of the name) with names that stand in the same texts as one.

    Returns the written names (``name``, ``label``: the least of those that stand together) and the rows by label.
    """
    own = [c for c in rows.columns if c not in ("text_key", "copies", name)]
    rows = materialise(rows, f"pii-{label}-rows")
    first, second = F.bit_xor(F.xxhash64("text_key", F.lit(1))), F.bit_xor(F.xxhash64("text_key", F.lit(2)))
    sets = rows.groupBy(name, *own).agg(first.alias("s1"), second.alias("s2"), F.count("*").alias("texts"))
    key = ["s1", "s2", "texts", *own]
    sets = materialise(sets, f"pii-{label}-sets")
    least = sets.groupBy(*key).agg(F.min(name).alias(label))
    names = materialise(sets.join(least, key).select(name, label, *own), f"pii-{label}-names")
    return names, rows.join(names.filter(F.col(name) == F.col(label)).select(name), name, "left_semi").withColumnRenamed(name, label)


def _revealing(scanned: DataFrame, docs: DataFrame, threshold: float, support: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The revealing pairs by label (``one``, ``other``), the entities of each ``one`` and the terms of each ``other``."""
    total = float(max(1, scanned.count()))
    most = F.lit(total) ** (1 - threshold) * F.col("entity_docs") ** threshold * (1 + 1e-9)
    owners = materialise(scanned.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("entity_docs"))
                         .filter((F.col("entity_docs") >= support) & (F.col("entity_docs") < total)).withColumn("most", most), "pii-owners")
    widest = owners.agg(F.max("most")).first()[0] or 0.0
    counts = materialise(document_counts(docs).filter(F.col("docs").between(support, widest))
                         .withColumnRenamed("docs", "term_docs"), "pii-counts")
    bits = checksums(counts)

    def rarer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([bool(_among(bits, t)) for t in batch.column(1).cast(pa.binary()).to_pylist()], pa.bool_()))

    copies = F.count("*").alias("copies")
    holders = (scanned.select("text_key", F.explode("entities").alias("entity")).groupBy("text_key", "entity").agg(copies)
               .join(owners, "entity").select("text_key", "copies", "entity", "entity_docs", "most"))
    entity_names, holders = _together(holders, "entity", "one")
    terms = (scanned.select("text_key", F.explode("terms").alias("term")).mapInArrow(rarer, "text_key long, term string")
             .groupBy("text_key", "term").agg(copies).join(holders.select("text_key").distinct(), "text_key", "left_semi")
             .join(counts, "term").select("text_key", "copies", "term", "term_docs"))
    term_names, terms = _together(terms, "term", "other")
    pairs = (holders.join(terms.drop("copies"), "text_key").filter(F.col("term_docs") <= F.col("most"))
             .groupBy("one", "other", "entity_docs", "term_docs").agg(F.sum("copies").alias("together"))
             .filter(F.col("together") >= support))
    pmi = F.log2(F.col("together") * total / (F.col("entity_docs") * F.col("term_docs")))
    information = F.log2(total / F.col("entity_docs"))
    found = (pairs.withColumn("pmi", pmi).withColumn("information", information)
             .filter((F.col("information") > 0) & (F.col("pmi") >= F.lit(threshold) * F.col("information"))))
    return found, entity_names.select("entity", "one"), term_names.select("term", "other")


def revealing(scanned: DataFrame, docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """``entity, term, together, entity_docs, term_docs, pmi, information`` of the pairs that reveal."""
    found, entity_names, term_names = _revealing(scanned, docs, threshold, support)
    return (found.join(entity_names, "one").join(term_names, "other")
            .select("entity", "term", "together", "entity_docs", "term_docs", "pmi", "information"))


def find_private(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """``doc_id, text_key, spans``: base spans by kind as listed, then start; then terms by start."""
    found, _, names = _revealing(materialise(scan(docs), "pii-scan"), docs, threshold, support)
    telling = materialise(found.select("other").distinct().join(names, "other").select("term"), "pii-revealing")
    marked = materialise(mark(docs, checksums(telling)).withColumn("rid", F.monotonically_increasing_id()), "pii-marked")
    place = marked.select("rid", F.explode("places").alias("p")).select("rid", "p.term", "p.start", "p.end")
    terms = (place.join(telling, "term").groupBy("rid")
             .agg(F.array_sort(F.collect_list(F.struct(F.col("start").alias("start"), F.col("end").alias("end")))).alias("terms")))
    more = F.transform(F.coalesce("terms", F.array().cast("array<struct<start:int,end:int>>")),
                       lambda t: F.struct(F.lit(METHOD_KIND).alias("kind"), t["start"].alias("start"), t["end"].alias("end")))
    return marked.join(terms, "rid", "left").select("doc_id", "text_key", F.concat("spans", more).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def clean(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with entities replaced by their kind and terms generalised or removed."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s < at:
            at = max(at, e)
            continue
        token = text[s:e]
        shape = re.sub("[0-9]", "0", token) if re.search("[0-9]", token) else "[removed]"
        out += [text[at:s], shape if kind == METHOD_KIND else f"[{kind}]"]
        at = e
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with ``text`` sanitised, all other columns as they were."""
    key, row, own, spans = fresh(docs, "pii_key", "pii_id", "pii_own", "pii_spans")
    found = (find_private(docs, **options).filter(F.size("spans") > 0).dropDuplicates(["doc_id", "text_key"])
             .select(F.col("doc_id").alias(row), F.col("text_key").alias(own), F.col("spans").alias(spans)))
    cleaner = F.udf(lambda t, s: clean(t, [(x["kind"], x["start"], x["end"]) for x in s]) if s else t, "string", useArrow=True)
    marked = docs.withColumn(key, F.xxhash64(text_of()))
    both = marked.join(found, (marked[key] == found[own]) & marked["doc_id"].cast("long").eqNullSafe(found[row]), "left")
    return both.withColumn("text", cleaner("text", spans)).select(*docs.columns)
