"""Operator 10: scoring by a Brown class-based bigram model.

1. ``word_counts``: counts of every training token (words and the end token),
   counted per task, summed by word: exact, and as large as the vocabulary.
2. Exchange clustering puts the ``CLUSTERED`` most frequent words (the core)
   into ``CLASSES`` classes by the likelihood of their class bigrams. Every
   other training word is then placed by the same gain, from the counts of the
   core's classes before and after it (``contexts``, counted by task, then summed
   by word; ``place``). The end token has a class of its own, and words never
   seen in training are the open class. ``placed`` (word, n, cls) is written.
3. Class bigrams are counted over all training tokens, each in its class.
4. Scoring: log10 P(class | class before) + log10 P(word | class) per token.
   Counts and classes of the ``KNOWN`` most frequent words travel with the tasks
   (a fixed bound); those of all other words come by a join on the word, in
   step 3 by bigram and here by place in the document.

Smoothing: transitions are pulled towards class frequencies with weight
``PULL``; the open class has one count of all after any class, so every text
has a finite score.

Defined results: null and empty texts are one end token; a null doc_id counts
as the text ''; repeated rows are scored each on its own; with no training
document every count is 0; an empty table gives an empty result; other
columns are not read. Texts are read whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, most_frequent

CLUSTERED, CLASSES, SWEEPS, KNOWN, PULL = 600, 32, 5, 200_000, 10.0
END = b"\n"  # no word can be this
FLUSH, SEEN, EVENTS, SLICES = 500_000, 100_000, 6_000_000, 1024
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def remainder(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def tokens(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: A-Z lower-cased, split at ASCII white space."""
    return text.translate(LOWER).split() if text else []


def _texts(batch: pa.RecordBatch, column: int = 0) -> Iterator[bytes | None]:
    for start in range(0, batch.num_rows, 256):
        yield from batch.column(column).slice(start, 256).cast(pa.binary()).to_pylist()


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n`` of every token of the column ``text``, end tokens included."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], schema=schema)
            found.clear()
            return out

        for batch in batches:
            for text in _texts(batch):
                found.update(tokens(text))
                found[END] += 1
                if len(found) > FLUSH:
                    yield flush()
        if found:
            yield flush()

    return texts.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def bigram_counts(texts: DataFrame, frequent: list[bytes]) -> np.ndarray:
    """Counts of neighbouring tokens among ``frequent``, other words, and the end token."""
    size = len(frequent) + 2
    other, end = size - 2, size - 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: i for i, w in enumerate(frequent)} | {END: end}
        cells = np.zeros(size * size, dtype=np.int64)
        for batch in batches:
            for ids in _ids(batch, 0, number, other):
                cells += np.bincount(np.concatenate(([end], ids[:-1])) * size + ids, minlength=size * size)
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(cells[at])], names=["cell", "n"])

    sums = texts.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size * size, dtype=np.int64)
    out[sums["cell"].to_numpy()] = sums["n"].to_numpy()
    return out.reshape(size, size)


def _flat(batch: pa.RecordBatch, column: int) -> Iterator[list[bytes]]:
    """About 400,000 tokens at a time, whole documents each."""
    flat: list[bytes] = []
    for text in _texts(batch, column):
        flat += tokens(text)
        flat.append(END)
        if len(flat) > 400_000:
            yield flat
            flat = []
    if flat:
        yield flat


def _ids(batch: pa.RecordBatch, column: int, number: dict[bytes, int], other: int) -> Iterator[np.ndarray]:
    """Token numbers, whole documents each."""
    for flat in _flat(batch, column):
        yield np.fromiter(map(number.get, flat, repeat(other)), dtype=np.int64, count=len(flat))


def _numbered(known: bytes) -> dict[bytes, int]:
    """Numbers of the known words (joined by spaces), then of the end token."""
    return {w: i for i, w in enumerate(known.split())} | {END: len(known.split())}


class _Numbers(dict):
    """Numbers of words, given as they come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _local(flat: list[bytes], at: np.ndarray, local: _Numbers) -> np.ndarray:
    """Task's own numbers of the words at ``at``."""
    return np.fromiter(map(local.__getitem__, map(flat.__getitem__, at.tolist())), dtype=np.int64, count=len(at))


def _sliced(names: list[bytes], keys: list[np.ndarray], size: int) -> pa.RecordBatch:
    """A row per name: which keys of its slice (``size`` numbers each) occur, and how often."""
    found, n = np.unique(np.concatenate(keys), return_counts=True)
    cuts = 4 * np.searchsorted(found, np.arange(len(names) + 1) * size)
    binary = lambda x: pa.Array.from_buffers(pa.binary(), len(names), [None, pa.py_buffer(cuts.astype("<i4")), pa.py_buffer(x.astype("<i4"))])
    return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), binary(found % size), binary(n)], names=["word", "at", "n"])


def contexts(texts: DataFrame, known: list[bytes], core: int, cls: np.ndarray) -> DataFrame:
    """``word, at, n``: how often each class stands before the word, or (from ``len(classes)`` on) after it;
    little-endian int32, a row per task and word outside ``known``.

    Known words beyond the first ``core`` have fixed numbers, and go in ``SLICES`` rows a task named
    `` 0``, `` 1``, ... (no word holds a space), a frequent word's contexts thus at most once a task.
    """
    other, total = int(cls[-2]), int(cls[-1]) + 1
    missing, width, per = len(known) + 1, 2 * total, -(-len(known) // SLICES)
    spelled = b" ".join(known)
    stands = np.concatenate((cls[:core], np.full(len(known) - core, other), cls[-1:], cls[-2:-1])).astype(np.int32)
    # keys of 4 bytes: some 100,000 known words, or words a task has numbered, times some 10 contexts
    number_ = np.arange(len(known))
    first = ((number_ % SLICES * per + number_ // SLICES) * width).astype(np.int32)
    end = slice(len(known), len(known) + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, local = _numbered(spelled), _Numbers()
        fixed, own, held = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if fixed and known:
                yield _sliced([b" %d" % i for i in range(SLICES)], fixed, per * width)
            if local:
                yield _sliced(list(local), own, width)
            fixed.clear(), own.clear(), local.clear()

        for batch in batches:
            for flat in _flat(batch, 0):
                ids = np.fromiter(map(number.get, flat, repeat(missing)), dtype=np.int64, count=len(flat))
                now = stands[ids]
                before, after = np.concatenate((stands[end], now[:-1])), total + np.concatenate((now[1:], stands[end]))
                at = np.flatnonzero((ids >= core) & (ids < len(known)))
                fixed += [first[ids[at]] + before[at], first[ids[at]] + after[at]]
                at = np.flatnonzero(ids == missing)
                row = _local(flat, at, local).astype(np.int32) * np.int32(width)
                own += [row + before[at], row + after[at]]
                held += 2 * len(flat)
                if held > EVENTS or len(local) > FLUSH:
                    yield from flush()
                    held = 0
        yield from flush()

    return texts.select("text").mapInArrow(count, "word binary, at binary, n binary")


def place(g: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The class (never the last two) that gains most likelihood from each word of the open class.

    ``g``: class bigrams; ``before``, ``after``: words x classes.
    """
    classes = len(g) - 2
    rest = np.repeat(g[None].astype(float), len(before), axis=0)
    rest[:, :, classes] -= before
    rest[:, classes, :] -= after
    rest = np.maximum(rest, 0)
    own = np.arange(classes)
    diagonal, r, c = rest[:, own, own], after[:, own], before[:, own]
    # only the cells of classes that stand beside a word change; a rare word has few
    rows, columns = np.zeros((len(before), classes, len(g))), np.zeros((len(before), len(g), classes))
    w, k = np.nonzero(after)
    cells = rest[w, :classes, k]
    rows[w, :, k] = _h(cells + after[w, k, None]) - _h(cells)
    w, k = np.nonzero(before)
    cells = rest[w, k, :classes]
    columns[w, k] = _h(cells + before[w, k, None]) - _h(cells)
    gain = rows.sum(axis=2) + columns.sum(axis=1)
    gain += _h(diagonal + r + c) + _h(diagonal) - _h(diagonal + r) - _h(diagonal + c)
    for margin, add in ((rest.sum(axis=2)[:, :classes] + c, after.sum(axis=1)), (rest.sum(axis=1)[:, :classes] + r, before.sum(axis=1))):
        gain -= _h(margin + add[:, None]) - _h(margin)
    return gain.argmax(axis=1)


def _placed(words: DataFrame, found: DataFrame, known: list[bytes], core: int, cls: np.ndarray, g: np.ndarray) -> DataFrame:
    """``word, n, cls`` of every row of ``words`` (word, n); ``found``: rows of ``contexts``.

    Rows of one word stand together in a sorted partition and are summed as they
    come; a task holds one batch, or one slice of the known words, at a time.
    """
    total = len(g)
    width, per = 2 * total, -(-len(known) // SLICES)
    spelled = b" ".join(known)
    schema = pa.schema([("word", pa.binary()), ("cls", pa.int32())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}  # rare words with equal contexts go to one class
        names: list[bytes] = []

        def chosen(spelt: list[bytes], table: np.ndarray) -> Iterator[pa.RecordBatch]:
            for start in range(0, len(spelt), 128):
                rows = table[start:start + 128]
                keys = [r.tobytes() for r in rows]
                if len(seen) > SEEN:
                    seen.clear()
                first = {k: i for i, k in enumerate(keys) if k not in seen}
                if first:
                    new = rows[list(first.values())]
                    seen.update(zip(first, place(g, new[:, :total], new[:, total:]).tolist(), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(spelt[start:start + 128], pa.binary()), pa.array([seen[k] for k in keys], pa.int32())], schema=schema)

        def ended(word: bytes | None, cells: np.ndarray) -> Iterator[pa.RecordBatch]:
            if word is None:
                return
            if word[:1] != b" ":
                yield from chosen([word], cells.reshape(1, width))
                return
            names[:] = names or spelled.split()
            part, table = int(word), cells.reshape(per, width)
            rows = [r for r in range(per) if core <= r * SLICES + part < len(names)]
            yield from chosen([names[r * SLICES + part] for r in rows], table[rows])

        word, cells = None, np.zeros(0)
        for batch in batches:
            spelt = batch.column(0).to_pylist()
            at, n = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype="<i4") for i in (1, 2))
            ends = np.cumsum([0, *(len(x) // 4 for x in batch.column(1).to_pylist())])
            i = 0
            while i < len(spelt):  # the rows of the word at hand, or of a slice
                if spelt[i] == word:
                    cells += np.bincount(at[ends[i]:ends[i + 1]], n[ends[i]:ends[i + 1]], len(cells))
                    i += 1
                    continue
                yield from ended(word, cells)
                if spelt[i][:1] == b" ":
                    word, cells = spelt[i], np.zeros(per * width)
                    continue
                # all words that begin in this batch at once; the last may go on in the next
                fresh_ = np.array([a != b for a, b in zip(spelt[i:], [None, *spelt[i:-1]], strict=True)])
                row = np.repeat(np.cumsum(fresh_) - 1, np.diff(ends[i:]))
                unlike = [spelt[i + j] for j in np.flatnonzero(fresh_).tolist()]
                table = np.bincount(row * width + at[ends[i]:], n[ends[i]:], len(unlike) * width).reshape(-1, width)
                yield from chosen(unlike[:-1], table[:-1])
                word, cells = unlike[-1], table[-1].copy()
                break
        yield from ended(word, cells)

    spark = words.sparkSession
    rest = found.repartition("word").sortWithinPartitions("word").mapInArrow(judge, "word binary, cls int")
    first = spark.createDataFrame([(bytearray(w), int(k)) for w, k in zip(known[:core], cls, strict=False)], "word binary, cls int")
    return words.join(rest.unionByName(first), "word")


def class_bigrams(texts: DataFrame, placed: DataFrame, known: list[bytes], known_class: np.ndarray, total: int) -> np.ndarray:
    """Counts of neighbouring tokens by class, each token in its own."""
    spelled, missing = b" ".join(known), len(known) + 1
    class_of = np.concatenate((known_class, [total - 1, 0]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, local = _numbered(spelled), _Numbers()
        cells, rare, held = np.zeros(total * total, dtype=np.int64), [], 0

        def rows(first: np.ndarray, second: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            """Of tokens numbered by class, or from ``total`` on by the task."""
            names, columns = pa.array(list(local), pa.binary()), []
            for x in (first, second):
                columns.append(names.take(pa.array(x - total, mask=x < total)))
                columns.append(pa.array(np.minimum(x, total).astype(np.int32)))
            return pa.RecordBatch.from_arrays([*columns, pa.array(n)], names=["w1", "c1", "w2", "c2", "n"])

        def flush() -> Iterator[pa.RecordBatch]:
            if rare:
                keys, n = np.unique(np.concatenate(rare), return_counts=True)
                yield rows(keys >> 32, keys & 0xFFFFFFFF, n)
            rare.clear(), local.clear()

        for batch in batches:
            for flat in _flat(batch, 0):
                ids = np.fromiter(map(number.get, flat, repeat(missing)), dtype=np.int64, count=len(flat))
                at = np.flatnonzero(ids == missing)
                token = class_of[ids]
                token[at] = total + _local(flat, at, local)
                before = np.concatenate(([total - 1], token[:-1]))
                both = (token < total) & (before < total)
                cells += np.bincount(before[both] * total + token[both], minlength=total * total)
                rare.append(before[~both] << 32 | token[~both])
                held += len(rare[-1])
                if held > EVENTS or len(local) > FLUSH:
                    yield from flush()
                    held = 0
        yield from flush()
        at = np.flatnonzero(cells)
        yield rows(at // total, at % total, cells[at])

    rows = materialise(texts.select("text").mapInArrow(count, "w1 binary, c1 int, w2 binary, c2 int, n long"), "lm-bigrams")
    for w, c in (("w1", "c1"), ("w2", "c2")):
        own = placed.select(F.col("word").alias(w), F.col("cls").alias(c))
        met = rows.filter(F.col(w).isNotNull()).groupBy("w1", "c1", "w2", "c2").agg(F.sum("n").alias("n")).drop(c).join(own, w)
        rows = rows.filter(F.col(w).isNull()).unionByName(met.withColumn(w, F.lit(None).cast("binary")))
    out = np.zeros((total, total), dtype=np.int64)
    for r in rows.groupBy("c1", "c2").agg(F.sum("n").alias("n")).collect():  # classes x classes
        out[r["c1"], r["c2"]] = r["n"]
    return out


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each row of ``bigrams``; the last two rows keep classes of their own.

    Every word in turn moves to the class that raises the class-bigram
    likelihood most; it stops when a sweep moves none.
    """
    b = bigrams.astype(float)
    movable = len(b) - 2
    total = classes + 2
    cls = np.concatenate((np.arange(movable) % classes, [classes, classes + 1]))
    z = np.eye(total)[cls]
    right, left = b @ z, b.T @ z              # by word: counts towards and from each class
    g = z.T @ right
    for _ in range(sweeps):
        moved = 0
        for w in range(movable):
            a, s = cls[w], b[w, w]
            r, c = right[w].copy(), left[w].copy()
            r[a] -= s
            c[a] -= s
            g[a, :] -= r
            g[:, a] -= c
            g[a, a] -= s
            own = np.arange(classes)
            diagonal = g[own, own]
            gain = (_h(g[:classes] + r) - _h(g[:classes])).sum(axis=1) + (_h(g[:, :classes] + c[:, None]) - _h(g[:, :classes])).sum(axis=0)
            gain -= _h(diagonal + r[own]) + _h(diagonal + c[own]) - 2 * _h(diagonal)
            gain += _h(diagonal + r[own] + c[own] + s) - _h(diagonal)
            for margin, add in (((g.sum(axis=1) + c)[:classes], r.sum() + s), ((g.sum(axis=0) + r)[:classes], c.sum() + s)):
                gain -= _h(margin + add) - _h(margin)
            best = int(np.argmax(gain))
            if gain[best] <= gain[a] + 1e-9:
                best = a
            g[best, :] += r
            g[:, best] += c
            g[best, best] += s
            if best != a:
                moved += 1
                cls[w] = best
                right[:, a] -= b[:, w]
                right[:, best] += b[:, w]
                left[:, a] -= b[w]
                left[:, best] += b[w]
        if not moved:
            break
    return cls


@dataclass
class ClassModel:
    counts: DataFrame            # word, n, cls: every training word, written
    known: list[bytes]           # the most frequent words, at most KNOWN
    known_counts: np.ndarray
    known_class: np.ndarray
    transition: np.ndarray       # log10, class before x class
    class_total: np.ndarray
    n: int
    v: int
    open_mass: int               # denominator of the open class


def train(texts: DataFrame, clustered: int = CLUSTERED, classes: int = CLASSES, known: int = KNOWN) -> ClassModel:
    """Learn from every row of ``texts`` (column ``text``)."""
    counts = materialise(word_counts(texts), "lm-counts")
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    words = counts.filter(F.col("word") != F.lit(END))
    top = sorted(most_frequent(words, known).collect(), key=lambda r: (-r["n"], bytes(r["word"])))
    spelled, n_of = [bytes(r["word"]) for r in top], np.array([r["n"] for r in top], dtype=np.int64)
    core = spelled[:clustered]
    bigrams = bigram_counts(texts, core)
    cls = exchange(bigrams, classes)
    z = np.eye(classes + 2)[cls]
    placed = materialise(_placed(words, contexts(texts, spelled, len(core), cls), spelled, len(core), cls, z.T @ bigrams @ z), "lm-placed")
    class_of = {bytes(r["word"]): r["cls"] for r in most_frequent(placed, known).select("word", "cls").toLocalIterator()}
    known_class = np.array([class_of[w] for w in spelled], dtype=np.int64)
    g = class_bigrams(texts, placed, spelled, known_class, classes + 2)
    class_total = g.sum(axis=0)
    share = (class_total + 1) / (class_total.sum() + len(class_total))
    unseen = share[classes]
    seen = share / (1 - unseen)
    chance = (1 - unseen) * (g + PULL * seen) / (g.sum(axis=1, keepdims=True) + PULL)
    chance[:, classes] = unseen
    return ClassModel(placed, spelled, n_of, known_class, np.log10(chance), class_total, int(total["n"] or 0),
                      int(total["v"]), int(class_total[classes]) + 1)


SCORED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()),
                    ("score", pa.float64()), ("classes", pa.binary()), ("words", pa.list_(pa.binary())), ("at", pa.list_(pa.int32()))])


def score(docs: DataFrame, model: ClassModel) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity``, one row per row."""
    m = model
    classes = len(m.class_total) - 2
    # by token number: the known words, then the end token, then any other word
    cls = np.concatenate((m.known_class, [classes + 1, classes]))
    grown = np.log10(np.concatenate((m.known_counts, [m.class_total[classes + 1], 0])) + 1.0)
    mass = np.log10(np.maximum(m.class_total, 1))
    emit = np.concatenate((np.log10(np.maximum(m.known_counts, 1)) - mass[m.known_class], [0.0, -np.log10(m.open_mass)]))
    transition, width = m.transition.ravel(), classes + 2
    base_mass, ends_known, known = float(np.log10(m.n + m.v + 1)), int(m.class_total[classes + 1] > 0), b" ".join(m.known)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: i for i, w in enumerate(known.split())}
        end, other = len(number), len(number) + 1
        number[END] = end
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                flat: list[bytes] = []
                stops = []
                for text in part.column(1).cast(pa.binary()).to_pylist():
                    flat += tokens(text)
                    flat.append(END)
                    stops.append(len(flat))
                ids = np.fromiter(map(number.get, flat, repeat(other)), dtype=np.int64, count=len(flat))
                starts = np.array([0, *stops[:-1]], dtype=np.int64)
                c = cls[ids].astype(np.uint8)
                lengths = np.diff(np.concatenate(([0], stops)))
                missing = ids == other
                found = np.add.reduceat(np.where(missing, 0, 1), starts) - (1 - ends_known)
                at = np.flatnonzero(missing)
                cuts = np.searchsorted(at, [0, *stops])
                words = pa.array([flat[i] for i in at.tolist()], pa.binary())
                place_ = pa.array((at - np.repeat(starts, np.diff(cuts))).astype(np.int32))
                cuts = pa.array(cuts.astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(lengths), pa.array(found),
                    pa.array(np.add.reduceat(grown[ids], starts) - lengths * base_mass),
                    pa.array(np.add.reduceat(emit[ids], starts)),
                    pa.array([c[a:b].tobytes() for a, b in zip(starts, stops, strict=True)], pa.binary()),
                    pa.ListArray.from_arrays(cuts, words), pa.ListArray.from_arrays(cuts, place_)], schema=SCORED)

    part = materialise(
        docs.select(F.col("doc_id").cast("long"), "text")
        .mapInArrow(judge, "doc_id long, n_tokens long, n_known long, base double, score double, classes binary, words array<binary>, at array<int>")
        .withColumn("rid", F.monotonically_increasing_id()), "lm-parts")
    asked = (part.select("rid", F.explode(F.arrays_zip("words", "at")).alias("w"))
             .select("rid", F.col("w.words").alias("word"), F.col("w.at").alias("at")))
    # a word without a count adds log10(0 + 1) = 0 to the base sum and stays in the open class, so the join is inner
    rest = (asked.join(model.counts, "word").groupBy("rid")
            .agg(F.sum(F.log10(F.col("n") + 1.0)).alias("logs"), F.sum(F.log10("n")).alias("spelt"),
                 F.collect_list("at").alias("at"), F.collect_list("cls").alias("cls")))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
        for batch in batches:
            known_, base, score_ = [], [], []
            for r in batch.to_pylist():
                c = np.frombuffer(r["classes"], dtype=np.uint8).astype(np.int64)
                own = np.array(r["cls"] or [], dtype=np.int64)
                c[np.array(r["at"] or [], dtype=np.int64)] = own
                steps = transition[np.concatenate(([classes + 1], c[:-1])) * width + c].sum()
                known_.append(r["n_known"] + len(own))
                base.append(r["base"] + (r["logs"] or 0.0))
                # as a member of the open class each such word counted -log10(open_mass)
                score_.append(r["score"] + steps + (r["spelt"] or 0.0) - mass[own].sum() - len(own) * emit[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(known_, pa.int64()), pa.array(base, pa.float64()),
                                              pa.array(score_, pa.float64())], schema=schema)

    walked = (part.drop("words", "at").join(rest, "rid", "left")
              .select("doc_id", "n_tokens", "n_known", "base", "score", "classes", "logs", "spelt", "at", "cls")
              .mapInArrow(walk, "doc_id long, n_tokens long, n_known long, base_score double, score double"))
    return walked.select(
        "doc_id", "n_tokens", "n_known", F.lit(m.n).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
