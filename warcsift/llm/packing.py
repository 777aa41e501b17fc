"""Operator 9: best-fit packing by minimum bin slack.

1. ``pieces``: documents are tokenised where they lie (Arrow batches); a
   document longer than ``seq_len`` is cut into full pieces, the first of them
   shorter. Only piece lengths and checksums leave the scan (token ids too, if
   asked for).
2. ``pack``: pieces are dealt by hash over pools of about ``POOL`` pieces; in a
   pool, each bin starts from the longest piece left, and a bitset subset-sum
   dynamic programme over the lengths still available finds the fullest
   feasible combination for the rest, which is then removed. A pool loses at
   most part of its last bin, whatever the total, and no key of the data
   decides a pool, so no group of copies gathers in one.

Defined results: null and empty texts are one end token; repeated rows and
ties are packed each on its own; very long texts are cut; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

SEQ_LEN, POOL, END_ID = 2048, 20_000, 0
CACHE = 400_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class _Seen(dict):
    """Ids by chunk in two generations: what is still in use outlives a clean-up."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.old = limit, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self[chunk] = self.old[chunk]
        return ids

    def turn(self) -> None:
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()


class Encoder:
    """Text to little-endian uint32 token ids, through a bounded cache.

    A byte-level BPE of this family splits a text before every space that does
    not lie inside a run of white space, so a text is the sum of its space-led
    chunks. Their ids are looked up; chunks not yet seen are encoded as one
    text, whose space-led tokens tell where each chunk begins. A mark of ``MARKS``
    after an ASCII letter or digit at a chunk's end is a token run of its own, so
    such a chunk is the sum of its stem and the mark. Likewise a line break between
    other characters stands alone, and what follows it starts anew (kept in the cache
    with a space behind, which no chunk has). A text with a
    space between (or after, at its end) other white space is encoded whole, and
    so is one that holds an added token's literal (``<|endoftext|>``): that is the
    token, as by the library's default, or with ``literal`` plain text.
    """

    INSIDE = re.compile(r" (?!\S)(?<=\s )")
    MARKS = frozenset(".,;:!?")

    def __init__(self, path: str, limit: int = CACHE, literal: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)").search
        self.seen = _Seen(limit)
        size = self.tokenizer.get_vocab_size()
        self.marks = dict(zip(sorted(self.MARKS), self.whole(sorted(self.MARKS)), strict=True))
        self.newline = self.whole(["\n"])[0]
        self.led = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(size)])

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def lines(self, chunk: str) -> list[str] | None:
        """The parts between single line breaks, or none if other white space is in it."""
        parts = chunk.split("\n")
        return parts if len(self.newline) == 4 and all(p.split() == [p] for p in parts) else None

    def learn(self, chunks: set[str]) -> None:
        """Put the ids of `` `` + each chunk into the cache; a chunk with a space behind starts a line."""
        seen, old = self.seen, self.seen.old
        broken = {c: parts for c in chunks if "\n" in c and (parts := self.lines(c))}
        if broken:
            chunks = chunks.difference(broken).union(p[0] for p in broken.values())
            chunks.update(p + " " for parts in broken.values() for p in parts[1:])
        marked = [c for c in chunks if c[-1:] in self.marks and c[-2:-1].isascii() and c[-2:-1].isalnum()]
        if marked:
            chunks = chunks.difference(marked).union(c[:-1] for c in marked)
        new = [c for c in chunks if c not in seen and c not in old]
        self.encode([c for c in new if c[-1:] != " "])
        self.begin([c for c in new if c[-1:] == " "])
        seen.update((c, seen[c[:-1]] + self.marks[c[-1]]) for c in marked)
        seen.update((c, self.newline.join((seen[p[0]], *(seen[x + " "] for x in p[1:])))) for c, p in broken.items())

    def begin(self, starts: list[str]) -> None:
        if starts:
            ids = self.whole(["\n".join(c[:-1] for c in starts)])[0]
            at = (4 * np.flatnonzero(np.frombuffer(ids, dtype="<u4") == int.from_bytes(self.newline, "little"))).tolist()
            if len(at) == len(starts) - 1:
                self.seen.update((c, ids[a:b]) for c, a, b in zip(starts, [0, *(x + 4 for x in at)], [*at, len(ids)], strict=True))
            else:
                self.seen.update(zip(starts, self.whole([c[:-1] for c in starts]), strict=True))

    def encode(self, chunks: list[str]) -> None:
        plain = [c for c in chunks if c and not c[0].isspace() and not c[-1].isspace()]
        rest = [c for c in chunks if not c or c[0].isspace() or c[-1].isspace()]
        if plain:
            ids = self.whole([" " + " ".join(plain)])[0]
            starts = (4 * np.flatnonzero(self.led[np.frombuffer(ids, dtype="<u4")])).tolist()
            if len(starts) == len(plain):
                self.seen.update((c, ids[a:b]) for c, a, b in zip(plain, starts, [*starts[1:], len(ids)], strict=True))
            else:
                rest = chunks
        if rest:
            self.seen.update(zip(rest, self.whole([" " + c for c in rest]), strict=True))

    def __call__(self, text: str) -> bytes:
        if self.INSIDE.search(text) or self.added(text):
            return self.whole([text])[0]
        first, *rest = text.split(" ")
        seen = self.seen
        found = list(map(seen.get, rest))
        parts = self.lines(first) if first else None
        if parts:
            rest += [p + " " for p in parts]
            found += map(seen.get, rest[-len(parts):])
        if None in found:
            at = [i for i, ids in enumerate(found) if ids is None]
            missing = {rest[i] for i in at}
            new = missing.difference(seen.old)
            if new:
                self.learn(new)
            for i in at:
                found[i] = seen[rest[i]]
        seen.turn()
        if parts:
            head = self.newline.join(found[-len(parts):])
            del found[-len(parts):]
        else:
            head = self.whole([first])[0] if first else b""
        return head + b"".join(found)


@cache
def encoder(path: str) -> Encoder:
    """One per Python worker, kept from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
    return Encoder(path, literal=False)


def cut(n: int, seq_len: int) -> Iterator[tuple[int, int]]:
    """(start, length) of each piece of ``n`` tokens: the first may be shorter."""
    first = n % seq_len or min(n, seq_len)
    yield 0, first
    for start in range(first, n, seq_len):
        yield start, seq_len


def pieces(docs: DataFrame, tokenizer: str, seq_len: int = SEQ_LEN, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``), one row per piece.

    ``tokenizer``: path of a tokenizer file that every executor can read.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer)
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = ids_of(text or "") + end
                for i, (start, length) in enumerate(cut(len(ids) // 4, seq_len)):
                    part = ids[4 * start:4 * (start + length)]
                    rows.append((key, i, start, length, zlib.crc32(part), *([part] * with_ids)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), *([("ids", pa.binary())] * with_ids)])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        encode, PIECES + (", ids binary" if with_ids else ""))


def fill(available: dict[int, int], slack: int) -> list[int]:
    """Lengths of the fullest combination within ``slack`` (each at most as often as available).

    Bit i of ``reach[j]`` says that the first j lengths can sum to i; lengths
    are taken from the longest down, and the search stops at an exact fill.
    """
    lengths = [x for x in sorted(available, reverse=True) if x <= slack and available[x]]
    whole = (1 << (slack + 1)) - 1
    reach = [1]
    for x in lengths:
        bits = reach[-1]
        for _ in range(min(available[x], slack // x)):
            grown = (bits | (bits << x)) & whole
            if grown == bits:
                break
            bits = grown
        reach.append(bits)
        if bits >> slack & 1:
            break
    at, chosen = reach[-1].bit_length() - 1, []
    for j in range(len(reach) - 1, 0, -1):
        x = lengths[j - 1]
        while at and not reach[j - 1] >> at & 1:
            chosen.append(x)
            at -= x
    return chosen


def min_slack_bins(lengths: np.ndarray, seq_len: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each length, by minimum bin slack."""
    rows: dict[int, list[int]] = defaultdict(list)
    for i in np.argsort(lengths, kind="stable")[::-1].tolist():
        rows[int(lengths[i])].append(i)
    available = {x: len(r) for x, r in rows.items()}
    order = sorted(available, reverse=True)
    bins = np.zeros(len(lengths), dtype=np.int64)
    offsets = np.zeros(len(lengths), dtype=np.int64)
    number = 0
    for longest in order:
        while available.get(longest):
            available[longest] -= 1
            chosen = [longest, *fill(available, seq_len - longest)]
            for x in chosen[1:]:
                available[x] -= 1
            # the same combination again while every length in it lasts
            need = {x: chosen.count(x) for x in set(chosen)}
            again = 1 + min(available[x] // n for x, n in need.items())
            for x, n in need.items():
                available[x] -= n * (again - 1)
            for _ in range(again):
                at = 0
                for x in chosen:
                    row = rows[x].pop()
                    bins[row], offsets[row] = number, at
                    at += x
                number += 1
            for x in need:
                if not available[x]:
                    del available[x]
    return bins, offsets


def pack(cut_pieces: DataFrame, seq_len: int = SEQ_LEN, pool: int = POOL) -> DataFrame:
    """``cut_pieces`` with ``sequence_id`` and ``offset``.

    ``cut_pieces`` is read twice (its number of rows gives the number of
    pools), so pass a written table.
    """
    pools = max(1, round(cut_pieces.count() / pool))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut_pieces.schema.fields) + ", sequence_id long, offset long"

    def place(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("doc_id", "piece", "start", "ids_crc32")])
        bins, offsets = min_slack_bins(rows["length"].to_numpy(), seq_len)
        numbers = bins + (rows["pool"][0].as_py() << 40)
        return (rows.drop_columns(["pool"]).append_column("sequence_id", pa.array(numbers))
                .append_column("offset", pa.array(offsets)))

    dealt = cut_pieces.withColumn("pool", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(pools)))
    return dealt.groupBy("pool").applyInArrow(place, schema)


def best_fit_pack(docs: DataFrame, tokenizer: str, seq_len: int = SEQ_LEN, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most ``seq_len`` tokens."""
    return pack(materialise(pieces(docs, tokenizer, seq_len, with_ids=with_ids), "pieces"), seq_len)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, length, ids`` (little-endian uint32) of pieces packed ``with_ids``."""
    rows = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    return (packed.groupBy("sequence_id").agg(rows.alias("rows"))
            .select("sequence_id", F.aggregate("rows", F.lit(0).cast("long"), lambda a, r: a + r["length"]).alias("length"),
                    F.aggregate("rows", F.lit(b""), lambda a, r: F.concat(a, r["ids"])).alias("ids")))
