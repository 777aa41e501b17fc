"""Operator 11: SimHash near-dedup with pigeonring filtering.

A text's fingerprint has a bit set where over half of its word shingles'
64-bit hashes have it. Two texts link at ``DISTANCE`` or fewer differing bits.

1. Scan: one fingerprint a row; equal fingerprints are one node.
2. Ring: the 64 bits are four segments on a ring. If two fingerprints differ in
   at most 3 bits, some segment starts a chain whose first one, two and three
   segments differ in at most 0, 1 and 2 bits (their share of 3, rounded
   down). So every linked pair meets in a bucket of (start, segment value).
3. Buckets of up to ``BUCKET`` fingerprints are compared inside a task, in
   sorted runs: the chain's cumulative differences first, all 64 bits for what
   is left. Only a spanning forest of a bucket's links leaves the task.
4. Larger buckets (a group of near copies, or chance at corpus scale) link
   their members to the most frequent one, join components, and those that still
   hold several components are split by the chain's budgets: the second segment
   differs in at most one bit, so one of its halves is equal; the first two
   hold at most two, so one of three parts is; and so on. A bucket of a few free
   bits holds few fingerprints, so this ends, at a fixed number of rows per
   fingerprint and level, and no pair of different components is lost.

Defined results: a null or empty text has fingerprint 0, linked like any
other; a text of fewer than three words is one shingle; a null doc_id never
names a component unless all its ids are null; repeated rows share one node;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .jaccard_join import LOWER, components

SHINGLE, SEED, DISTANCE = 3, 42, 3
SEGMENTS, WIDTH = 4, 16
BUCKET = 1024
RUN_ROWS = 16_384  # rows compared at once; a bucket is never cut
HEX = "0123456789abcdef"


# --- fingerprints ----------------------------------------------------------------------------

def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """The unsigned fingerprint of a UTF-8 text."""
    words = text.translate(LOWER).split() if text else []
    if not words:
        return 0
    k = min(size, len(words))
    grams = map(b" ".join, zip(*(words[j:] for j in range(k)), strict=False))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(g, SEED) for g in grams], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(h), 1 << 16):
        part = h[start:start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, fp``: a row per row; ``fp`` holds the 64 bits as a signed long."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = part.column(1).cast(pa.binary()).to_pylist()
                fp = np.array([fingerprint(t, size) for t in texts], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(read, "doc_id long, fp long")


# --- pigeonring ------------------------------------------------------------------------------

def ring(start: int) -> list[int]:
    """Masks of the segments in ring order from ``start``."""
    one = (1 << WIDTH) - 1
    return [one << WIDTH * ((start + j) % SEGMENTS) for j in range(SEGMENTS)]


def budgets(distance: int = DISTANCE) -> list[int]:
    """How many bits the first 1, 2, ... segments of a chain may differ in."""
    return [distance * (j + 1) // SEGMENTS for j in range(SEGMENTS)]


def finer(start: int, mask: int, level: int) -> list[int]:
    """The masks that split a bucket (equal in ``mask``): pairs within the chain's
    budgets are equal in at least one of them."""
    chain = min(level, SEGMENTS - 1)
    region = sum(ring(start)[:chain + 1]) & ~mask
    free = [1 << b for b in range(64) if region >> b & 1]
    parts = min(budgets()[chain] + 1, len(free))
    cuts = [len(free) * j // parts for j in range(parts + 1)]
    return [mask | sum(free[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node connected to each of ``n`` nodes by the links a - b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label != label[label]).any():
            label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def linked_in_buckets(start: np.ndarray, bucket: np.ndarray, fp: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions, ends) that connect what links within the buckets of a
    run; rows of a bucket are adjacent, ``bucket`` numbers them from 0. Pairs
    of one group are connected already."""
    steps = np.array([[sum(ring(s)[:j + 1]) for j in (1, 2)] for s in range(SEGMENTS)], dtype=np.uint64)
    may = budgets()
    size = np.bincount(bucket)[bucket]
    at = np.arange(len(fp))
    alive, lag, ends = at, 1, []
    place = at - np.searchsorted(bucket, bucket)
    while True:
        alive = alive[place[alive] + lag < size[alive]]
        if not len(alive):
            break
        other = alive + lag
        apart = group[alive] != group[other]
        x, y = alive[apart], other[apart]
        differ = fp[x] ^ fp[y]
        for j in range(2):  # the chain's second and third segment
            near = np.bitwise_count(differ & steps[start[x], j]) <= may[j + 1]
            x, y, differ = x[near], y[near], differ[near]
        close = np.bitwise_count(differ) <= DISTANCE
        ends.append((x[close], y[close]))
        lag += 1
    if not ends:
        return at[:0], at[:0]
    label = _forest(len(fp), np.concatenate([e[0] for e in ends]), np.concatenate([e[1] for e in ends]))
    moved = np.flatnonzero(label != at)
    return moved, label[moved]


def _compare(rows: DataFrame) -> DataFrame:
    """``a, b``: links between groups, from whole buckets (``start, mask, key, fp, grp``)."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def links(table: np.ndarray) -> pa.RecordBatch:
            new = np.ones(len(table), dtype=bool)
            new[1:] = (table[1:, :3] != table[:-1, :3]).any(axis=1)
            group = table[:, 4]
            x, y = linked_in_buckets(table[:, 0], np.cumsum(new) - 1, table[:, 3].view(np.uint64), group)
            pairs = np.unique(np.stack([group[x], group[y]], axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1]))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.ascontiguousarray(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)))
            size += batch.num_rows
            if size >= RUN_ROWS:
                table = np.concatenate(held)
                last = np.flatnonzero((table[:, :3] != table[-1, :3]).any(axis=1))
                cut = last[-1] + 1 if len(last) else 0  # the last bucket may go on
                if cut:
                    yield links(table[:cut])
                held, size = [table[cut:]], len(table) - cut
        if size:
            yield links(np.concatenate(held))

    key = ["start", "mask", "key"]
    return (rows.select(*key, "fp", "grp").repartition(*key).sortWithinPartitions(*key)
            .mapInArrow(judge, "a long, b long"))


def _split(rows: DataFrame, level: int) -> DataFrame:
    """``start, mask, key, fp, weight, grp`` of the finer buckets of large ones."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, mask, fp, weight, group = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
            for s, m in np.unique(np.stack([start, mask], axis=1), axis=0).tolist():
                own = (start == s) & (mask == m)
                n = int(own.sum())
                for child in finer(s, m & (1 << 64) - 1, level):
                    c = np.full(n, _signed(child), dtype=np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (np.full(n, s), c, fp[own] & c, fp[own], weight[own], group[own])],
                        names=["start", "mask", "key", "fp", "weight", "grp"])

    return rows.select("start", "mask", "fp", "weight", "grp").mapInArrow(
        emit, "start long, mask long, key long, fp long, weight long, grp long")


def _near(a, b):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= DISTANCE


def groups(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``fp, label`` of the fingerprints (``nodes``: a written table ``fp, weight``)
    that link with another; equal labels are connected."""
    if bucket < 1 << DISTANCE:  # a larger bucket has more free bits than may differ
        raise ValueError(f"bucket must be at least {1 << DISTANCE}")
    key = ["start", "mask", "key"]
    first = F.array(*[F.struct(F.lit(s).cast("long").alias("start"), F.lit(_signed(ring(s)[0])).alias("mask")) for s in range(SEGMENTS)])
    rows = (nodes.select("fp", "weight", F.col("fp").alias("grp"), F.explode(first).alias("c"))
            .select("c.start", "c.mask", F.col("fp").bitwiseAND(F.col("c.mask")).alias("key"), "fp", "weight", "grp"))
    found, level = None, 0
    while True:
        level += 1
        several = (rows.groupBy(*key).agg(F.count("*").alias("members"), F.min("grp").alias("low"), F.max("grp").alias("high"))
                   .filter("low < high").select(*key, "members"))
        held = materialise(rows.join(materialise(several, "simhash-buckets"), key), "simhash-members")
        edges = _compare(held.filter(F.col("members") <= bucket))
        large = held.filter(F.col("members") > bucket)
        more = not large.isEmpty()
        if more:
            hub = large.groupBy(*key).agg(F.max(F.struct("weight", "fp", "grp")).alias("hub"))
            hub = hub.select(*key, F.col("hub.fp").alias("hub_fp"), F.col("hub.grp").alias("b"))
            stars = large.join(materialise(hub, "simhash-hubs"), key).filter(_near("fp", "hub_fp") & (F.col("grp") != F.col("b")))
            edges = edges.unionByName(stars.select(F.col("grp").alias("a"), "b"))
        edges = edges if found is None else found.unionByName(edges)
        if not more:
            return components(edges).withColumnRenamed("node", "fp")
        found = materialise(edges.distinct(), "simhash-links")
        label = components(found)
        named = large.join(label, large["grp"] == label["node"], "left").withColumn("grp", F.coalesce("label", "grp"))
        rows = materialise(_split(named, level), "simhash-split")


def simhash_groups(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """One row per row: ``doc_id, fingerprint`` (16 hex digits), ``component_id``."""
    scanned = materialise(fingerprints(docs.select("doc_id", "text")), "simhash-scan")
    nodes = materialise(scanned.groupBy("fp").agg(F.count("*").alias("weight"), F.min("doc_id").alias("least")), "simhash-nodes")
    label = groups(nodes.select("fp", "weight"), bucket)
    named = nodes.join(label, "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    whole = named.groupBy("label").agg(F.min("least").alias("component_id"))
    by_fp = materialise(named.join(whole, "label").select("fp", "component_id"), "simhash-components")
    return scanned.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
