"""Operator 13: source divergence audit with late string materialisation.

For every language, the terms in at least ``MIN_DOCS`` of its documents are
kept. A group is a language's source, or the language as a whole; a term's
smoothed share in a group is p = 1 + floor(1e9 (count + 5) / (N + 5 V)).

1. Scan: a task counts the terms of its documents per (lang, source) and writes
   (digest, lang, source, term, count, docs) to a table where it stands. The
   digest is 64 bits of language and term together.
2. Only digests and document counts are shuffled to find the digests that reach
   ``MIN_DOCS`` (a clash can only add documents, so none is lost).
3. Of those, the least and the greatest (language, term) of each digest show
   which digests stand for several terms; these are split by their strings and
   counted anew. All further work carries the digest and a number within it.
4. Counts per group and term, shares, the top terms per group (ties included) and
   sums of absolute differences per pair of sources, whose terms are laid out
   in blocks inside tasks and leave them as partial sums. Texts come back by a
   join for the top rows alone, which settles ties.

All shares and sums are whole numbers. Defined results: null text, lang and
source count as ''; a text without a term adds only its group; a language
without kept terms has pair rows of value 0 and no term row; a lone source has
no pair row; ties go by the item's UTF-8 bytes; repeated rows are documents
of their own; doc_id is not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

MIN_DOCS, TOP = 30, 50
UNIT, SMOOTH = 1_000_000_000, 5
HELD_TERMS = 400_000          # distinct (lang, source, term) a task holds before it writes them
SOURCE_BLOCK = 128            # sources a block
HELD_BLOCKS = 64              # block pairs a task holds before it hands them on
BROADCAST_ROWS = 1_000_000    # digests of 8 bytes
#: Bytes that are no part of a term become spaces, A-Z become a-z.
TERM_BYTES = bytes(32 if b < 0x41 or 0x5A < b < 0x61 or 0x7A < b < 0x80 else b + 32 if b < 0x5B else b for b in range(256))
COUNTS = pa.schema([("digest", pa.int64()), ("lang", pa.binary()), ("source", pa.binary()), ("term", pa.binary()),
                    ("count", pa.int64()), ("docs", pa.int64())])


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, A-Z lower-cased."""
    return text.translate(TERM_BYTES).split()


def term_counts(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """``digest, lang, source, term, count, docs``, partly added up; a row without a
    digest for every group."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[tuple, Counter] = defaultdict(Counter)
        seen: dict[tuple, Counter] = defaultdict(Counter)
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), found in count.items():
                names = list(found)
                digest = xxhash.xxh64_intdigest
                head = b"%d:%s" % (len(lang), lang)
                h = np.array([digest(head + t) for t in names], dtype=np.uint64) >> np.uint64(64 - hash_bits)
                docs_of = seen[lang, source]
                n = len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None, *h.view(np.int64).tolist()], pa.int64()), pa.array([lang] * (n + 1), pa.binary()),
                     pa.array([source] * (n + 1), pa.binary()), pa.array([b"", *names], pa.binary()),
                     pa.array([0, *found.values()], pa.int64()), pa.array([0, *(docs_of[t] for t in names)], pa.int64())], schema=COUNTS)
            count.clear()
            seen.clear()

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                text, lang, source = (c.cast(pa.binary()).to_pylist() for c in batch.slice(start, 256).columns)
                for t, *group in zip(text, lang, source, strict=True):
                    group, found = tuple(group), terms(t)
                    own = count[group]
                    before = len(own)
                    own.update(found)
                    seen[group].update(set(found))
                    held += len(own) - before
                    if held >= HELD_TERMS:
                        yield from flush()
                        held = 0
        yield from flush()

    plain = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")])
    raw = plain.mapInArrow(read, "digest long, lang binary, source binary, term binary, count long, docs long")
    return raw.select("digest", *[F.col(c).cast("string").alias(c) for c in ("lang", "source", "term")], "count", "docs")


def _few(df: DataFrame) -> DataFrame:
    """``df`` (a written table of digests) marked for broadcast where its rows are few enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def kept_terms(table: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """(``digest, k, lang, term``: the kept terms; ``digest, k, lang, source, count``:
    their counts per group), both written. k numbers the terms of one digest."""
    often = table.filter("digest IS NOT NULL").groupBy("digest").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
    often = _few(materialise(often.select("digest"), "divergence-digests"))
    rows = table.join(often, "digest", "left_semi")
    name = F.struct("lang", "term")
    ends = materialise(rows.groupBy("digest").agg(F.min(name).alias("low"), F.max(name).alias("high")), "divergence-names")
    mixed = materialise(ends.filter("low <> high").select("digest"), "divergence-clashes")
    terms_of = ends.filter("low = high").select("digest", F.lit(0).alias("k"), "low.lang", "low.term")
    counts = rows.groupBy("digest", "lang", "source").agg(F.sum("count").alias("count"))
    if mixed.isEmpty():
        return (materialise(terms_of, "divergence-terms"),
                materialise(counts.withColumn("k", F.lit(0)), "divergence-counts"))
    split = materialise(rows.join(mixed, "digest", "left_semi").groupBy("digest", "lang", "source", "term")
                        .agg(F.sum("count").alias("count"), F.sum("docs").alias("docs")), "divergence-split")
    own = (split.groupBy("digest", "lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
           .withColumn("k", F.row_number().over(Window.partitionBy("digest").orderBy("lang", "term")))
           .select("digest", "k", "lang", "term"))
    own = materialise(own, "divergence-split-terms")
    clean = counts.join(mixed, "digest", "left_anti").withColumn("k", F.lit(0))
    parts = split.join(own, ["digest", "lang", "term"]).select("digest", "lang", "source", "count", "k")
    return (materialise(terms_of.unionByName(own), "divergence-terms"),
            materialise(clean.unionByName(parts), "divergence-counts"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """p, by whole-number division (38 digits, so that no product overflows)."""
    wide = lambda c: c.cast("decimal(38,0)")
    top = (count + SMOOTH).cast("decimal(27,0)") * F.lit(UNIT).cast("decimal(10,0)")
    low = wide(total + SMOOTH * kept)
    return F.when(low > 0, F.lit(1).cast("long") + F.call_function("div", wide(top), low))


def _block_sums(rows: DataFrame) -> DataFrame:
    """``lang, i, j, value``: partial sums of |p_i - p_j| over terms, for source
    numbers i < j of each language. ``rows``: ``lang, a, b, one, two, base_one, base_two``,
    a term's numbers and shares in the source blocks a and b, and every source's
    share of a term that it lacks."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def hand_on() -> Iterator[pa.RecordBatch]:
            for (lang, a, b), (total, _, _) in held.items():
                i, j = np.indices(total.shape)
                i, j = i + a * SOURCE_BLOCK, j + b * SOURCE_BLOCK
                use = i < j
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * int(use.sum()), pa.string()), pa.array(i[use].astype(np.int32)),
                     pa.array(j[use].astype(np.int32)), pa.array(total[use])], names=["lang", "i", "j", "value"])
            held.clear()

        def dense(base: np.ndarray, lists: pa.Array) -> np.ndarray:
            out = np.tile(base, (len(lists), 1))
            flat = lists.flatten()
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            out[row, flat.field("at").to_numpy(zero_copy_only=False)] = flat.field("p").to_numpy(zero_copy_only=False)
            return out

        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = pa.Table.from_batches([batch.slice(start, 4096)])
                keys = part.select(["lang", "a", "b"]).to_pydict()
                places = defaultdict(list)
                for n, key in enumerate(zip(keys["lang"], keys["a"], keys["b"], strict=True)):
                    places[key].append(n)
                for key, at in places.items():
                    if key not in held:
                        if len(held) >= HELD_BLOCKS:
                            yield from hand_on()
                        first = part.slice(at[0], 1)
                        x, y = (np.array(first.column(c)[0].as_py(), dtype=np.int64) for c in ("base_one", "base_two"))
                        held[key] = [np.zeros((len(x), len(y)), dtype=np.int64), x, y]
                    total, x, y = held[key]
                    own = part.take(pa.array(at)).combine_chunks()
                    p, q = dense(x, own.column("one").chunk(0)), dense(y, own.column("two").chunk(0))
                    for i in range(p.shape[1]):
                        total[i] += np.abs(p[:, i:i + 1] - q).sum(axis=0)
        yield from hand_on()

    return rows.select("lang", "a", "b", "one", "two", "base_one", "base_two").mapInArrow(add, "lang string, i int, j int, value long")


def pair_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, i, j, value``: for each pair of a language's sources (numbers i < j).

    ``groups``: ``lang, source, i, total, kept``; ``counts`` as ``kept_terms`` gives them.
    """
    block = F.floor(F.col("i") / SOURCE_BLOCK).cast("int")
    base = (groups.withColumn("none", share(F.lit(0).cast("long"), F.col("total"), F.col("kept")))
            .filter("kept > 0").groupBy("lang", block.alias("block"))
            .agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "none"))), lambda x: x["none"]).alias("base")))
    base = materialise(base, "divergence-bases")
    p = share(F.col("count"), F.col("total"), F.col("kept"))
    cells = (counts.join(groups, ["lang", "source"]).groupBy("lang", "digest", "k", block.alias("block"))
             .agg(F.collect_list(F.struct((F.col("i") % SOURCE_BLOCK).alias("at"), p.alias("p"))).alias("cells")))
    # a language of one block, as nearly all are, has one row a term; else a row per block pair
    blocks = base.groupBy("lang").agg(F.count("*").cast("int").alias("blocks"))
    terms_of = (cells.groupBy("lang", "digest", "k").agg(F.map_from_entries(F.collect_list(F.struct("block", "cells"))).alias("cells"))
                .join(blocks, "lang"))
    pairs = F.flatten(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda a: F.transform(
        F.sequence(a, F.col("blocks") - 1), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    empty = F.array().cast("array<struct<at:int,p:bigint>>")
    at = lambda b: F.coalesce(F.try_element_at("cells", F.col(b)), empty)
    rows = terms_of.withColumn("ab", F.explode(pairs)).select("lang", "ab.a", "ab.b", "cells").select(
        "lang", "a", "b", at("a").alias("one"), at("b").alias("two"))
    one = base.select("lang", F.col("block").alias("a"), F.col("base").alias("base_one"))
    two = base.select("lang", F.col("block").alias("b"), F.col("base").alias("base_two"))
    return (_block_sums(rows.join(one, ["lang", "a"]).join(two, ["lang", "b"]))
            .groupBy("lang", "i", "j").agg(F.sum("value").alias("value")))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, hash_bits: int = 64) -> DataFrame:
    """``lang, source, part, item, value, rank``: every pair of a language's sources,
    and each source's ``top`` terms whose share exceeds the language's."""
    table = materialise(term_counts(docs.select("text", "lang", "source"), hash_bits), "divergence-scan")
    names, counts = kept_terms(table, min_docs)
    size = names.groupBy("lang").agg(F.count("*").alias("kept"))
    in_group = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = (table.filter("digest IS NULL").select("lang", "source").distinct()
              .join(in_group, ["lang", "source"], "left").join(size, "lang", "left").fillna(0, ["total", "kept"])
              .withColumn("i", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1))
    groups = materialise(groups, "divergence-groups")

    # pairs of sources
    value = materialise(pair_values(counts, groups), "divergence-pairs")
    own, other = groups.select("lang", "source", "i"), groups.select("lang", F.col("source").alias("item"), F.col("i").alias("j"))
    low, high = F.least("i", "j"), F.greatest("i", "j")
    pairs = (own.join(other, "lang").filter("i <> j").select("lang", "source", "item", low.alias("i"), high.alias("j"))
             .join(value, ["lang", "i", "j"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))

    # terms above the language's share: the best by value, ties included, before any text is read
    in_lang = counts.groupBy("digest", "k").agg(F.sum("count").alias("lang_count"))
    lang_total = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    p = share(F.col("count"), F.col("total"), F.col("kept"))
    q = share(F.col("lang_count"), F.col("lang_total"), F.col("kept"))
    above = (counts.join(in_lang, ["digest", "k"]).join(groups.join(lang_total, "lang"), ["lang", "source"])
             .select("lang", "source", "digest", "k", p.alias("p"), q.alias("q")).filter("p > q")
             .select("lang", "source", "digest", "k", (F.col("p") - F.col("q")).alias("value")))
    best = above.withColumn("place", F.rank().over(Window.partitionBy("lang", "source").orderBy(F.desc("value")))).filter(F.col("place") <= top)
    best = materialise(best.drop("place"), "divergence-best")
    spelt = best.join(names.select("digest", "k", "term"), ["digest", "k"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    spelt = spelt.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.unionByName(spelt)
