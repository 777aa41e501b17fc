"""Operator 7: n-gram Jaccard join by a token-group matrix.

Documents are sets of word shingles (64-bit hashes); two link when
``100 * |intersection| >= PERCENT * |union|``. Exact at every size:

1. Scan: each text becomes its set of 64-bit hashes, its size, a 128-bit digest
   and ``BANDS`` keys from a one-permutation sketch. Tokens are ordered by hash,
   those seen often in a sample of texts last: the order only steers the work,
   any order gives the same links. Equal sets (copies) are one node.
2. Groups: in every key bucket the other nodes are compared with one centre, the
   node of most tokens seen often (what copies have in common, so it is near most
   of them); verified links join similar documents into groups, whatever their
   number, with one comparison per document and key.
3. Token-group matrix: a row per token and group, from the first
   ``n - ceil(n * PERCENT / 100) + 1`` tokens of each member. Two sets that
   link share one of these, so only groups that meet in a row are candidates;
   and from the first token they share on, each must have left the
   ``P (a + b) / (100 + P)`` tokens that sets of sizes a and b share if they link
   (P = PERCENT). Rows that leave less to either side are no meeting.
4. Bound: the overlap of a query (a member of the smaller group) with the
   other group's token union must reach ``PERCENT`` per cent of the query. A group
   of at most ``FIRST_OPENED`` members needs no bound, all are met in one round.
   Only qualifying groups are opened, and their members compared in
   rounds: queries whose group has met the opened one need no more members. From the
   second round on only members are compared that share a row of step 3 with the query.
   Sketches (a bit for each token at least, the parity of the tokens that fall on it)
   go first: two sets differ in at least as many tokens as their sketches in bits, so
   pairs whose sketches differ too much cannot link. The others are compared exactly.
5. Components of all links, by contraction rounds over a shrinking edge list.

Side tables are broadcast only up to ``BROADCAST_ROWS`` rows, else joined by a
shuffle. No step collects links, sets or labels to the driver; every round
reads written tables.

Defined results: null and empty texts have no shingle, link with nothing and
are their own component; a text of fewer than five words is one shingle; a
null doc_id never names a component unless all its ids are null; repeated rows
are equal sets and ties are links at exactly ``PERCENT``; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, most_frequent, release, release_newer, rows_that_stay, scratch_tables, text_of

SHINGLE, PERCENT = 5, 80
BANDS, ROWS = 8, 3
HEAVY_SAMPLE, HEAVY_SEEN, HEAVY_LIMIT = 16, 4, 200_000
BROADCAST_ROWS, ROWS_OUT = 2_000_000, 50_000
FIRST_OPENED, GROWTH = 8, 16                 # members of a group a query meets first; rise by round
SKETCH = 1024                                # least bits of a sketch; steers the work only
KEPT = 8                                     # bytes of a token in a stored set: the whole hash
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                 0xFF51AFD7ED558CCD], dtype=np.uint64)  # odd multipliers


class _WordHash(dict):
    """Word to 64-bit hash; forgets all when full. One lives as long as its task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 150_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, size: int = SHINGLE, hashes: _WordHash | None = None) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles of a UTF-8 text."""
    words = text.translate(LOWER).split() if text else []
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    hashes = _WordHash() if hashes is None else hashes
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=n)
    k = min(size, n)
    total = np.full(n - k + 1, k, dtype=np.uint64)
    for j in range(k):
        total += _mix(h[j:n - k + 1 + j] + np.uint64(j)) * _ODD[j % 5]
    return np.unique(_mix(total))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - (n * percent + 99) // 100 + 1


def pack(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<i8")


def band_keys(tokens: np.ndarray) -> list[int]:
    """Keys from the smallest hash in each of BANDS x ROWS equal ranges (an empty
    range takes the next one's)."""
    bins = BANDS * ROWS
    edges = (np.arange(bins, dtype=np.uint64) * np.uint64((1 << 64) // bins))
    least = tokens[np.searchsorted(tokens, edges) % len(tokens)].reshape(ROWS, BANDS)
    key = np.arange(BANDS, dtype=np.uint64)
    for row in least:
        key = _mix(key * _ODD[0] + row)
    return key.view(np.int64).tolist()


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[bytes | None]:
    for start in range(0, batch.num_rows, 256):
        yield from batch.column(column).slice(start, 256).cast(pa.binary()).to_pylist()


def frequent_tokens(docs: DataFrame, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes seen in ``HEAVY_SEEN`` or more of the sampled distinct texts;
    the ``HEAVY_LIMIT`` most frequent at most. Steers the order of tokens only."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHash()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                sets = [shingles(t, size, hashes) for t in _texts(batch.slice(start, 256), 0)]
                found, n = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["tok", "n"])

    key = F.xxhash64(text_of())
    sample = docs.select("text", key.alias("key")).filter(F.pmod("key", F.lit(HEAVY_SAMPLE)) == 0)
    once = sample.groupBy("key").agg(F.first("text").alias("text")).select("text")
    often = (once.mapInArrow(emit, "tok long, n long").groupBy("tok").agg(F.sum("n").alias("n"))
             .filter(F.col("n") >= HEAVY_SEEN))
    top = most_frequent(materialise(often, "jaccard-frequent"), HEAVY_LIMIT).select("tok").collect()
    return np.sort(np.array([r["tok"] for r in top], dtype=np.int64).view(np.uint64))


SCAN = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), ("cid", pa.binary()), ("often", pa.int64()), ("bands", pa.list_(pa.int64())), ("tokens", pa.binary())])


def scan(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``rid, doc_id, text_key, n, cid, often, bands, tokens``; ``often``: tokens that stand last
    as seen often. It, bands and tokens are given once per distinct set and task, which is
    enough: equal sets are one node."""
    heavy = frequent_tokens(docs, size)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        hashes = _WordHash()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                n, cid, frequent, bands, tokens = [], [], [], [], []
                for text in part.column(2).cast(pa.binary()).to_pylist():
                    s = shingles(text, size, hashes)
                    n.append(len(s))
                    digest = xxhash.xxh3_128_digest(s.tobytes())
                    cid.append(digest if len(s) else None)
                    new = len(s) > 0 and digest not in seen
                    last = 0
                    if new:
                        seen.add(digest)
                        if len(heavy):
                            often = heavy[np.minimum(heavy.searchsorted(s), len(heavy) - 1)] == s
                            ordered = np.concatenate((s[~often], s[often]))
                            last = int(often.sum())
                        else:
                            ordered = s
                    frequent.append(last if new else None)
                    bands.append(band_keys(s) if new else None)
                    tokens.append(pack(ordered) if new else None)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(cid, pa.binary()),
                                                  pa.array(frequent, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(tokens, pa.binary())], schema=SCAN)

    return (docs.select(F.col("doc_id").cast("long"), F.xxhash64(text_of()), "text")
            .mapInArrow(read, "doc_id long, text_key long, n long, cid binary, often long, bands array<bigint>, tokens binary")
            .withColumn("rid", F.monotonically_increasing_id()))


def _small(df: DataFrame) -> DataFrame:
    """``df`` (a written table) marked for broadcast where its rows are few enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: nodes of ``edges`` (a, b) with equal labels are connected.

    Each round every node moves to the least of its neighbours and itself in a
    random order of that round, and edges are rewritten; their number falls by
    a constant factor on any graph.
    """
    edges = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .filter("a <> b").distinct(), "jaccard-edges")
    labels = materialise(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                         .withColumn("label", F.col("node")), "jaccard-labels")
    turn = 0
    while not edges.isEmpty():
        turn += 1
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), F.col(c).alias("id"))  # noqa: B023, E731
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = materialise(both.groupBy("a").agg(F.min(rank("b")).alias("least"))
                           .select(F.col("a").alias("at"), F.least(F.col("least"), rank("a"))["id"].alias("to")), "jaccard-moves")
        before = labels
        labels = materialise(before.join(move, F.col("label") == F.col("at"), "left")
                             .select("node", F.coalesce("to", "label").alias("label")), "jaccard-labels")
        one = edges.join(move, F.col("a") == F.col("at")).select(F.col("to").alias("a"), "b")
        two = one.join(move, F.col("b") == F.col("at")).select("a", F.col("to").alias("b"))
        shorter = materialise(two.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                              .distinct(), "jaccard-edges")
        release(edges, move, before)
        edges = shorter
    release(edges)
    return labels


def _ends(pairs: DataFrame) -> DataFrame:
    """``node``: each ``a`` once, and each ``b``."""
    return pairs.select(F.col("a").alias("node")).distinct().unionByName(pairs.select(F.col("b").alias("node")).distinct())


def _tokens_of(scanned: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, tokens`` of the given nodes (column ``node``)."""
    wanted = _small(materialise(nodes.select("node").distinct(), "jaccard-wanted"))
    have = scanned.filter("tokens IS NOT NULL").select(F.col("rid").alias("node"), "tokens")
    return materialise(have.join(wanted, "node", "left_semi"), "jaccard-sets")


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``pairs`` (a, b) whose sets link."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = unpack(x.as_py()), unpack(y.as_py())
                common = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    full = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return full.mapInArrow(judge, "a long, b long")


def sketch(tokens: np.ndarray) -> bytes:
    """The parity of the number of tokens that fall on each bit. The bits are the least
    power of two, from ``SKETCH`` on, that gives every token one: with fewer, sketches of
    large sets could not differ in enough bits to rule a link out."""
    bits = max(SKETCH, 1 << (len(tokens) - 1).bit_length())
    return np.packbits(np.bincount(tokens & (bits - 1), minlength=bits).astype(np.uint8) & 1).tobytes()


def _folded(drawn: bytes, width: int) -> bytes:
    """The sketch of ``width`` bytes of the same set."""
    if len(drawn) == width:
        return drawn
    return np.bitwise_xor.reduce(np.frombuffer(drawn, dtype=np.uint64).reshape(-1, width // 8), axis=0).tobytes()


def differing_bits(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """In how many bits the sketches of each pair differ, at the width of the smaller one."""
    width = np.array([min(len(p), len(q)) for p, q in zip(x, y, strict=True)], dtype=np.int64)
    differ = np.zeros(len(width), dtype=np.int64)
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        p, q = (np.frombuffer(b"".join(_folded(side[i], w) for i in at.tolist()), dtype=np.uint64).reshape(len(at), -1) for side in (x, y))
        differ[at] = np.bitwise_count(p ^ q).sum(axis=1, dtype=np.int64)
    return differ


def _sketches(scanned: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, size, sketch`` of the given nodes (column ``node``)."""
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [unpack(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array([sketch(s) for s in sets], pa.binary())], names=["node", "size", "sketch"])

    wanted = materialise(nodes.select("node").distinct(), "jaccard-wanted")
    have = scanned.filter("tokens IS NOT NULL").select(F.col("rid").alias("node"), "tokens")
    out = materialise(have.join(_small(wanted), "node", "left_semi").mapInArrow(draw, "node long, size long, sketch binary"), "jaccard-sketches")
    release(wanted)
    return out


def near_enough(pairs: DataFrame, sketches: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``pairs`` (a, b) whose sketches do not rule a link out.

    Sets of sizes p and q link only if they differ in at most
    (p + q) * (100 - percent) / (100 + percent) tokens.
    """
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, q = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            differ = differing_bits(batch.column(4).to_pylist(), batch.column(5).to_pylist())
            keep = differ * (100 + percent) <= (p + q) * (100 - percent)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    left = sketches.select(F.col("node").alias("a"), F.col("size").alias("p"), F.col("sketch").alias("x"))
    right = sketches.select(F.col("node").alias("b"), F.col("size").alias("q"), F.col("sketch").alias("y"))
    full = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "p", "q", "x", "y")
    return full.mapInArrow(judge, "a long, b long")


def _fits(n: str, m: str, percent: int):
    """Sizes under which sets can link at all."""
    return (F.col(n) * 100 >= F.col(m) * percent) & (F.col(m) * 100 >= F.col(n) * percent)


def _can_link(percent: int):
    """For sets of sizes n and m that share a token: whether it can be the first of the
    tokens they share if they link, by what each has from it on (``rest``, ``left``)."""
    return F.least("rest", "left").cast("long") * (100 + percent) >= (F.col("n").cast("long") + F.col("m")) * percent


def _rows(sets: DataFrame, percent: int | None = None) -> DataFrame:
    """``node, tok``: the tokens of every set, or only of its prefix, then with ``n``, the
    set's size, and ``rest``, its tokens from this one on."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            held_ = [len(x) for x in parts]
            columns = {"node": np.repeat(np.array(nodes, dtype=np.int64), held_), "tok": np.concatenate(parts)}
            if percent is not None:
                columns["n"] = np.repeat(np.array(sizes, dtype=np.int32), held_)
                before = np.arange(len(columns["tok"])) - np.repeat(np.cumsum([0, *held_[:-1]]), held_)
                columns["rest"] = columns["n"] - before.astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns.values()], names=list(columns))

        nodes, parts, sizes, held = [], [], [], 0
        for batch in batches:
            for node, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = data.as_py()
                n = len(data) // KEPT
                parts.append(unpack(data[:KEPT * (n if percent is None else prefix_length(n, percent))]))
                nodes.append(node)
                sizes.append(n)
                held += len(parts[-1])
                if held >= ROWS_OUT:
                    yield rows()
                    nodes, parts, sizes, held = [], [], [], 0
        if nodes:
            yield rows()

    return sets.select("node", "tokens").mapInArrow(emit, "node long, tok long" + ("" if percent is None else ", n int, rest int"))


def links(scanned: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(edges a, b that connect all and only linked nodes; rid, rep of every set)."""
    own = scanned.filter("tokens IS NOT NULL").select("rid", "cid", "n")
    rep = scanned.filter("n > 0").groupBy("cid").agg(F.min("rid").alias("rep"))
    nodes = materialise(own.join(rep, "cid").select("rid", "rep", "n"), "jaccard-nodes")

    # groups: each node against the centre of its key buckets
    keyed = scanned.filter("tokens IS NOT NULL").select("rid", "n", "often", F.explode("bands").alias("key"))
    first = F.struct((-F.col("often")).alias("rank"), "rid", "n")
    centre = (keyed.groupBy("key").agg(F.min(first).alias("c"), F.count("*").alias("size"))
              .filter("size > 1").select("key", F.col("c.rid").alias("b"), F.col("c.n").alias("m")))
    centre = materialise(centre, "jaccard-centres")
    stars = (keyed.join(centre, "key").filter((F.col("rid") != F.col("b")) & _fits("n", "m", percent))
             .select(F.col("rid").alias("a"), "b").distinct())
    stars = materialise(stars, "jaccard-stars")
    sets = _tokens_of(scanned, _ends(stars))
    found = materialise(verified(stars, sets, percent), "jaccard-near")
    release(sets, stars, centre)
    copies = nodes.filter("rid <> rep").select(F.col("rid").alias("a"), F.col("rep").alias("b"))
    edges = found.unionByName(copies)
    label = components(edges)
    member = materialise(nodes.join(label, nodes["rid"] == label["node"], "left")
                         .select("rid", "rep", "n", F.coalesce("label", "rid").alias("g")), "jaccard-members")

    # token-group matrix, and groups that meet in one of its rows
    moved = _small(materialise(member.filter("g <> rid").select(F.col("rid").alias("node"), "g"), "jaccard-moved"))
    every = scanned.filter("tokens IS NOT NULL").select(F.col("rid").alias("node"), "tokens")
    # dealt by token once: the grouped rows and both sides of the join share that shuffle
    matrix = (_rows(every, percent).join(moved, "node", "left")
              .select("tok", F.coalesce("g", "node").alias("g"), "n", "rest").repartition("tok")
              .groupBy("tok", "g").agg(F.min("n").alias("n"), F.max("rest").alias("rest")))
    other = matrix.select("tok", F.col("g").alias("h"), F.col("n").alias("m"), F.col("rest").alias("left"))
    meet = matrix.join(other, "tok").filter((F.col("g") < F.col("h")) & _can_link(percent)).select("g", "h").distinct()
    info = member.groupBy("g").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.count("*").alias("size"))
    info = materialise(info, "jaccard-groups")
    one = info.select("g", F.col("lo").alias("lo1"), F.col("hi").alias("hi1"), F.col("size").alias("size1"))
    two = info.select(F.col("g").alias("h"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), F.col("size").alias("size2"))
    swap = F.col("size1") > F.col("size2")  # queries come from the smaller group
    pick = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
    meet = materialise(
        materialise(meet, "jaccard-meet").join(one, "g").join(two, "h")
        .filter((F.col("hi1") * 100 >= F.col("lo2") * percent) & (F.col("hi2") * 100 >= F.col("lo1") * percent))
        .select(pick("g", "h").alias("q"), pick("h", "g").alias("t"), pick("lo2", "lo1").alias("lo"), pick("hi2", "hi1").alias("hi")),
        "jaccard-candidates")

    # bound each query's overlap with the group's token union, open what qualifies
    queries = (meet.join(member.select(F.col("g").alias("q"), "rid", "n"), "q")
               .filter((F.col("hi") * 100 >= F.col("n") * percent) & (F.col("n") * 100 >= F.col("lo") * percent))
               .select("rid", "n", "t"))
    queries = materialise(queries, "jaccard-queries")
    inside = member.join(queries.select(F.col("t").alias("g")).distinct(), "g", "left_semi").select("rid", "n", F.col("g").alias("t"))
    inside = materialise(inside, "jaccard-inside")
    large = materialise(info.filter(F.col("size") > FIRST_OPENED).select(F.col("g").alias("t")), "jaccard-large")
    asking = materialise(queries.join(_small(large), "t", "left_semi"), "jaccard-asking")
    asked_of = materialise(inside.join(_small(large), "t", "left_semi").select(F.col("rid").alias("node"), "t"), "jaccard-asked")
    sets = _tokens_of(scanned, asking.select(F.col("rid").alias("node")).unionByName(asked_of.select("node")))
    token = materialise(_rows(sets), "jaccard-tokens")
    union = token.join(asked_of, "node").select("t", "tok").distinct()
    asked = token.join(asking.select(F.col("rid").alias("node"), "n", "t"), "node")
    reached = (asked.join(union, ["t", "tok"]).groupBy("node", "n", "t").agg(F.count("*").alias("overlap"))
               .filter(F.col("overlap") * 100 >= F.col("n") * percent).select("node", "n", "t"))
    at_once = queries.join(_small(large), "t", "left_anti").select(F.col("rid").alias("node"), "n", "t")
    opened = materialise(reached.unionByName(at_once), "jaccard-opened")
    release(queries, sets, token, asking, asked_of, large, info)
    more = _open_in_rounds(opened, inside, member, scanned, percent)
    release(inside)
    return reduce(DataFrame.unionByName, more, edges), nodes


def _open_in_rounds(opened: DataFrame, inside: DataFrame, member: DataFrame, scanned: DataFrame, percent: int) -> list[DataFrame]:
    """Tables of links (a, b) that connect all groups that ``opened`` (node, n, t) can connect.

    The members of a group are connected already, so one verified link joins two
    groups for good. Each round compares a query with about ``FIRST_OPENED`` x
    ``GROWTH`` ^ round members of the group, chosen by hash; then queries whose
    group and the opened one have met are left out, and the rest goes on with the
    members not yet seen, until all are.
    """
    size = inside.groupBy("t").agg(F.count("*").alias("size"))
    place = materialise(inside.join(size, "t").withColumn("place", F.pmod(F.xxhash64(F.lit("place"), "rid"), F.col("size")))
                        .select("t", F.col("rid").alias("b"), F.col("n").alias("m"), "place"), "jaccard-places")
    left = materialise(opened.join(member.select(F.col("rid").alias("node"), "g"), "node")
                       .select("node", "n", "g", "t"), "jaccard-left")
    release(opened)
    last = place.agg(F.max("place")).first()[0]
    found: list[DataFrame] = []
    low, high = 0, FIRST_OPENED
    while last is not None and low <= last:
        some = place.filter((F.col("place") >= low) & (F.col("place") < high))
        prefix = None
        if low:
            sets = _tokens_of(scanned, left.select("node").unionByName(some.select(F.col("b").alias("node"))))
            prefix = materialise(_rows(sets, percent), "jaccard-prefixes")
            release(sets)
            asks = left.select("node", "t").join(prefix, "node")
            held = prefix.select(F.col("node").alias("b"), "tok", F.col("n").alias("m"), F.col("rest").alias("left"))
            met = asks.join(some.select("t", "b").join(held, "b"), ["t", "tok"]).filter(_can_link(percent))
        else:
            met = left.join(some, "t").filter(_fits("n", "m", percent))
        pairs = materialise(met.select(F.col("node").alias("a"), "b").distinct(), "jaccard-pairs")
        release(*[] if prefix is None else [prefix])
        sketches = _sketches(scanned, _ends(pairs))
        near = materialise(near_enough(pairs, sketches, percent), "jaccard-pairs")
        sets = _tokens_of(scanned, _ends(near))
        found.append(materialise(verified(near, sets, percent), "jaccard-more"))
        release(pairs, sketches, near, sets)
        low, high = high, high * GROWTH
        if low > last:
            break
        owner = lambda c: member.select(F.col("rid").alias(c), F.col("g").alias(f"group_{c}"))
        links_now = reduce(DataFrame.unionByName, found)
        met = components(links_now.join(owner("a"), "a").join(owner("b"), "b").select(F.col("group_a").alias("a"), F.col("group_b").alias("b")))
        side = lambda c: met.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}"))
        large = place.filter(F.col("place") >= low).select("t").distinct()
        apart = F.coalesce("label_g", "g") != F.coalesce("label_t", "t")
        rest = materialise(left.join(large, "t", "left_semi").join(side("g"), "g", "left").join(side("t"), "t", "left")
                           .filter(apart).select("node", "n", "g", "t"), "jaccard-left")
        release(left, met)
        left = rest
        if left.isEmpty():
            break
    release(left, place)
    return found


def _labelled(docs: DataFrame, percent: int, size: int) -> DataFrame:
    """One row per row: ``doc_id, text_key, n_shingles, component_id, label`` (names the
    component whatever its ids; null without shingles)."""
    scanned = materialise(scan(docs.select("doc_id", "text"), size), "jaccard-scan")
    edges, _ = links(scanned, percent)
    label = components(edges)
    rep = scanned.filter("n > 0").groupBy("cid").agg(F.min("rid").alias("rep"), F.min("doc_id").alias("least"))
    named = materialise(rep.join(label, rep["rep"] == label["node"], "left")
                        .select("cid", "least", F.coalesce("label", "rep").alias("label")), "jaccard-named")
    whole = named.groupBy("label").agg(F.min("least").alias("component"))
    by_set = materialise(named.join(whole, "label").select("cid", "component", "label"), "jaccard-components")
    release(label, named)
    return (scanned.select("doc_id", "text_key", "n", "cid").join(by_set, "cid", "left")
            .select("doc_id", "text_key", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"), "label"))


def jaccard_groups(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """One row per row: ``doc_id, text_key, n_shingles, component_id`` (least doc_id reachable by links)."""
    return _labelled(docs, percent, size).drop("label")


def keep_one_per_group(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, all columns as they were.

    Of a component stays the row of the least doc_id, null last; of several such
    rows that of the least text hash; of repeated rows (equal doc_id and text) one.
    Rows without a shingle are alone in their component and stay.
    """
    before = scratch_tables()
    found = _labelled(docs, percent, SHINGLE).filter("label IS NOT NULL")
    rows = materialise(found.groupBy("doc_id", F.col("text_key").alias("key"), "label")
                       .agg(F.count("*").alias("rows")), "jaccard-result")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    best = rows.groupBy("label").agg(F.min(order).alias("best"))
    same = F.col("best.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("best.key") == F.col("key"))
    verdict = rows.join(best, "label").select("doc_id", "key", "rows", same.alias("stays")).filter("rows > 1 OR NOT stays")
    verdict = release_newer(before, materialise(verdict, "jaccard-verdicts"))
    return rows_that_stay(docs, F.xxhash64(text_of()), verdict)
