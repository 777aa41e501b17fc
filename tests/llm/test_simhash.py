"""SimHash near-dedup: fingerprints, the ring's filter, components."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from warcsift.llm import queries, simhash
from warcsift.llm.common import materialise

from . import brute

SF = "/root/testdata/sf0.01"


def brute_fingerprint(text):
    words = brute.words(brute.lower(text))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    """Least fingerprint reachable, by comparing all pairs."""
    fps = np.array(sorted(set(fps)), dtype=np.uint64)
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= 3) + i + 1:
            a, b = sorted((root(i), root(int(j))))
            parent[b] = a
    return {int(fps[i]): int(fps[root(i)]) for i in range(len(fps))}


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    fp = [brute_fingerprint(r["text"]) for r in rows]
    comp = brute_components(fp) if fp else {}
    least = defaultdict(list)
    for r, f in zip(rows, fp):
        if r["doc_id"] is not None:
            least[comp[f]].append(r["doc_id"])
    want = Counter((r["doc_id"], f"{f:016x}", min(least[comp[f]], default=None)) for r, f in zip(rows, fp))
    assert Counter(tuple(r) for r in simhash.simhash_groups(docs).collect()) == want


def test_spark_and_python_hash_alike(spark):
    from pyspark.sql import functions as F
    text = "ein drei-wort schnäppchen 漢字"
    got = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest(text.encode(), 42)


def test_tricky_rows(spark):
    check(brute.tricky(spark))
    check(brute.clashing(brute.tricky(spark)))


def test_empty_table(spark):
    out = simhash.simhash_groups(brute.empty(spark))
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 0


def test_given_documents(spark):
    check(spark.read.parquet(f"{SF}/documents.parquet"))
    got = queries.QUERIES["op11_simhash"](spark, SF)
    assert got.count() == 1000


def test_every_near_pair_has_a_viable_chain():
    r = random.Random(5)
    may = simhash.budgets()
    assert may == [0, 1, 2, 3]
    for _ in range(3000):
        x = sum(1 << b for b in r.sample(range(64), r.randint(0, 3)))
        viable = [s for s in range(4)
                  if all((x & sum(simhash.ring(s)[:j + 1])).bit_count() <= may[j] for j in range(4))]
        assert viable
        for s in viable:  # and such a start leads to an equal finer bucket at every level
            masks = [simhash.ring(s)[0]]
            for level in range(1, 8):
                masks = [c for m in masks for c in simhash.finer(s, m, level) if not x & c]
                assert masks
                masks = masks[:2]


def near(r, fp, bits):
    for b in r.sample(range(64), bits):
        fp ^= 1 << b
    return fp


def cloud(seed, n):
    """A dense cloud round one fingerprint, chains of links, and lone ones."""
    r = random.Random(seed)
    out = [r.getrandbits(64) for _ in range(n)]
    centre = r.getrandbits(64)
    out += [near(r, centre, r.randint(0, 6)) for _ in range(n)]
    weak = r.sample(range(64), 9)
    out += [centre ^ sum(1 << b for b in weak if r.random() < .5) for _ in range(n)]
    step = r.getrandbits(64)
    for _ in range(n // 2):
        step = near(r, step, 3)
        out.append(step)
    return sorted(set(out))


@pytest.mark.parametrize("bucket, runs", [(24, 64), (1024, 16_384)])
def test_components_of_dense_clouds(spark, monkeypatch, bucket, runs):
    monkeypatch.setattr(simhash, "RUN_ROWS", runs)
    fps = cloud(bucket, 250)
    nodes = spark.createDataFrame([(simhash._signed(f), 1) for f in fps], "fp long, weight long")
    label = {r["fp"]: r["label"] for r in simhash.groups(materialise(nodes, "test-nodes"), bucket).collect()}
    got, want = defaultdict(set), defaultdict(set)
    for f, c in brute_components(fps).items():
        s = simhash._signed(f)
        got[label.get(s, s)].add(f)
        want[c].add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_bucket_must_exceed_the_free_bits(spark):
    with pytest.raises(ValueError):
        simhash.groups(spark.createDataFrame([], "fp long, weight long"), 7)
