"""Mixing, personal data, language ID, Jaccard join, packing, language model."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from warcsift.llm import class_lm, disclosure, jaccard_join, language_id, mixing, packing, queries

from . import brute

SF, SF001 = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    return t


# --- mixing ----------------------------------------------------------------------------------

@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 1000, 10], [0, 0, 5], [0], [], [7], [50, 1, 1, 1, 900, 3, 40]])
def test_targets(sizes):
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    got = mixing.targets(sizes, weights)
    want = list(brute.targets({f"s{i:02}": n for i, n in enumerate(sizes)}).values())
    assert got == pytest.approx(want)
    assert sum(got) == pytest.approx(1.5 * sum(sizes))


def test_quota_tree_is_exact_and_even():
    quotas = np.array([1000, 3, 0, 47, 350])
    got = mixing.split_quotas(quotas, 7)
    assert (got.sum(axis=0) == quotas).all() and (got >= 0).all()
    assert got.sum(axis=1).max() - got.sum(axis=1).min() <= 1
    assert (got == mixing.split_quotas(quotas, 7)).all()
    assert got[:, 0].std() > 0  # drawn, not rounded shares


def check_mix(docs, rows):
    sizes, by_source = Counter(), defaultdict(int)
    for r in rows:
        by_source[r["source"]] += r["size"]
    goal = brute.targets(dict(by_source)) if by_source else {}
    total = Counter()
    for r in rows:
        assert r["source_size"] == by_source[r["source"]]
        assert r["target"] == pytest.approx(goal[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        total[r["source"]] += r["taken"]
        sizes[r["source"]] = max(sizes[r["source"]], r["size"])
    for s, t in goal.items():
        assert abs(total[s] - t) <= max(1, sizes[s])
    return total, goal


def test_mixing(spark):
    docs = brute.clashing(brute.tricky(spark))
    sized = mixing.sizes(docs)
    assert {(r["doc_id"], r["size"]) for r in sized.collect()} == {(d, len(brute.words(t))) for d, t, *_ in brute.tricky_rows()}
    plan = mixing.plan_mix(sized, shards=3)
    source = plan.docs.select("doc_id", "source", "size", "source_size", "target").distinct()
    got = mixing.taken(plan)
    assert got.count() == len(brute.tricky_rows())
    rows = []
    pool = defaultdict(list)
    for r in source.collect():
        pool[(r["doc_id"], r["size"], r["source_size"])].append(r["source"])
    for r in got.collect():
        rows.append(r.asDict() | {"source": pool[(r["doc_id"], r["size"], r["source_size"])][0]})
    check_mix(docs, rows)
    mixed = mixing.mix(docs, shards=3)
    assert mixed.columns[:len(docs.columns)] == docs.columns
    words = Counter()
    for r in mixed.select("doc_id", "text", "source").collect():
        words[(r["doc_id"], r["source"], len(brute.words(r["text"])))] += len(brute.words(r["text"]))
    taken = Counter()
    for r in rows:
        taken[(r["doc_id"], r["source"], r["size"])] += r["taken"]
    assert {k: v for k, v in words.items() if v} == {k: v for k, v in taken.items() if v}


def test_mixing_query_is_near_target_and_repeats(spark):
    source = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op2_mixing(spark, SF).collect()
    total, goal = check_mix(None, [r.asDict() | {"source": source[r["doc_id"]]} for r in got])
    assert all(abs(total[s] / t - 1) < 0.02 for s, t in goal.items())
    again = queries.op2_mixing(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_mix_reaches_the_shards_of_the_tree(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    took = Counter()
    for r in mixing.taken(mixing.plan_mix(mixing.sizes(docs), shards=4)).collect():
        assert len(r["shards"]) * r["size"] == r["taken"]
        took.update((r["doc_id"], s) for s in r["shards"] if r["size"])
    mixed = mixing.mix(docs, shards=4)
    rows = Counter((r["doc_id"], r["shard"]) for r in mixed.collect() if brute.words(r["text"]))
    assert took == rows and {s for _, s in rows} == {0, 1, 2, 3}
    order = defaultdict(list)
    for r in mixed.collect():
        order[r["doc_id"]].append((r["shard"], r["mix_order"]))
    written = [[r["doc_id"] for r in part] for part in mixing.in_mix_order(mixed).rdd.glom().collect()]
    assert Counter(d for part in written for d in part) == Counter(r["doc_id"] for r in mixed.collect())
    for part in written:  # by shard, then by the shard's order
        best = (-1, -(1 << 63))
        for d in part:
            best = min(at for at in order[d] if at >= best)


def test_write_mix(spark, tmp_dir):
    mixing.write_mix(mixing.mix(spark.read.parquet(f"{SF001}/documents.parquet"), shards=4), f"{tmp_dir}/mix", 4)
    back = spark.read.parquet(f"{tmp_dir}/mix")
    assert back.select("shard").distinct().count() <= 4 and back.count() > 0
    order = [r["mix_order"] for r in back.filter("shard = 0").collect()]
    assert order == sorted(order)


# --- personal data ---------------------------------------------------------------------------

def test_entities_against_patterns():
    r = random.Random(1)
    for _ in range(20_000):
        text = "".join(r.choice("aA1@.-+_% 2345()é") for _ in range(r.randrange(60)))
        assert disclosure.entities(text) == brute.private(text)
    for text in ("4111 1111 1111 1111", "4111-1111-1111-1111-7", "+1 (555) 123-4567 and +12", "1.2.3.4.5.6.7.8", "01.002.0003.255", "256.1.1.1",
                 "a@b.c_x@y.com", "9" * 5000, "1 " * 5000, "a" * 100_000 + "@", "+1" + "-" * 5000 + "2", "😀 x@y.zz 😀"):
        assert disclosure.entities(text) == brute.private(text)


def test_private_spans(spark):
    rows = brute.tricky_rows()
    docs = brute.clashing(brute.tricky(spark))
    got = disclosure.find_private(docs).select("doc_id", "spans").collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(d) for d, *_ in rows)
    assert disclosure.find_private(brute.empty(spark)).count() == 0
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op4_pii(spark, SF).collect():
        want = brute.private(texts[r["doc_id"]])
        assert r["base_sha256"] == brute.sha(brute.joined(want))
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == x for k, *_ in want) for x in disclosure.PATTERNS]


def test_revealing_terms(spark):
    """A word that only stands beside one entity reveals it; common words do not."""
    fill = [(i, "the plain words of the text and more of the same") for i in range(60)]
    told = [(100 + i, f"please ask Zorblatt at x.y@z{i % 1}.org about the text 4711-b") for i in range(4)]
    other = [(200 + i, f"please ask about the text at k{i}@z.org") for i in range(20)]
    docs = spark.createDataFrame(fill + told + other, "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in disclosure.find_private(docs).collect()}
    words = {t[s["start"]:s["end"]] for d, t in told for s in spans[d] if s["kind"] == disclosure.METHOD_KIND}
    assert words == {"Zorblatt", "4711-b"}
    assert not any(s["kind"] == disclosure.METHOD_KIND for d, _ in fill + other for s in spans[d])
    # the same by brute force over documents
    texts = dict(fill + told + other)
    near = {d: {(e, t) for e, t, *_ in disclosure.beside(x, disclosure.entities(x))} for d, x in texts.items()}
    together = Counter(p for ps in near.values() for p in ps)
    own = Counter(e for ps in near.values() for e in {e for e, _ in ps})
    holds = lambda t: sum(t in {w.strip(disclosure.EDGES) for w in x.lower().split()} for x in texts.values())
    want = set()
    for (e, t), n in together.items():
        pmi, info = math.log2(n * len(texts) / (own[e] * holds(t))), math.log2(len(texts) / own[e])
        if n >= disclosure.SUPPORT and info > 0 and pmi >= disclosure.THRESHOLD * info:
            want.add((e, t))
    got = {(r["entity"], r["term"]) for r in disclosure.revealing(
        disclosure.scan(docs), docs).collect()}
    assert got == want
    clean = {r["doc_id"]: r["text"] for r in disclosure.sanitise(brute.clashing(docs)).collect()}
    assert clean[100] == "please ask [removed] at [email] about the text 0000-b"
    assert all(clean[d] == t for d, t in fill)


def test_revealing_terms_far_from_the_entity_and_without_it(spark):
    """Whole documents count, and a revealing term is marked at every place of every text."""
    gap = " the plain words of the text and more of the same" * 3
    fill = [(i, f"{i}{gap}") for i in range(60)]
    told = [(100 + i, f"Zorblatt{gap} {i}a x.y@z.org{gap} (zorblatt)") for i in range(4)]
    alone = [(200, f"ask Zorblatt{gap} Zorblatt")]
    single = [(300, f"Quuxly{gap} once@z.org")]  # an entity of one document reveals nothing
    docs = spark.createDataFrame(fill + told + alone + single, "doc_id long, text string").repartition(5)
    spans = {r["doc_id"]: r["spans"] for r in disclosure.find_private(docs).collect()}
    marked = {d: [t[s["start"]:s["end"]] for s in spans[d] if s["kind"] == disclosure.METHOD_KIND] for d, t in fill + told + alone + single}
    assert {d: w for d, w in marked.items() if w} == {d: ["Zorblatt", "zorblatt"] for d, _ in told} | {200: ["Zorblatt"] * 2}
    clean = {r["doc_id"]: r["text"] for r in disclosure.sanitise(docs).collect()}
    assert clean[200] == f"ask [removed]{gap} [removed]" and clean[300] == f"Quuxly{gap} [email]"


def test_revealing_pairs_against_brute_force(spark, monkeypatch):
    """Entities and terms in all mixtures, copies among them, also when all checksums clash."""
    r = random.Random(8)
    texts = [" ".join(r.sample([f"w{r.randrange(150)}" for _ in range(30)] + [f"m{r.randrange(12)}@z.org" for _ in range(r.randrange(3))], 20))
             for _ in range(150)]
    texts += ["list a1@z.org a2@z.org a3@z.org with odd1 odd2"] * 2 + r.sample(texts, 20)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [({e for e, *_ in disclosure.beside(x, disclosure.entities(x))}, {t for t, *_ in disclosure.terms_of(x, disclosure.entities(x))}) for x in texts]
    together = Counter((e, t) for es, ts in sets for e in es for t in ts)
    own, holds = Counter(e for es, _ in sets for e in es), Counter(t for _, ts in sets for t in ts)
    want = {(e, t) for (e, t), n in together.items() if n >= disclosure.SUPPORT and own[e] < len(texts) and
            math.log2(n * len(texts) / (own[e] * holds[t])) >= disclosure.THRESHOLD * math.log2(len(texts) / own[e])}
    assert len(want) > 10
    for bits in (disclosure.BITS, 64):
        monkeypatch.setattr(disclosure, "BITS", bits)
        assert {(x["entity"], x["term"]) for x in disclosure.revealing(disclosure.scan(docs), docs).collect()} == want


# --- language ID -----------------------------------------------------------------------------

def test_language_held_out(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op5_language_id(spark, SF).collect()
    assert len(rows) == len(lang)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_odd_texts(spark):
    train = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(train)
    got = language_id.predict(brute.clashing(brute.tricky(spark)), model).collect()
    assert len(got) == len(brute.tricky_rows())
    for r, (d, t, *_) in zip(sorted(got, key=lambda r: str(r["doc_id"])), sorted(brute.tricky_rows(), key=lambda r: str(r[0])), strict=True):
        if d is not None and d != 2:
            letters = any(c.isalpha() for c in t or "")
            assert (r["lang_pred"] == "und") == (not letters) and (letters or r["score"] == 0)
    assert language_id.predict(brute.empty(spark), model).count() == 0
    assert language_id.fit(brute.empty(spark)) is None
    none = language_id.predict(brute.tricky(spark), None).collect()
    assert {r["lang_pred"] for r in none} == {"und"}


def test_kernel_against_sets():
    texts = ["the cat and the dog", "le chat et le chien", "der Hund und die Katze", "漢字 the"]
    grams = language_id.Grams.of(texts[:3])
    p = grams.presence(texts[:3])
    model = language_id.LanguageModel(["x"], grams, (p / np.sqrt(p.sum(axis=1, keepdims=True))).T, np.zeros((3, 1)), np.zeros(1))
    sets = [{t.lower()[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)} for t in texts]
    known = set().union(*sets[:3])
    want = [[len(a & b) / math.sqrt(len(a & known) * len(b)) for b in sets[:3]] for a in sets[:3]]
    assert np.allclose(model.kernel(texts[:3]), want, atol=1e-5)
    assert model.kernel([texts[3]]).max() < 0.7


# --- Jaccard join ----------------------------------------------------------------------------

def jaccard_of(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in df.collect())


def near_rows(seed, n=240):
    """Texts at every distance from a few originals, copies, shared passages, short ones."""
    r = random.Random(seed)
    originals = [brute.prose(100 + i, r.choice([6, 12, 40, 150, 400])) for i in range(8)]
    passage = brute.prose(77, 60)
    rows = []
    for i in range(n):
        w = r.choice(originals).split(" ")
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5, 8])):
            w[r.randrange(len(w))] = f"new{r.randrange(5000)}"
        text = " ".join(w)
        rows.append((i, r.choice([text, text, text.upper(), passage + " " + text, brute.prose(1000 + i, 50) + " " + passage])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_against_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HEAVY_SAMPLE", 2)  # some tokens do count as frequent
    if seed == 2:
        monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
    rows = near_rows(seed) + [(d, t) for d, t, *_ in brute.tricky_rows()]
    rows = [(d if d is None else d + 7, t) for d, t in rows]
    docs = brute.clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    got = jaccard_of(jaccard_join.jaccard_groups(docs))
    assert got == sorted((str(d), n, str(c)) for d, n, c in brute.jaccard_components(rows))


def test_jaccard_chain_needs_opened_groups(spark, monkeypatch):
    """Without key buckets every link must come through the matrix."""
    monkeypatch.setattr(jaccard_join, "band_keys", lambda tokens: [int(tokens[0] >> np.uint64(1))])
    w = [f"a{i}" for i in range(100)]
    rows = [(i, " ".join(w[3 * i:] + [f"b{j}" for j in range(3 * i)])) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert jaccard_of(jaccard_join.jaccard_groups(docs)) == sorted((str(d), n, str(c)) for d, n, c in brute.jaccard_components(rows))


def test_jaccard_real_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert jaccard_of(queries.op7_jaccard_join(spark, SF)) == sorted((str(d), n, str(c)) for d, n, c in brute.jaccard_components(rows))


def test_jaccard_threshold_is_exact(spark):
    """Four of five shingles shared: linked; a little less: not."""
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h i"), (3, "q r s t u v w x y z"), (4, "q r s t u v w x k l")]
    assert jaccard_of(jaccard_join.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"))) == [
        ("1", 4, "1"), ("2", 5, "1"), ("3", 6, "3"), ("4", 6, "4")]


def test_jaccard_filter_and_empty(spark):
    docs = brute.clashing(brute.tricky(spark))
    kept = jaccard_join.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    want = [(d, n) for d, n, c in brute.jaccard_components([(d, t) for d, t, *_ in brute.tricky_rows()]) if d == c]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted({str(d) for d, _ in want})
    assert jaccard_join.jaccard_groups(brute.empty(spark)).count() == 0


def test_jaccard_one_row_stays_whatever_the_ids(spark):
    base = brute.prose(41, 150)
    near = [base + f" end{i}" for i in range(3)]
    for ids in ([1, 1, 1], [None, None, None], [None, 4, 4]):
        rows = [*zip(ids, near, strict=True), (ids[0], near[0]), (8, brute.prose(42, 150)), (8, ""), (8, None)]
        kept = jaccard_join.keep_one_per_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        alike = [r["doc_id"] for r in kept if (r["text"] or "").startswith(base)]
        assert alike == [max(ids, key=lambda d: d is not None)]
        assert len(kept) == 4


@pytest.mark.parametrize("first, growth", [(1, 2), (2, 3)])
def test_jaccard_rounds_lose_no_link(spark, monkeypatch, first, growth):
    """Groups that meet through few of their members, in rounds of few members."""
    monkeypatch.setattr(jaccard_join, "band_keys", lambda tokens: [int(tokens[0] >> np.uint64(1))])
    monkeypatch.setattr(jaccard_join, "FIRST_OPENED", first)
    monkeypatch.setattr(jaccard_join, "GROWTH", growth)
    start = " ".join(f"c{i}" for i in range(9))
    w = [f"a{i}" for i in range(100)]
    rows = [(i, " ".join(w[i:] + [f"b{j}" for j in range(i)])) for i in range(40)]
    rows += [(100 + i, start + " " + " ".join(w[i % 7:] + [f"d{i % 3}"] * (i % 5))) for i in range(40)]
    rows += near_rows(5)
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    want = brute.jaccard_components([(i, t) for i, (_, t) in enumerate(rows)])
    assert jaccard_of(jaccard_join.jaccard_groups(docs)) == sorted((str(d), n, str(c)) for d, n, c in want)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 150)] + [(201, 200), (200, 200)]
    got = defaultdict(set)
    for r in jaccard_join.components(spark.createDataFrame(edges, "a long, b long")).collect():
        got[r["label"]].add(r["node"])
    assert sorted(map(sorted, got.values())) == [list(range(61)), list(range(100, 150)), [200, 201]]


def test_prefix_and_packing_of_tokens():
    for n in range(1, 300):
        for m in range(n, 300):
            need = -(-80 * (n + m) // 180)  # least overlap of sets that link
            if need <= n:
                assert n - need + 1 <= jaccard_join.prefix_length(n) and m - need + 1 <= jaccard_join.prefix_length(m)
    s = jaccard_join.shingles(brute.prose(3, 500).encode())
    assert (jaccard_join.unpack(jaccard_join.pack(s)) == s.view(np.int64)).all()


# --- packing ---------------------------------------------------------------------------------

def test_encoder(tokenizer):
    encode = packing.Encoder(TOKENIZER, limit=50)
    r = random.Random(4)
    texts = ["", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a \n b", "x \n ", "\n x", "a  b", "it's 'll we'll", "<|endoftext|>", "　 x"]
    texts += ["".join(r.choice("ab' \n\té1. ") for _ in range(40)) for _ in range(3000)] + [brute.prose(i, 200) for i in range(30)]
    for t, e in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert encode(t) == np.array(e.ids, dtype="<u4").tobytes(), t


def test_packing_follows_the_unflagged_tokenizer(spark):
    """A text that holds the literal of an added token gets that token's id."""
    plain = Tokenizer.from_file(TOKENIZER)
    texts = ["alpha <|endoftext|> beta", "<|endoftext|>", "a b<|endoftext|><|endoftext|> c", "<|endoftext |> d", "e f", brute.prose(5, 3000) + "<|endoftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check_packed(packing.best_fit_pack(docs, TOKENIZER).collect(), {i: [t] for i, t in enumerate(texts)}, plain)
    encode, r = packing.encoder(TOKENIZER), random.Random(9)
    for _ in range(500):
        t = "".join(r.choice(["<|endoftext|>", "<|endof", "text|>", " ", "a", "\n", "é"]) for _ in range(12))
        assert encode(t) == np.array(plain.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes(), t


def test_fill_is_fullest():
    r = random.Random(6)
    for _ in range(300):
        available = Counter(r.randrange(1, 30) for _ in range(r.randrange(0, 9)))
        slack = r.randrange(0, 60)
        sums = {0}
        for x, n in available.items():
            for _ in range(n):
                sums |= {s + x for s in sums}
        got = packing.fill(dict(available), slack)
        assert sum(got) == max(s for s in sums if s <= slack)
        assert not Counter(got) - available


def test_bins():
    r = np.random.default_rng(1)
    lengths = np.minimum(r.geometric(1 / 400, 5000), 2048)
    bins, offsets = packing.min_slack_bins(lengths, 2048)
    check_bins(bins, offsets, lengths)
    assert bins.max() + 1 <= math.ceil(lengths.sum() / 2048) + 2


def check_bins(bins, offsets, lengths):
    rows = defaultdict(list)
    for b, o, n in zip(bins, offsets, lengths, strict=True):
        rows[b].append((o, n))
    for pieces in rows.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= 2048
    return len(rows)


def check_packed(rows, texts, tokenizer):
    """Every token of every document once, in pieces as agreed; bins gapless."""
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    for doc_id, doc_texts in texts.items():
        want = []
        for t in doc_texts:
            ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
            first = len(ids) % 2048 or 2048
            cuts = [0, *range(first, len(ids), 2048), len(ids)]
            want += [(i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
        assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[doc_id]) == sorted(want)
    n = check_bins([r["sequence_id"] for r in rows], [r["offset"] for r in rows], [r["length"] for r in rows])
    return n, sum(r["length"] for r in rows) / 2048


def test_packing(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "POOL", 8)
    docs = brute.clashing(brute.tricky(spark))
    rows = packing.best_fit_pack(docs, TOKENIZER, with_ids=True)
    texts = defaultdict(list)
    for d, t, *_ in brute.tricky_rows():
        texts[d].append(t)
    check_packed(rows.collect(), texts, tokenizer)
    for r in packing.sequences(rows).collect():
        assert len(r["ids"]) == 4 * r["length"] <= 4 * 2048
    assert packing.best_fit_pack(brute.empty(spark), TOKENIZER).count() == 0


def test_encoder_of_marks_and_line_breaks():
    """Cached parts against whole texts, with a cache that turns over."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(TOKENIZER)
    ids_of = packing.Encoder(TOKENIZER, 50, literal=False)
    pieces = ["a", "B", "\u00e9", "1", "'s", "'", "\n", " ", "\t", ".", ",", "!", "?:", "\u00a0", "\u3000", "\x1c", "\x85", "\u6f22", "-", "\r", "the"]
    rng = np.random.default_rng(7)
    for n in rng.integers(0, 16, 4000):
        text = "".join(rng.choice(pieces, n))
        assert ids_of(text) == np.array(plain.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes(), repr(text)


def test_packing_query(spark, tokenizer):
    texts = {r["doc_id"]: [r["text"]] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    bins, least = check_packed(queries.op9_best_fit_packing(spark, SF).collect(), texts, tokenizer)
    assert bins <= math.ceil(least) + 1


# --- language model --------------------------------------------------------------------------

def check_lm(got, rows):
    want = sorted(brute.unigram(rows), key=lambda r: (str(r[0]), r[2]))
    got = sorted(got, key=lambda r: (str(r["doc_id"]), r["n_tokens"]))
    for r, (d, _, n, known, total, base) in zip(got, want, strict=True):
        assert (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (d, n, known, total)
        assert r["base_score"] == pytest.approx(base, abs=1e-6)
        assert math.isfinite(r["score"]) and r["score"] <= 1e-9


@pytest.mark.parametrize("known", [200_000, 30, 0])
def test_language_model_against_brute_force(spark, known):
    rows = [(d, t) for d, t, *_ in brute.tricky_rows()] + [(50 + i, brute.prose(i % 7, 30)) for i in range(40)]
    docs = brute.clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    model = class_lm.train(docs.filter(class_lm.remainder(F.col("doc_id"), 7) != 2), clustered=min(known, 20), classes=4, known=known)
    check_lm(class_lm.score(docs, model).collect(), rows)


def test_language_model_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op10_class_lm(spark, SF).collect()
    check_lm(got, rows)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)  # classes help


def test_language_model_is_a_distribution(spark):
    """Over all words, known and one unseen, next-token probabilities sum to one at most."""
    rows = [(i, brute.prose(i, 60)) for i in range(20)]
    model = class_lm.train(spark.createDataFrame(rows, "doc_id long, text string"), clustered=10, classes=3)
    assert np.allclose((10 ** model.transition).sum(axis=1), 1)
    mass = Counter()
    for n, c in zip(model.known_counts, model.known_class, strict=True):
        mass[c] += n / model.class_total[c] if c < 3 else (n + 1) / model.open_mass
    mass[3] += 1 / model.open_mass
    assert all(x == pytest.approx(1) for x in mass.values())


@pytest.mark.parametrize("known", [10_000, 25])
def test_every_training_word_has_a_class(spark, known):
    """Words beyond the core too; transitions are those of all tokens in their classes, joined or not."""
    rows = [(i, brute.prose(i % 9, 60)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = class_lm.train(docs, clustered=10, classes=3, known=known)
    cls = {bytes(r["word"]): r["cls"] for r in model.counts.collect()}
    texts = [class_lm.tokens(t.encode()) for _, t in rows]
    assert set(cls) == {w for t in texts for w in t} and set(cls.values()) == {0, 1, 2}
    g = np.zeros((5, 5))
    for t in texts:
        c = [4, *(cls[w] for w in t), 4]
        for a, b in zip(c, c[1:], strict=False):
            g[a, b] += 1
    assert (model.class_total == g.sum(axis=0)).all() and model.class_total[3] == 0
    count = Counter(w for t in texts for w in t)
    step = 10 ** model.transition
    for r in class_lm.score(docs, model).collect():
        c = [4, *(cls[w] for w in texts[r["doc_id"]]), 4]
        want = sum(math.log10(step[a, b]) for a, b in zip(c, c[1:], strict=False))
        want += sum(math.log10(count[w] / g[:, cls[w]].sum()) for w in texts[r["doc_id"]])
        assert r["score"] == pytest.approx(want)
    share = (g.sum(axis=0) + 1) / (g.sum() + 5)
    want = (1 - share[3]) * (g + class_lm.PULL * share / (1 - share[3])) / (g.sum(axis=1, keepdims=True) + class_lm.PULL)
    assert step[:, [0, 1, 2, 4]] == pytest.approx(want[:, [0, 1, 2, 4]])


@pytest.mark.parametrize("known", [10_000, 25, 12])
@pytest.mark.parametrize("events", [class_lm.EVENTS, 50])
def test_words_are_placed_by_all_their_contexts(spark, monkeypatch, known, events):
    """Against contexts counted plainly; words in slices or on their own, tasks that flush often, many tasks."""
    monkeypatch.setattr(class_lm, "EVENTS", events)
    monkeypatch.setattr(class_lm, "SLICES", 8)
    texts = [class_lm.tokens(brute.prose(i % 11, 50).encode()) for i in range(40)]
    count = Counter(w for t in texts for w in t)
    spelled = sorted(count, key=lambda w: (-count[w], w))[:known]
    cls = np.array([*(np.arange(10) % 3), 3, 4])
    class_of = dict(zip(spelled[:10], cls.tolist(), strict=False))
    before, after, g = defaultdict(lambda: np.zeros(5)), defaultdict(lambda: np.zeros(5)), np.zeros((5, 5))
    for t in texts:
        c = [4, *(class_of.get(w, 3) for w in t), 4]
        for i, w in enumerate(t):
            before[w][c[i]] += 1
            after[w][c[i + 2]] += 1
        for a, b in zip(c, c[1:], strict=False):
            g[a, b] += 1
    want = {w: class_of[w] if w in class_of else int(class_lm.place(g, before[w][None], after[w][None])[0]) for w in count}
    docs = spark.createDataFrame([(b" ".join(t).decode(),) for t in texts], "text string").repartition(5)
    words = spark.createDataFrame([(bytearray(w), n) for w, n in count.items()], "word binary, n long")
    got = class_lm._placed(words, class_lm.contexts(docs, spelled, 10, cls), spelled, 10, cls, g).collect()
    assert {bytes(r["word"]): r["cls"] for r in got} == want and len(got) == len(want)


def test_exchange_ends_where_no_move_helps():
    r = np.random.default_rng(3)
    b = r.poisson(r.gamma(0.3, 20, (14, 14)))

    def likelihood(cls):
        z = np.eye(5)[cls]
        g = z.T @ b @ z
        return sum(x * math.log(x) for x in g.ravel() if x) - sum(x * math.log(x) for m in (g.sum(0), g.sum(1)) for x in m if x)

    start = np.concatenate((np.arange(12) % 3, [3, 4]))
    cls = class_lm.exchange(b, classes=3, sweeps=50)
    assert cls[12:].tolist() == [3, 4]
    assert likelihood(cls) > likelihood(start)
    for w in range(12):
        for c in range(3):
            other = cls.copy()
            other[w] = c
            assert likelihood(other) <= likelihood(cls) + 1e-6


def test_language_model_empty(spark):
    model = class_lm.train(brute.empty(spark), known=10)
    assert (model.n, model.v) == (0, 0)
    rows = [(1, "a b"), (2, None)]
    got = class_lm.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"]) for r in got) == [(1, 3, 0, 0.0), (2, 1, 0, 0.0)]
    assert class_lm.score(brute.empty(spark), model).count() == 0


def test_words_follow_the_text_rule():
    for _, t, *_ in brute.tricky_rows():
        assert [w.decode() for w in class_lm.tokens((t or "").encode())] == re.findall(r"[^\x20\x09-\x0D]+", brute.lower(t))


def test_small_groups_are_compared_without_their_tokens(spark, monkeypatch):
    """Texts that share a long passage meet in many rows; no token of theirs is joined, and links are the same."""
    texts = [brute.prose(500, 60) + " " + brute.prose(i, 12 + i % 25) for i in range(58)]
    texts += [texts[3] + " and so on", texts[9] + " and more"]
    rows = {}
    write = jaccard_join.materialise

    def counted(df, name):
        out = write(df, name)
        rows[name] = rows.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard_join, "materialise", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_groups(docs).collect()}
    sets = [set(jaccard_join.shingles(t.encode()).tolist()) for t in texts]
    least = list(range(len(texts)))
    for _ in texts:
        for a, b in ((a, b) for a in range(60) for b in range(60) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])):
            least[a] = least[b] = min(least[a], least[b])
    assert got == dict(enumerate(least)) and 1 < len(set(least)) < 60
    assert max(Counter(least).values()) <= jaccard_join.FIRST_OPENED
    assert rows["jaccard-queries"] > 0 and rows["jaccard-tokens"] == 0


def test_sketches_never_rule_out_a_link(spark):
    r = np.random.default_rng(5)
    sets, pairs = [], []
    for i in range(200):
        n = int(r.integers(1, 900))
        common = r.integers(-2 ** 62, 2 ** 62, n)
        more = [r.integers(-2 ** 62, 2 ** 62, int(r.integers(0, 2 + n // (2 + i % 9)))) for _ in range(2)]
        sets += [np.unique(np.concatenate((common, x))) for x in more]
        pairs.append((2 * i, 2 * i + 1))
    pairs += [(i, i + 7) for i in range(0, 390, 10)]
    scanned = spark.createDataFrame([(i, bytearray(jaccard_join.pack(s))) for i, s in enumerate(sets)], "rid long, tokens binary")
    asked = spark.createDataFrame(pairs, "a long, b long")
    drawn = jaccard_join._sketches(scanned, asked.select("a").union(asked.select("b")).toDF("node"))
    left = {tuple(x) for x in jaccard_join.near_enough(asked, drawn).collect()}
    both = [(len(np.intersect1d(sets[a], sets[b])), len(np.union1d(sets[a], sets[b]))) for a, b in pairs]
    linked = {p for p, (x, y) in zip(pairs, both, strict=True) if 100 * x >= 80 * y}
    assert linked <= left and 20 < len(linked) < len(left) < len(pairs)


def test_sketches_tell_large_sets_apart(spark):
    """Sets of thousands of tokens: pairs that are far apart are ruled out by their sketches, links never."""
    r = np.random.default_rng(7)
    sets, linked = [], set()
    for i, n in enumerate([1000, 2000, 4000, 9000, 20000]):
        one = r.integers(-2 ** 62, 2 ** 62, n)
        near = np.concatenate((one[n // 20:], r.integers(-2 ** 62, 2 ** 62, n // 10)))  # drawn on more bits where n is 1000 or 2000
        far = np.concatenate((one[:n // 3], r.integers(-2 ** 62, 2 ** 62, n - n // 3)))
        sets += [one, near, far]
        linked.add((3 * i, 3 * i + 1))
    pairs = sorted(linked | {(a, a + 2) for a, _ in linked} | {(b, b + 1) for _, b in linked})
    scanned = spark.createDataFrame([(i, bytearray(jaccard_join.pack(s))) for i, s in enumerate(sets)], "rid long, tokens binary")
    asked = spark.createDataFrame(pairs, "a long, b long")
    drawn = jaccard_join._sketches(scanned, asked.select("a").union(asked.select("b")).toDF("node"))
    assert {tuple(x) for x in jaccard_join.near_enough(asked, drawn).collect()} == linked
    assert len({len(x) for x in map(jaccard_join.sketch, sets[:2])}) == 2  # of unequal widths


def test_near_copies_that_do_not_link_are_not_paired(spark, monkeypatch):
    """Many copies of one text, most with an edit too many to link: few rows and pairs, all links."""
    monkeypatch.setattr(jaccard_join, "HEAVY_SAMPLE", 1)
    base = [f"w{i}" for i in range(150)]
    edited = lambda i, n: [f"e{i}-{j}" if (j + i) % (150 // n) == 20 and j // (150 // n) < n else w for j, w in enumerate(base)]
    texts = [" ".join(x) for x in [*(edited(i, 3) for i in range(30)), base, *(edited(i, 5) for i in range(30, 110))]]
    rows = Counter()
    write = jaccard_join.materialise

    def counted(df, name):
        out = write(df, name)
        rows[name] += out.count()
        return out

    monkeypatch.setattr(jaccard_join, "materialise", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_groups(docs).collect()}
    want = brute.jaccard_components(list(enumerate(texts)))
    assert got == {d: c for d, _, c in want}
    assert sorted(Counter(got.values()).values())[-1] == 31 and len(set(got.values())) > 40
    assert rows["jaccard-meet"] < 400 and rows["jaccard-pairs"] < 800, rows
