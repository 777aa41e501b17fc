"""Source divergence audit: shares, pairs, top terms, clashing digests."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from warcsift.llm import divergence, queries
from warcsift.llm.sql import ORACLES

from . import brute

SF = "/root/testdata/sf0.01"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(brute.lower(text))


def brute_rows(rows, min_docs=30, top=50):
    """rows: (text, lang, source)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    docs, count, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        found = terms(text)
        docs[lang].update(set(found))
        count[lang, source].update(found)
        sources[lang].add(source)
    out = []
    for lang, own in sources.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v = len(kept)

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * v) for t in kept}

        q = shares(sum((count[lang, s] for s in own), Counter()))
        p = {s: shares(count[lang, s]) for s in own}
        for s in own:
            pair = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in own if o != s]
            term = [(q[t] - p[s][t], t.encode(), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", x[2], -x[0], i + 1) for i, x in enumerate(sorted(pair))]
            out += [(lang, s, "term", x[2], -x[0], i + 1) for i, x in enumerate(sorted(term)[:top])]
    return Counter(out)


def got(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return Counter(tuple(r) for r in df.collect())


def check(docs, min_docs, **kw):
    rows = [tuple(r) for r in docs.select("text", "lang", "source").collect()]
    assert got(divergence.divergence(docs, min_docs, **kw)) == brute_rows(rows, min_docs, kw.get("top", 50))


def test_terms():
    text = "A-Z Éa9b_c\x7fÜ 漢字\x00ß  \x85x\xa0"
    assert [t.decode() for t in divergence.terms(text.encode())] == terms(text)


@pytest.mark.parametrize("min_docs", [1, 2, 30])
def test_tricky_rows(spark, min_docs):
    check(brute.tricky(spark), min_docs)


def test_clashing_columns(spark):
    docs = brute.clashing(brute.tricky(spark).withColumnRenamed("n_chars", "digest"))
    check(docs, 2)


def test_empty_table(spark):
    assert not got(divergence.divergence(brute.empty(spark)))


def test_given_documents_and_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_rows([tuple(r) for r in docs.select("text", "lang", "source").collect()])
    assert got(queries.QUERIES["op13_source_divergence"](spark, SF)) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    assert Counter(con.execute(ORACLES["op13_source_divergence"]).fetchall()) == want


def made(spark, seed, n, sources):
    r = random.Random(seed)
    rows = [(i, " ".join(f"{r.choice('abcdef')}{'x' * r.randint(0, 3)}" for _ in range(r.randint(0, 30))),
             r.choice(["en", "de"]), f"s{r.randrange(sources)}", 0) for i in range(n)]
    return spark.createDataFrame(rows, brute.DOCS)


def test_clashing_digests_are_split(spark):
    check(made(spark, 1, 150, 4), 5, hash_bits=3)
    check(made(spark, 2, 60, 3), 8, hash_bits=1)


def test_blocks_of_sources_and_small_buffers(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SOURCE_BLOCK", 4)
    monkeypatch.setattr(divergence, "HELD_BLOCKS", 2)
    monkeypatch.setattr(divergence, "HELD_TERMS", 10)
    check(made(spark, 3, 200, 11), 3, top=3)


def test_shuffle_of_digests(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BROADCAST_ROWS", 0)
    check(made(spark, 4, 100, 3), 3)
