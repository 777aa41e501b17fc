"""The five stages against a brute-force version, and on tricky rows."""

from collections import Counter, defaultdict

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from warcsift.llm import quality

from . import brute
from .test_models import check_bins

SF = "/root/testdata/sf0.001"


def survivors(rows, good):
    """{doc_id: (text, source)} after rules, exact dedup and near dedup."""
    kept = [r for r in rows if r[0] in good]
    by_text = {}
    for doc_id, text, source in kept:
        by_text[text] = max(by_text.get(text, (doc_id, source)), (doc_id, source))
    once = [(d, t) for t, (d, _) in by_text.items()]
    first = {d for d, _, c in brute.jaccard_components(once) if d == c}
    return {d: (t, s) for t, (d, s) in by_text.items() if d in first}


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r["doc_id"] for r in quality.score_quality(docs).filter("kept").collect()}
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    want = survivors(rows, good)
    got = corpus_pipeline.run(spark, SF).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    size = {d: len(brute.words(t)) for d, (t, _) in want.items()}
    pieces = defaultdict(Counter)
    for r in got:
        pieces[r["doc_id"]][(r["piece"], r["start"], r["length"], r["ids_crc32"])] += 1
    assert set(pieces) <= set(want)
    taken, total = Counter(), defaultdict(int)
    for d, (t, s) in want.items():
        total[s] += size[d]
        n = len(tokenizer.encode(t, add_special_tokens=False).ids) + 1
        assert len(set(pieces[d].values())) <= 1                    # all pieces equally often
        times = max(pieces[d].values(), default=0)
        assert times <= 2 and (not times or sum(x[2] for x in pieces[d]) == n)
        taken[s] += times * size[d]
    for s, goal in brute.targets(dict(total)).items():
        assert abs(taken[s] - goal) <= max(size[d] for d, (_, x) in want.items() if x == s)
    check_bins([r["sequence_id"] for r in got], [r["offset"] for r in got], [r["length"] for r in got])


def test_stages_keep_the_columns(spark):
    for docs in (brute.clashing(brute.tricky(spark)), brute.empty(spark)):
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == columns
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        texts = {r["text"] for r in docs.collect()}
        assert (packed.count() > 0) == bool(texts)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "n-gram Jaccard join", "mixing", "best-fit packing"]


def test_near_copies_leave_one_each(spark):
    base = brute.prose(31, 200)
    rows = [(i, base.replace(" ", " ", 1) + (" end" if i else ""), "s", "x", 1) for i in range(4)] + [(9, brute.prose(32, 200), "s", "x", 1)]
    docs = spark.createDataFrame(rows, brute.DOCS)
    kept = corpus_pipeline.near_copies(spark, corpus_pipeline.exact_copies(spark, docs, SF), SF)
    assert sorted(r["doc_id"] for r in kept.select("doc_id", F.lit(1)).collect()) == [0, 9]
