"""Embedding whitening: exact sums, covariance, projection."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from warcsift.llm import queries, whitening

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """n, deviations, V, eigenvalues, eigenvectors, from plain whole numbers."""
    kept = [(i, [int(np.floor(np.float64(c) * 64)) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    n, d = len(kept), len(kept[0][1])
    s = [sum(x[j] for _, x in kept) for j in range(d)]
    z = np.array([[n * x[j] - s[j] for j in range(d)] for _, x in kept], dtype=object)
    v = np.array([[float(Fraction(int((z[:, i] * z[:, j]).sum()), n ** 3)) for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(v)
    return n, [(i, int((r ** 2).sum())) for (i, _), r in zip(kept, z)], z.astype(float) / n, v, e[::-1], u.T[::-1]


def check(df, k=32):
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    n, deviation, centred, v, e, u = brute(rows)
    got = whitening.whiten(df).collect()
    k = min(k, int((e > e[0] * len(e) * 2e-15).sum()))
    assert len(got) == n * k
    by_row = {}
    for r in got:
        assert r["n"] == n and r["identity_error"] <= 1e-4
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / np.trace(v), rel=1e-6)
        by_row.setdefault(r["vec_id"], {})[r["component"]] = r
    want = centred @ (u[:k] / np.sqrt(e[:k])[:, None]).T
    sign = None
    for (i, dev), w in zip(deviation, want):
        assert {r["deviation"] for r in by_row[i].values()} == {dev}
        have = np.array([by_row[i][c + 1]["whitened"] for c in range(k)])
        if sign is None and (np.abs(w) > 1e-6).all():
            sign = np.sign(have) * np.sign(w)
        if sign is not None:
            assert have * sign == pytest.approx(w, rel=1e-6, abs=1e-6)
    assert sign is not None


def test_given_embeddings(spark):
    check(spark.read.parquet(f"{SF}/embeddings.parquet"))
    assert queries.QUERIES["op12_whitening"](spark, SF).count() == 500 * 32


def test_nulls_lengths_clashing_columns(spark):
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.normal(size=5)], 1) for i in range(40)]
    bad = [(90, None, 1), (91, [1.0, None, 2.0, 3.0, 4.0], 1), (92, [1.0, float("nan"), 2.0, 3.0, 4.0], None),
           (93, [float("inf"), 0.0, 0.0, 0.0, 0.0], 1), (94, [], 1), (95, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows + bad, SCHEMA)
    check(df.filter("vec_id < 90"))
    for out in (whitening.whiten(df), whitening.whiten(df.withColumns({c: F.lit(0) for c in ("v", "n", "d", "component", "item")}))):
        assert out.count() == 40 * 5 and {r["vec_id"] for r in out.collect()} == set(range(40))
    again = spark.createDataFrame([*rows, rows[0], (None, rows[1][1], 1)], SCHEMA)
    got = whitening.whiten(again).groupBy("vec_id").count().collect()
    assert {r["vec_id"]: r["count"] for r in got} == {**{i: 5 for i in range(1, 40)}, 0: 10, None: 5}


def test_empty_constant_and_lone(spark):
    for rows in ([], [(1, [1.0, 2.0], 0)], [(i, [1.0, 2.0], 0) for i in range(5)], [(1, [], 0)], [(1, None, 0)]):
        out = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
        assert out.count() == 0 and out.columns[0] == "vec_id"


def test_dependent_dimensions_are_left_out(spark):
    r = np.random.default_rng(4)
    rows = [(i, [float(a), float(b), float(a), 7.0], 1) for i, (a, b) in enumerate(r.integers(-9, 9, size=(60, 2)))]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {x["component"] for x in out} == {1, 2} and max(x["identity_error"] for x in out) < 1e-9


def test_huge_entries_are_exact(spark):
    """Squares beyond 64 bits, and a deviation that no long holds."""
    r = np.random.default_rng(6)
    rows = [(i, [float(x) for x in r.normal(size=3) * 1e15], 1) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    n, deviation, _, v, e, _ = brute([x[:2] for x in rows])
    found = whitening.fit(whitening.vectors(df))
    assert found.values == pytest.approx(e, rel=1e-12) and found.n == n
    out = whitening.whiten(df).collect()
    assert min(x for _, x in deviation) >= 1 << 63 and {x["deviation"] for x in out} == {None}
    beyond = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(beyond).count() == 3  # the second is lost in rounding


def test_sums_do_not_depend_on_partitions(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = whitening.vectors(df)
    n, sums = whitening.moments(rows, 64)
    assert (n, sums) == whitening.moments(rows.repartition(13), 64)
    means = [s // n for s in sums]
    assert whitening.pair_squares(rows, means) == whitening.pair_squares(rows.repartition(13), means)
