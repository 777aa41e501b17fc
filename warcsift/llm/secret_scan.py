"""Operator 3: secret scans with a randomness test battery.

Base spans come from three fixed patterns. The method then takes every run of
20 or more encoding characters, infers its encoding, and tests whether its
symbols look drawn at random from that alphabet:

* chi-squared uniformity over the alphabet,
* Wald-Wolfowitz runs about the middle of the alphabet,
* lag-1 serial correlation of the symbol numbers,

combined by Fisher's method to one probability p (uniform for random tokens,
near 0 for words and identifiers). Length-aware false-discovery control: per
encoding and length band, the corpus histogram of p over *all* candidates
gives, for each cut-off, the share of accepted tokens in excess of what random
tokens alone would leave (less two standard deviations of that count); the
lowest cut-off whose excess is within ``max_false`` is used. That table has at most encodings x bands x bins rows.

Everything is built-in functions: positions come from the lengths of the gaps
between matches. Texts are read once; the narrow result of the scan is written
to the shared folder before the histogram is taken from it.

Defined results: null text counts as empty (no spans); repeated rows and ties
are scanned row by row; an empty table gives an empty result; other columns
are not read. A letters-only token is taken for a word, a digits-only token
for a number: neither has an encoding to test.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, materialise, text_of

_KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
_EITHER = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in k) for k in _KEYWORDS)

#: kind -> (pattern, group whose length counts, least length); in the listed order.
BASE = {
    "assign": (rf"({_EITHER})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),  # a shorter run holds no longer one
    "hex": (r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
}
METHOD_KIND = "random"
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"

_DIGITS, _LOW, _UP = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: encoding -> alphabet, tried in this order.
ENCODINGS = {
    "hex": _DIGITS + "abcdef", "HEX": _DIGITS + "ABCDEF", "base32": _UP + "234567",
    "base36": _DIGITS + _LOW, "BASE36": _DIGITS + _UP, "base62": _DIGITS + _UP + _LOW,
    "base64": _DIGITS + _UP + _LOW + "+/", "base64url": _DIGITS + _UP + _LOW + "-_",
}
BANDS = (20, 24, 32, 48, 96)
BINS, MAX_FALSE = 20, 0.1


def spans(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """``array<struct<start, end, token>>`` of leftmost non-overlapping matches
    whose ``group`` has ``least`` characters; code points, end exclusive."""
    found = lambda g: F.regexp_extract_all(text, F.lit(pattern), F.lit(g))
    empty = F.array().cast("array<struct<start:int,end:int,token:string,size:int>>")

    def placed(whole: Column) -> Column:
        parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("m"),
                             (whole if group == 0 else found(group)).alias("g"))
        walk = F.aggregate(
            F.slice(parts, 1, F.size(whole)),
            F.struct(F.lit(0).alias("at"), empty.alias("out")),
            lambda acc, x: let(acc["at"] + F.length(x["gap"]), lambda s: F.struct(
                (s + F.length(x["m"])).alias("at"),
                F.concat(acc["out"], F.array(F.struct(
                    s.alias("start"), (s + F.length(x["m"])).alias("end"), x["m"].alias("token"),
                    F.length(x["g"]).alias("size")))).alias("out"))))["out"]
        return F.when(F.size(whole) == 0, empty).otherwise(walk)

    return F.filter(let(found(0), placed), lambda s: s["size"] >= least)


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution (logistic form, within 0.0002)."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(1.5976) * z + F.lit(0.07056) * z * z * z))


def encoding_of(token: Column) -> Column:
    """The smallest fitting encoding; null for words, numbers and mixtures."""
    plain = token.rlike("^([A-Za-z/+_-]+|[0-9/+_-]+)$")
    first = F.coalesce(*[F.when(token.rlike(f"^[{a.replace('-', '')}{'-' * ('-' in a)}]+$"), F.lit(e))
                         for e, a in ENCODINGS.items()], F.lit(None).cast("string"))
    return F.when(~plain, first)


def battery(token: Column, encoding: Column) -> Column:
    """Probability that a random token of this encoding looks less random."""
    alphabet = F.coalesce(*[F.when(encoding == e, F.lit(a)) for e, a in ENCODINGS.items()], F.lit(""))
    k = F.length(alphabet).cast("double")

    def tests(x: Column) -> Column:
        n = F.size(x).cast("double")
        squares = F.aggregate(
            F.sequence(F.lit(1), F.length(alphabet)), F.lit(0.0),
            lambda acc, i: acc + F.pow(n - F.length(F.replace(token, F.substring(alphabet, i, F.lit(1)), F.lit(""))), F.lit(2)))
        df = k - 1
        chi = (k / n * squares - n) / df
        p_chi = _tail((F.cbrt(chi) - (1 - F.lit(2.0) / (9 * df))) / F.sqrt(F.lit(2.0) / (9 * df)))

        upper = F.transform(x, lambda v: (v * 2 >= k).cast("int"))
        ones = F.aggregate(upper, F.lit(0), lambda a, b: a + b).cast("double")
        turns = F.aggregate(F.zip_with(F.slice(upper, 1, F.size(x) - 1), F.slice(upper, 2, F.size(x) - 1),
                                       lambda a, b: (a != b).cast("int")), F.lit(0), lambda a, b: a + b)
        expect = 1 + 2 * ones * (n - ones) / n
        spread = (expect - 1) * (expect - 2) / (n - 1)
        p_runs = F.when(spread <= 0, F.lit(0.0)).otherwise(
            2 * _tail(F.abs(turns + 1 - expect) / F.sqrt(spread)))

        mean = F.aggregate(x, F.lit(0.0), lambda a, b: a + b) / n
        return let(mean, lambda mean: _combined(p_chi, p_runs, _serial(x, mean, n)))

    return let(F.transform(F.filter(F.split(token, ""), lambda c: c != ""),
                           lambda c: (F.instr(alphabet, c) - 1).cast("double")), tests)


def _serial(x: Column, mean: Column, n: Column) -> Column:
    d = F.transform(x, lambda v: v - mean)
    around = F.aggregate(d, F.lit(0.0), lambda a, b: a + b * b)
    lag = F.aggregate(F.zip_with(F.slice(d, 1, F.size(x) - 1), F.slice(d, 2, F.size(x) - 1),
                                 lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    return F.when(around <= 0, F.lit(0.0)).otherwise(2 * _tail(F.abs(lag) / around * F.sqrt(n)))


def _combined(*ps: Column) -> Column:
    logs = sum((-F.ln(F.greatest(p, F.lit(1e-300))) for p in ps), F.lit(0.0))
    return F.exp(-logs) * (1 + logs + logs * logs / 2)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id``, an array column of spans per base kind, and ``tested``: the
    candidates with encoding, length band and p."""
    text = text_of()

    def tested(tokens: Column) -> Column:
        named = F.filter(F.transform(tokens, lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["token"].alias("token"),
            encoding_of(s["token"]).alias("encoding"))), lambda s: s["encoding"].isNotNull())
        return F.transform(named, lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["encoding"].alias("encoding"),
            F.greatest(*[F.when(s["end"] - s["start"] >= b, F.lit(b)) for b in BANDS]).alias("band"),
            battery(s["token"], s["encoding"]).alias("p")))

    bounds = "array<struct<start:int,end:int>>"
    narrow = lambda found: F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return docs.select(
        "doc_id", *[narrow(spans(text, *rule)).cast(bounds).alias(kind) for kind, rule in BASE.items()],
        let(spans(text, CANDIDATE), tested).alias("tested"))


def cut_offs(scanned: DataFrame, max_false: float = MAX_FALSE) -> dict[tuple[str, int], float]:
    """Lowest p accepted, by (encoding, length band)."""
    c = F.explode("tested").alias("c")
    rows = (scanned.select(c).groupBy("c.encoding", "c.band", F.least(F.floor(F.col("c.p") * BINS), F.lit(BINS - 1)).alias("bin"))
            .agg(F.count("*").alias("n")).collect())  # encodings x bands x bins rows at most
    counts: dict[tuple[str, int], list[int]] = {}
    for r in rows:
        counts.setdefault((r["encoding"], r["band"]), [0] * BINS)[r["bin"]] += r["n"]
    out = {}
    for key, n in counts.items():
        per_bin = sum(n[BINS // 2:]) / (BINS - BINS // 2)
        above = [sum(n[j:]) for j in range(BINS)]
        excess = lambda j: (above[j] - per_bin * (BINS - j) - 2 * above[j] ** 0.5) / max(1, above[j])  # noqa: B023, E731
        out[key] = next((j for j in range(1, BINS // 2) if excess(j) <= max_false), BINS // 2) / BINS
    return out


def find_secrets(docs: DataFrame, max_false: float = MAX_FALSE) -> DataFrame:
    """``doc_id, spans``: every span (kind, start, end) by start, then kind as listed.

    A method span that lies within a base span repeats it and is left out.
    """
    scanned = materialise(scan(docs.select("doc_id", "text")), "secrets")
    limits = cut_offs(scanned, max_false)
    kinds = [*BASE, METHOD_KIND]
    limit = F.create_map(*[x for (e, b), p in sorted(limits.items()) for x in (F.lit(f"{e} {b}"), F.lit(p))]) \
        if limits else F.create_map(F.lit(""), F.lit(2.0))
    accepted = F.filter("tested", lambda t: t["p"] >= F.coalesce(
        F.element_at(limit, F.concat_ws(" ", t["encoding"], t["band"])), F.lit(2.0)))
    rows = lambda i, found: F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.lit(i).alias("rank"), s["end"].alias("end")))
    base = F.concat(*[rows(i, F.col(kind)) for i, kind in enumerate(BASE)])
    joined = let(base, lambda b: F.array_sort(F.concat(b, F.filter(
        rows(len(BASE), accepted),
        lambda t: ~F.exists(b, lambda s: (s["start"] <= t["start"]) & (s["end"] >= t["end"]))))))
    name = F.array(*[F.lit(k) for k in kinds])
    return scanned.select("doc_id", F.transform(joined, lambda s: F.struct(
        F.get(name, s["rank"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def mask(docs: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with every span of ``found`` in ``text`` replaced by ``[SECRET]``.

    ``key`` identifies a row; spans that overlap are replaced as one.
    """
    merged = F.aggregate("spans", F.array().cast("array<struct<start:int,end:int>>"), lambda acc, s: F.when(
        (F.size(acc) > 0) & (s["start"] <= F.element_at(acc, -1)["end"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["start"].alias("start"),
            F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"))))).otherwise(
        F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))))
    clean = F.aggregate(
        merged, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(s["end"].alias("at"), F.concat(
            acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]),
            F.lit("[SECRET]")).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    own = found.select(F.col(key).alias("_secret_key"), "spans")
    return docs.join(own, docs[key] == F.col("_secret_key"), "left").withColumn(
        "text", F.when(F.size("spans") > 0, clean).otherwise(F.col("text"))).select(*docs.columns)
