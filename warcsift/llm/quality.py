"""Operator 8: quality rules as one threshold table in one projection.

``with_quality`` compiles the measures and the whole rule table into a struct of built-in functions; nothing is shuffled and no
user function runs. All ratios are compared as ``100 * numerator`` against
``percent * denominator`` in whole numbers, so results do not depend on
rounding.

Defined results: null or empty text has no words and fails the base rule;
ties and repeated rows are judged row by row; an empty table gives an empty
result; other columns, whatever their names, are neither read nor changed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, fresh, let, text_of, without, words

#: Common function words of English, German, French and Spanish (fixed values).
STOP_WORDS = (
    "a", "al", "an", "and", "are", "as", "at", "au", "auf", "aux", "avec", "be", "by",
    "con", "dans", "das", "de", "del", "dem", "den", "der", "des", "die", "du",
    "ein", "eine", "el", "en", "er", "es", "est", "et", "for", "from", "für",
    "he", "im", "in", "is", "ist", "it", "la", "las", "le", "les", "los", "mit",
    "no", "of", "on", "or", "ou", "par", "para", "pas", "por", "pour", "que", "qui",
    "se", "she", "sich", "su", "sur", "that", "the", "this", "to", "un", "una", "und", "une",
    "von", "was", "with", "y", "zu",
)
SYMBOLS, MARKS = "#*$%&|<>", "!?"


@dataclass(frozen=True)
class Rule:
    """``at_least``/``at_most`` per cent of ``measure`` in ``of``."""

    measure: str
    of: str
    at_least: int | None = None
    at_most: int | None = None


#: The threshold table.
RULES = (
    Rule("word_chars", "n_words", at_least=150, at_most=2500),   # mean word length 1.5 to 25
    Rule("n_symbols", "n_words", at_most=30),
    Rule("n_marks", "n_words", at_most=50),                      # exclamation and question marks
    Rule("n_stop", "n_words", at_least=3),
    Rule("n_dup_lines", "n_lines", at_most=60),
)
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def _bits(w: Column) -> Column:
    return F.length(F.bin(F.size(w).cast("long")))


def _keys(w: Column) -> Column:
    """A sorted key for each 3-word window: its hash above, its place below."""
    n = F.size(w) - 2

    def packed(b: Column) -> Column:
        pairs = F.zip_with(F.slice(w, 1, n), F.slice(w, 2, n), lambda x, y: F.xxhash64(x, y))
        hashes = F.zip_with(pairs, F.slice(w, 3, n), lambda h, z: F.xxhash64(h, z))
        return F.transform(hashes, lambda h, i: F.coalesce(
            F.call_function("shiftleft", h, b).bitwiseOR(i.cast("long")), F.lit(0).cast("long")))

    return F.when(n < 2, F.array().cast("array<bigint>")).otherwise(let(_bits(w), packed))


def _repeat_words(w: Column, keys: Column) -> Column:
    """Words lying in a 3-word window that occurs at least twice.

    Windows with equal keys stand side by side in ``keys``; their words are
    compared too, so a hash clash marks nothing.
    """

    def count(b: Column) -> Column:
        place = lambda k: k.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), b) - 1).cast("int")
        word = lambda k, j: F.get(w, place(k) + j)
        shift = lambda k: F.call_function("shiftright", k, b)
        same = F.zip_with(F.slice(keys, 1, F.size(keys) - 1), F.slice(keys, 2, F.size(keys) - 1),
                          lambda x, y: (shift(x) == shift(y)) & (word(x, 0) == word(y, 0))
                          & (word(x, 1) == word(y, 1)) & (word(x, 2) == word(y, 2)))

        def cover(e: Column) -> Column:
            marked = F.filter(keys, lambda k, i: F.coalesce(F.get(e, i), F.lit(False))
                              | F.coalesce(F.get(e, i - 1), F.lit(False)))
            start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
            add = lambda acc, i: F.struct(
                (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last"))
            return F.when(~F.exists(e, lambda x: x), F.lit(0)).otherwise(
                F.aggregate(F.array_sort(F.transform(marked, place)), start, add)["n"])

        return let(same, cover)

    return F.when(F.size(keys) < 2, F.lit(0)).otherwise(let(_bits(w), count))


def _stop_words(w: Column, stop_words) -> Column:
    """Words in the list once lower-cased and freed of full stops and commas."""
    bare = F.split(without(F.lower(F.array_join(w, " ")), ".,"), " ")
    return F.size(F.filter(bare, lambda x: x.isin(*stop_words)))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_marks", "n_lines", "n_dup_lines",
            "n_repeat_words", "n_stop")


def _measures(text: Column, w: Column, keys: Column, stop_words) -> Column:
    """Struct of every measure, all bigint."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    count = lambda chars: F.length(text) - F.length(without(text, chars))
    values = lambda w, keys, ls: (
        F.size(w), F.length(F.array_join(w, "")), count(SYMBOLS), count(MARKS), F.size(ls),
        F.size(ls) - F.size(F.array_distinct(ls)), _repeat_words(w, keys), _stop_words(w, stop_words))
    return let(w, lambda w: let(keys, lambda keys: let(lines, lambda ls: F.struct(
        *[v.cast("long").alias(name) for name, v in zip(MEASURES, values(w, keys, ls), strict=True)]))))


def _judged(m: Column, rules) -> Column:
    base = (m["n_words"] < MIN_WORDS) | (m["n_repeat_words"] * 100 > m["n_words"] * MAX_REPEAT_PERCENT)
    good = ~base
    for r in rules:
        if r.at_least is not None:
            good = good & (m[r.measure] * 100 >= m[r.of] * r.at_least)
        if r.at_most is not None:
            good = good & (m[r.measure] * 100 <= m[r.of] * r.at_most)
    return F.struct(*[m[x].alias(x) for x in MEASURES], base.alias("base_failed"), good.alias("kept"))


def with_quality(docs: DataFrame, out: str, rules=RULES, stop_words=STOP_WORDS) -> DataFrame:
    """``docs`` with a struct column ``out``: every measure, ``base_failed``, ``kept``.

    The words and the sorted window keys are columns of their own on the way,
    so that each is made once and the keys are sorted as plain longs.
    """
    w, keys = fresh(docs, "quality_words", "quality_keys")
    return (docs.withColumn(w, words(text_of()))
            .withColumn(keys, F.sort_array(_keys(F.col(w))))
            .withColumn(out, let(_measures(text_of(), F.col(w), F.col(keys), stop_words),
                                 lambda m: _judged(m, rules)))
            .drop(w, keys))


def score_quality(docs: DataFrame, rules=RULES) -> DataFrame:
    """One row per document: ``doc_id``, every measure, ``base_failed``, ``kept``."""
    return with_quality(docs.select("doc_id", "text"), "q", rules).select("doc_id", "q.*")


def keep_good(docs: DataFrame, rules=RULES) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they were.

    The verdict selects rows through a generator: a filter would be pushed
    below the intermediate columns and repeat their expressions.
    """
    q, once = fresh(docs, "quality_struct", "quality_once")
    return (with_quality(docs, q, rules)
            .withColumn(once, F.explode(F.array_repeat(F.lit(True), F.col(q)["kept"].cast("int"))))
            .drop(q, once))
