"""Character-trigram language profile (training) and detection (inference).

Text is lower-cased and split into words at every run of non-letters; each
word is framed by blanks and contributes all its 3-character windows (so
``' ab '`` gives ``' ab'`` and ``'ab '``; no gram crosses a word boundary).
The whole text is used, never a prefix. Training counts grams per language;
the weight of a gram is ``ln(n / total_lang) - ln(floor)``, a naive-Bayes log
likelihood measured against a floor probability for unseen grams, so grams a
language never saw add 0. Detection sums the weights of a text's grams per
language and takes the arg-max (ties -> smallest code). A text without grams
gets no language.

Words are counted before grams are made, so a repeated word is expanded
once per task (map-side partial aggregation), not once per occurrence.
Detection is a broadcast hash join of the grams with the profile followed by
an aggregate on the record key; when the input is already hash partitioned
on the key (the pipeline arranges this), neither the word count, the
aggregate nor the join back needs another exchange.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

DEFAULT_FLOOR = 1e-6
# Profiles up to this many (lang, gram) rows (~80 MB) are broadcast; beyond
# it the gram side is shuffle-joined instead (AQE's skew-join handling then
# splits hot grams such as " th").
MAX_BROADCAST_ROWS = 2_000_000
GRAM_RX = "(?=([^\\x{DC00}-\\x{DFFF}].{2}))"


def words(text: Column) -> Column:
    """Lower-cased letter runs of a text (may contain one '' for no letters)."""
    return F.split(F.trim(F.regexp_replace(F.lower(text), "[^\\p{L}]+", " ")), " ")


def word_grams(word: Column) -> Column:
    """All 3-character windows of ``' ' + word + ' '``, in one linear regex pass.

    A look-ahead match at each character; a window never starts on the second
    half of a surrogate pair. (Position-based substring would rescan the UTF-8
    text for every gram.)
    """
    return F.regexp_extract_all(F.concat(F.lit(" "), word, F.lit(" ")),
                                F.lit(GRAM_RX), F.lit(1))


def word_counts(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """(keep..., word, c): occurrences of each word per group of ``keep``."""
    w = df.select(*keep, F.explode(words(F.col(text_col))).alias("word"))
    return w.where(F.col("word") != "").groupBy(*keep, "word").agg(
        F.count(F.lit(1)).alias("c"))


def explode_grams(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """(keep..., gram, c): gram occurrences, weighted by word count ``c``."""
    wc = word_counts(df, text_col, keep)
    return wc.select(*keep, "c", F.explode(word_grams(F.col("word"))).alias("gram"))


def train_profile(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                  floor: float = DEFAULT_FLOOR) -> DataFrame:
    """(lang, gram, n, w) from labelled texts."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    grams = explode_grams(labelled.withColumnRenamed(lang_col, "lang"), text_col, ["lang"])
    counts = grams.groupBy("lang", "gram").agg(F.sum("c").alias("n"))
    # Totals as a second, partially aggregated sum (one row per language) joined
    # back by broadcast: a window, or a shuffle by language, would bring all gram
    # rows of a language to one task. Both branches read the same exchange of
    # ``counts``.
    totals = counts.groupBy("lang").agg(F.sum("n").alias("_total"))
    return counts.join(F.broadcast(totals), "lang").select(
        "lang", "gram", "n",
        (F.log(F.col("n")) - F.log(F.col("_total")) - F.lit(math.log(floor))).alias("w"))


def save_profile(profile: DataFrame, url: str, mode: str = "overwrite") -> None:
    """Store a trained profile as a Parquet model artifact."""
    profile.select("lang", "gram", "n", "w").write.mode(mode).parquet(url)


def load_profile(spark, url: str) -> DataFrame:
    """Read a stored profile (fixed schema, no inference)."""
    from ..schemas import LANG_PROFILE
    return spark.read.schema(LANG_PROFILE).parquet(url)


def broadcast_if_bounded(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only after checking its row count against ``max_rows``."""
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df


def detect_language(df: DataFrame, keys: list[str], text_col: str,
                    profile: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_ROWS
                    ) -> DataFrame:
    """(keys..., language) for every row of ``df`` that has at least one known gram.

    Scores are summed per key and language (hash aggregate), pivoted into one
    fixed-width column per profile language (hash aggregate again, no sort),
    and the arg-max is taken inside the row: highest score, then smallest code.
    The language list (one entry per language) comes from the profile.
    """
    # One global aggregate (the same single job a row count needs) gives the
    # profile size and its language set (one entry per language).
    st = profile.agg(F.count(F.lit(1)).alias("n"),
                     F.array_sort(F.collect_set("lang")).alias("langs")).collect()[0]
    langs, rows = list(st["langs"]), st["n"]
    grams = explode_grams(df.where(F.col(text_col).isNotNull()), text_col, keys)
    prof = profile.select("gram", "lang", "w")
    prof = F.broadcast(prof) if rows <= max_broadcast_rows else prof
    scores = (grams.join(prof, "gram")
              .groupBy(*keys, "lang").agg(F.sum(F.col("w") * F.col("c")).alias("score")))
    wide = scores.groupBy(*keys).agg(*[
        F.sum(F.when(F.col("lang") == F.lit(lang), F.col("score"))).alias(f"_s{i}")
        for i, lang in enumerate(langs)])
    # NULL scores (language without a matching gram) order below every number.
    best = F.array_max(F.array(*[
        F.struct(F.col(f"_s{i}").alias("s"), F.lit(-i).alias("r")) for i in range(len(langs))]))
    codes = F.array(*[F.lit(lang) for lang in langs])
    return wide.select(*keys, F.element_at(codes, (F.lit(1) - best["r"]).cast("int"))
                       .alias("language"))
