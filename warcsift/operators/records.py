"""Record validity (which records become articles) and record disposition.

A record is *valid* when it is a response with record and HTTP headers, a
target URI and a content type, the content type is UTF-8 HTML, and the URI
matches at least one URL glob. Invalid records are *discarded*. A valid
record whose body is not strict UTF-8 (or could not be decoded) or whose
article has no language is *errored*; the rest are *extracted*.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.globs import glob_elements, glob_host, glob_literals, glob_regex, ngrams, url_matches_any
from ..functions.headers import header
from ..functions.text import is_utf8_html, strict_utf8

KEYS = ["warc_path", "rec_idx"]
GRAM = 5  # characters of the literal pieces by which globs without a host are found


def target_uri(rec_headers: Column) -> Column:
    """The record's URL; some crawlers write it as ``<URL>``."""
    return F.regexp_replace(header(rec_headers, "WARC-Target-URI"), r"^<(.*)>$", "$1")


def content_type(http_headers: Column) -> Column:
    return header(http_headers, "Content-Type")


def is_response(rec_type: Column, rec_headers: Column, http_headers: Column) -> Column:
    return (rec_type == "response") & rec_headers.isNotNull() & http_headers.isNotNull()


def validity(records: DataFrame, patterns: list[str]) -> Column:
    url = target_uri(F.col("rec_headers"))
    ct = content_type(F.col("http_headers"))
    ok = (is_response(F.col("rec_type"), F.col("rec_headers"), F.col("http_headers"))
          & url.isNotNull() & ct.isNotNull() & is_utf8_html(ct)
          & url_matches_any(url, patterns))
    return F.coalesce(ok, F.lit(False))


def classify(records: DataFrame, patterns: list[str]) -> DataFrame:
    """Adds ``url``, ``content_type``, ``valid`` and ``html`` (decoded only when valid)."""
    valid = validity(records, patterns)
    decoded = F.when(F.col("payload_error").isNull(), strict_utf8(F.col("payload")))
    return records.select(
        "*",
        target_uri(F.col("rec_headers")).alias("url"),
        content_type(F.col("http_headers")).alias("content_type"),
        valid.alias("valid"),
    ).withColumn("html", F.when(F.col("valid"), decoded))


def disposition(valid: Column, decoded: Column, language: Column) -> Column:
    """``decoded``: the body decoded to text (boolean)."""
    return (F.when(~valid, F.lit("discarded"))
            .when(~decoded | language.isNull(), F.lit("errored"))
            .otherwise(F.lit("extracted")))


def url_semi_join(records: DataFrame, patterns: DataFrame, url_col: str = "url",
                  glob_col: str = "glob") -> DataFrame:
    """Records whose URL matches any glob of a patterns *table* (EXISTS semantics).

    A glob with a literal host (``*://*.example.com/*``) can only match a URL
    one of whose ``/``-parts ends with that host, so such globs meet distinct
    URLs by an equi-join on host suffixes. Every other glob is filed under one
    literal piece that its matches must contain: of its pieces of ``GRAM``
    characters (fewer, if its longest literal is shorter) the one that the fewest
    URLs hold; globs with a piece that no URL holds are left out. URLs meet them by
    an equi-join on pieces. The glob itself is the residual condition of both.
    Globs are translated by built-in functions; the number of patterns is not limited.
    Both joins are told to sort and merge: Spark takes an exploded table to be about as
    small as its URLs, and would gather all their pieces in the driver to broadcast them.
    """
    globs = (patterns.select(F.col(glob_col).alias("_glob")).where(F.col("_glob").isNotNull()).distinct()
             .withColumn("_elements", glob_elements(F.col("_glob")))
             .select(glob_regex(F.col("_elements")).alias("_rx"), glob_host(F.col("_glob")).alias("_host"),
                     glob_literals(F.col("_elements")).alias("_literals")).where(F.col("_rx").isNotNull()))
    urls = records.select(F.col(url_col).alias("_url")).where(F.col("_url").isNotNull()).distinct()
    parts = F.flatten(F.transform(F.split("_url", "/"), _suffixes))
    by_host = (urls.select("_url", F.explode(F.array_distinct(parts)).alias("_host"))
               .join(globs.where(F.col("_host").isNotNull()).hint("merge"), "_host"))
    other = globs.where(F.col("_host").isNull()).withColumn(
        "_n", F.least(F.lit(GRAM), F.array_max(F.transform("_literals", F.char_length))))
    piece = F.flatten(F.transform("_literals", lambda x: ngrams(x, F.col("_n"))))
    filed = other.select("_rx", "_n", F.explode(F.array_distinct(piece)).alias("_gram"))
    in_use = F.coalesce(other.agg(F.bit_or(F.expr("shiftleft(1, _n)"))).scalar(), F.lit(0))  # lengths of pieces, as bits
    held = (urls.select("_url", in_use.alias("_bits"))
            .select("_url", F.filter(F.sequence(F.lit(0), F.lit(GRAM)), lambda n: F.getbit("_bits", n) == 1).alias("_lengths"))
            .select("_url", F.explode(F.flatten(F.transform("_lengths", lambda n: ngrams(F.col("_url"), n)))).alias("_gram")))
    wanted = held.join(filed.select("_gram").distinct(), "_gram", "left_semi")
    often = wanted.groupBy("_gram").agg(F.count("*").alias("_urls"))
    rarest = (filed.join(often, "_gram", "left").groupBy("_rx")
              .agg(F.min(F.struct(F.coalesce("_urls", F.lit(0)).alias("urls"), F.col("_gram").alias("gram"))).alias("_least"))
              .where(F.col("_least.urls") > 0).select("_rx", F.col("_least.gram").alias("_gram")))
    hits = by_host.select("_url", "_rx").unionByName(held.join(rarest.hint("merge"), "_gram").select("_url", "_rx"))
    hits = hits.where(F.expr("_url rlike _rx")).select("_url").distinct()
    return records.join(hits, F.col(url_col) == F.col("_url"), "left_semi")


def _suffixes(part: Column) -> Column:
    """A URL part and what follows each of its dots."""
    labels = F.split(part, "[.]")
    return F.transform(labels, lambda _, i: F.call_function("substring_index", part, F.lit("."), i - F.size(labels)))
