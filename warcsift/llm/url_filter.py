"""Operator 1: URL filters.

A logistic regression on hashed character n-grams of host and path, trained
from a small labelled URL table, decides every URL that no rule decides. The
model's weights (``FEATURES`` doubles) become a literal array, so that scoring
is one projection of built-in functions over ``url``: no shuffle, no join.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z
lower-cased; path: then up to ``?``, ``#`` or end. A rule ``host/path`` fits
its host and all subdomains where the path starts with the rule's; the longest
fitting rule wins.

Defined results: a null url, or one without ``://``, has empty host and path,
fits no rule and is judged by the model's intercept; empty and very long URLs
are read whole; equal rows get equal results; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, lower_ascii

#: (rule, verdict), fixed values.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

#: The labelled URL table (1: block), fixed values invented for this engine.
LABELLED = tuple((u, 1) for u in (
    "http://ads.example.com/banner/1", "https://ad-server.example.org/click?x=1",
    "https://m.adtrack.example.com/en/12", "http://tracker.example.org/pixel.gif",
    "https://track.clicks.example.com/redirect/", "https://cheap-meds.example.org/buy/now",
    "http://www.cheap-watches.example.com/sale", "https://pills-online.example.org/order/77",
    "https://best-pills.example.com/de/9", "http://casino-bonus.example.org/spin",
    "https://blog.casino-win.example.com/en/4", "http://free-casino.example.com/slots",
    "https://xxx-cams.example.org/live", "http://adult-cams.example.com/en/8",
    "https://porn-tube.example.org/watch/3", "http://win-prizes.example.com/claim",
    "https://free-prizes.example.org/en/55", "http://lottery-win.example.com/claim/now",
    "https://payday-loans.example.org/apply", "http://cheap-loans.example.com/apply/now",
    "https://replica-bags.example.org/shop/sale", "http://spam-links.example.com/link/1",
    "https://m.ads-click.example.org/fr/6", "http://banner-ads.example.com/show",
    "http://spam-mail.example.com/list/2", "https://www.spam-pages.example.com/en/70",
    "https://adult-video.example.org/en/14", "http://adult.example.com/watch",
    "https://m.track-ads.example.org/es/33", "http://cheap-pills.example.com/order",
)) + tuple((u, 0) for u in (
    "https://news.example.com/en/2021/story", "http://www.example.org/about",
    "https://blog.garden.example.com/en/45", "http://m.harbour.example.org/fr/12.html",
    "https://library.example.com/catalogue/18", "https://science.example.org/articles/77",
    "http://weather.example.com/en/today", "https://recipes.example.org/soup/3",
    "https://m.travel.example.com/es/91", "http://blog.history.example.org/en/1066",
    "https://city-council.example.com/minutes/5", "https://museum.example.org/exhibits/",
    "http://university.example.com/courses/algebra", "https://docs.example.org/manual/page.html",
    "https://m.theatre.example.com/en/34728", "http://forum.chess.example.org/thread/10",
    "https://blog.astronomy.example.com/de/20980", "https://health.example.org/guides/sleep",
    "http://www.football.example.com/results/7", "https://music.example.org/concerts/june",
    "https://railway.example.com/timetable", "http://m.garden.example.org/es/7718.html",
    "https://school.example.com/en/6926", "https://bird-watch.example.org/en/51",
    "http://other.example.com/fr/36929", "https://theton.example.org/en/9231/",
    "https://blog.river.example.com/en/49?page=2", "http://mountain.example.org/de/31980",
    "https://thintion.example.com/en/28015?utm_source=feed", "http://m.winter.example.com/en/102#top",
))

FEATURES, GRAMS = 4096, (3, 4)


def host(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def buckets(host: Column, path: Column) -> Column:
    """Distinct hash buckets of the character n-grams of ``host`` and ``path``.

    One look-ahead pass per n-gram length, so a long URL costs its length.
    """
    def grams(text: Column, n: int, tag: str) -> Column:
        found = F.regexp_extract_all(F.concat(F.lit("^"), text, F.lit("$")),
                                     F.lit(rf"(?s)(?=(.{{{n}}}))."), F.lit(1))
        return F.transform(found, lambda g: F.pmod(F.xxhash64(F.lit(tag), g), F.lit(FEATURES)).cast("int"))

    parts = [grams(c, n, tag) for c, tag in ((host, "h"), (lower_ascii(path), "p")) for n in GRAMS]
    return F.array_distinct(F.concat(*parts))


def labelled_urls(spark: SparkSession, rows=LABELLED) -> DataFrame:
    pairs = [F.struct(F.lit(u).alias("url"), F.lit(y).cast("double").alias("label")) for u, y in rows]
    return spark.range(1).select(F.inline(F.array(*pairs)))


def train(labelled: DataFrame, max_iter: int = 40, reg: float = 0.005) -> tuple[list[float], float]:
    """Weights and intercept learnt from ``labelled`` (url, label: 1 block, 0 allow).

    ``labelled`` is meant to be small (thousands of rows); the fit reads one
    bounded vector of ``FEATURES`` numbers per row.
    """
    b = buckets(host(F.col("url")), path(F.col("url")))
    dense = let(b, lambda b: F.transform(F.sequence(F.lit(0), F.lit(FEATURES - 1)),
                                         lambda i: F.array_contains(b, i).cast("double")))
    rows = labelled.filter("label IS NOT NULL").select("label", array_to_vector(dense).alias("features")).coalesce(1)
    model = LogisticRegression(maxIter=max_iter, regParam=reg, standardization=False).fit(rows)
    return [float(x) for x in model.coefficients.toArray()], float(model.intercept)


def judge_urls(pages: DataFrame, weights: list[float], intercept: float, rules=RULES,
               threshold: float = 0.5) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, score`` (of blocking)."""
    split = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    fitting = [F.when(_fits(rule), F.lit(rule)) for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0]))]
    rule = F.coalesce(*fitting, F.lit(None).cast("string")) if fitting else F.lit(None).cast("string")
    w = F.array(*[F.lit(x) for x in weights])
    margin = F.aggregate(buckets(F.col("host"), F.col("path")), F.lit(intercept),
                         lambda acc, i: acc + F.get(w, i))
    judged = split.select("page_id", "host", "path", rule.alias("rule"),
                          (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))).alias("score"))
    by_rule = F.coalesce(*[F.when(F.col("rule") == r, F.lit(v)) for r, v in rules], F.lit(None)) \
        if rules else F.lit(None)
    by_model = F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", "rule",
                         F.coalesce(by_rule.cast("string"), by_model).alias("verdict"), "score")


def _fits(rule: str) -> Column:
    name, _, rest = rule.partition("/")
    on_host = (F.col("host") == name) | F.endswith(F.col("host"), F.lit("." + name))
    return on_host & F.startswith(F.col("path"), F.lit("/" + rest))
