"""Registered queries: one Spark builder and (where SQL can say it) one DuckDB oracle.

Every query reads the driver tables of ``sf_dir`` (``pages`` decorated into
archive records, ``documents`` for the language profile) in full.
"""

from __future__ import annotations

from datetime import datetime
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import paths as P
from ..functions.headers import header
from ..functions.text import (UTF8_HTML_RX, detect_input, is_utf8_html, source_domain,
                              strict_utf8)
from ..operators import counters as C
from ..operators import html as H
from ..operators.article import articles
from ..operators.language import broadcast_if_bounded
from ..operators.records import content_type, target_uri
from ..sources import index as I
from ..sources.responses import load_table, responses, spread
from . import context as X
from . import sql as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# Parameters of the checks (fit 20 records per file).
GLOBS = ["*://*.example.com/en/*", "https://blog.*", "*/fr/[0-9]*", "http://www.?h*",
         "*[!a-z]de/4??"]
WINDOW = (datetime(2021, 1, 1, 6, 0, 0), datetime(2021, 1, 1, 18, 0, 0))
LIMIT = 10
REPORT_EVERY = 5

RESP = "WITH " + S.responses_cte()
DISP = S.dispositions_ctes()
ARTICLE_COLS = "title, main_text, url, source_domain, date_publish, date_crawled, language"

# ---------------------------------------------------------------- end to end


@query("articles", f"{DISP}\nSELECT {ARTICLE_COLS} FROM disp WHERE disposition = 'extracted'")
def q_articles(spark, sf):
    return articles(X.disp(spark, sf))


@query("record_disposition", f"{DISP}\nSELECT warc_path, rec_idx, disposition FROM disp")
def q_record_disposition(spark, sf):
    return X.disp(spark, sf).select("warc_path", "rec_idx", "disposition")


# ---------------------------------------------------------------- predicates

@query("response_filter", f"""{RESP}
SELECT warc_path, rec_idx FROM responses
WHERE rec_type = 'response' AND rec_headers IS NOT NULL AND http_headers IS NOT NULL""")
def q_response_filter(spark, sf):
    r = responses(spark, sf)
    return r.where((F.col("rec_type") == "response") & F.col("rec_headers").isNotNull()
                   & F.col("http_headers").isNotNull()).select("warc_path", "rec_idx")


@query("header_lookup", f"""{RESP}
SELECT warc_path, rec_idx, {S.header('rec_headers', 'WARC-Target-URI')} AS url,
       {S.header('rec_headers', 'warc-type')} AS warc_type,
       {S.header('http_headers', 'CONTENT-TYPE')} AS content_type
FROM responses""")
def q_header_lookup(spark, sf):
    r = responses(spark, sf)
    return r.select("warc_path", "rec_idx",
                    target_uri(F.col("rec_headers")).alias("url"),
                    header(F.col("rec_headers"), "warc-type").alias("warc_type"),
                    header(F.col("http_headers"), "CONTENT-TYPE").alias("content_type"))


@query("content_type_filter", f"""{RESP}
SELECT warc_path, rec_idx, content_type FROM (
  SELECT *, {S.header('http_headers', 'Content-Type')} AS content_type FROM responses)
WHERE regexp_matches(content_type, {S.lit(UTF8_HTML_RX)})""")
def q_content_type_filter(spark, sf):
    r = responses(spark, sf).select("warc_path", "rec_idx",
                                    content_type(F.col("http_headers")).alias("content_type"))
    return r.where(is_utf8_html(F.col("content_type")))


@query("url_glob_filter", f"""{RESP}
SELECT warc_path, rec_idx, url FROM (
  SELECT *, {S.header('rec_headers', 'WARC-Target-URI')} AS url FROM responses)
WHERE {S.url_match('url', GLOBS)}""")
def q_url_glob_filter(spark, sf):
    from ..functions.globs import url_matches_any
    r = responses(spark, sf).select("warc_path", "rec_idx",
                                    target_uri(F.col("rec_headers")).alias("url"))
    return r.where(url_matches_any(F.col("url"), GLOBS))


@query("url_glob_empty", f"""{RESP}, {S.classified_cte([])}
SELECT warc_path, rec_idx, url FROM classified WHERE valid""")
def q_url_glob_empty(spark, sf):
    c = X.classified(spark, sf, [])
    return c.where("valid").select("warc_path", "rec_idx", "url")


@query("valid_records", f"""{RESP}, {S.classified_cte(GLOBS)}
SELECT warc_path, rec_idx, url, valid FROM classified""")
def q_valid_records(spark, sf):
    return X.classified(spark, sf, GLOBS).select("warc_path", "rec_idx", "url", "valid")


@query("strict_utf8", f"""{RESP}
SELECT warc_path, rec_idx, try(decode(payload)) IS NOT NULL AS is_utf8,
       length(try(decode(payload))) AS n_chars
FROM responses""")
def q_strict_utf8(spark, sf):
    r = responses(spark, sf)
    d = strict_utf8(F.col("payload"))
    return r.select("warc_path", "rec_idx", d.isNotNull().alias("is_utf8"),
                    F.length(d).cast("long").alias("n_chars"))


@query("source_domain", f"""SELECT page_id, url, {S.source_domain('url')} AS source_domain
FROM pages""")
def q_source_domain(spark, sf):
    p = load_table(spark, sf, "pages")
    return p.select("page_id", "url", source_domain(F.col("url")).alias("source_domain"))


@query("detect_input", f"""{DISP}
SELECT warc_path, rec_idx, detect_text FROM fields2 WHERE decoded""")
def q_detect_input(spark, sf):
    d = X.disp(spark, sf)
    return d.where("decoded").select(
        "warc_path", "rec_idx", detect_input(F.col("main_text"), F.col("title")).alias("detect_text"))


# ---------------------------------------------------------------- html

_PAGE_BLOCKS, _PB_LAST = S.blocks_ctes("pages", "page_id, url, html")
_PAGE_TITLE, _PT_LAST = S.title_ctes(_PB_LAST)


def _page_blocks(spark, sf):
    p = spread(load_table(spark, sf, "pages"))
    return p.select("page_id", "url", "html", H.blocks(F.col("html")).alias("blocks"))


@query("html_blocks", f"""WITH RECURSIVE {_PAGE_BLOCKS}
SELECT page_id, url, CAST(b.pos AS BIGINT) AS pos, CAST(b.section AS BIGINT) AS section,
       b.tag AS tag, b.text AS text
FROM (SELECT page_id, url, unnest(blocks) AS b FROM {_PB_LAST})""")
def q_html_blocks(spark, sf):
    b = _page_blocks(spark, sf).select("page_id", "url", F.inline("blocks"))
    return b.select("page_id", "url", F.col("pos").cast("long").alias("pos"),
                    F.col("section").cast("long").alias("section"), "tag", "text")


@query("block_features", f"""WITH RECURSIVE {_PAGE_BLOCKS}
SELECT page_id, CAST(b.pos AS BIGINT) AS pos, CAST(b.n_words AS BIGINT) AS n_words,
       CAST(b.n_stop AS BIGINT) AS n_stop, CAST(b.link_words AS BIGINT) AS link_words,
       CAST(b.n_links AS BIGINT) AS n_links
FROM (SELECT page_id, unnest(blocks) AS b FROM {_PB_LAST})""")
def q_block_features(spark, sf):
    b = _page_blocks(spark, sf).select("page_id", F.inline("blocks"))
    return b.select("page_id", *[F.col(c).cast("long").alias(c) for c in
                                 ("pos", "n_words", "n_stop", "link_words", "n_links")])


@query("main_text", f"""WITH RECURSIVE {_PAGE_BLOCKS}
SELECT page_id, url, {S.main_text()} AS main_text FROM {_PB_LAST}""")
def q_main_text(spark, sf):
    b = _page_blocks(spark, sf)
    return b.select("page_id", "url", H.main_text(F.col("blocks")).alias("main_text"))


@query("title", f"""WITH RECURSIVE {_PAGE_BLOCKS}, {_PAGE_TITLE}
SELECT page_id, url, title FROM {_PT_LAST}""")
def q_title(spark, sf):
    b = _page_blocks(spark, sf).select(
        "page_id", "url", "blocks", H.title_text(F.col("html")).alias("t"),
        H.og_title(F.col("html")).alias("og"))
    return b.select("page_id", "url", H.choose_title(F.col("t"), F.col("blocks"), F.col("og"))
                    .alias("title"))


# Publish dates: pages carry none, so each gets one in some spelling and place, by its
# number (rules fixed here, same in SQL). %s is the day; two of them are no real dates.
_DATE_PLACES = [
    '<meta property="article:published_time" content="{yyyy-MM-dd}T08:00:00Z">', "URL /{yyyy/MM/dd}/story", "",
    '<meta content="{yyyy-M-d}" name="date">', "URL /{yyyy/M/d}/", '<time class=x datetime="{d MMMM yyyy}">x</time>',
    '<script type="application/ld+json">{"@graph":[{"@type":"Person"},{"datePublished":"{yyyy-M-d}T10:00"}]}</script>',
    '<script type="application/ld+json">[{"x":1},{"datePublished":"{MMMM d, yyyy}"}]</script>',
    '<script type="application/ld+json">{"datePublished":"{yyyy-MM-dd}",}</script>',
    '<meta name="dc.date" content="2021-02-30"><meta itemprop="datePublished" content="{dd.MM.yyyy}">', "URL /2021/13/45/",
    '<script type="application/ld+json">{"datePublished":20210304,"d":{"datePublished":"{yyyyMMdd}"}}</script>']
_SQL_FORMS = {"yyyy-MM-dd": "%Y-%m-%d", "yyyy/MM/dd": "%Y/%m/%d", "yyyy-M-d": "%Y-%-m-%-d", "yyyy/M/d": "%Y/%-m/%-d",
              "d MMMM yyyy": "%-d %B %Y", "MMMM d, yyyy": "%B %-d, %Y", "dd.MM.yyyy": "%d.%m.%Y", "yyyyMMdd": "%Y%m%d"}


def _date_place(place: str):
    """(text before the day, its form or None, text after)."""
    for form in _SQL_FORMS:
        if "{" + form + "}" in place:
            before, after = place.split("{" + form + "}")
            return before, form, after
    return place, None, ""


def _dated_pages_spark(p: DataFrame) -> DataFrame:
    pid = F.col("page_id")
    day = F.date_add(F.lit("2020-12-01").cast("date"), (pid % 97).cast("int"))
    added = F.lit("")
    for i, place in enumerate(_DATE_PLACES):
        before, form, after = _date_place(place)
        text = F.concat(F.lit(before), F.date_format(day, form) if form else F.lit(""), F.lit(after))
        added = F.when(pid % len(_DATE_PLACES) == i, text).otherwise(added)
    staged = p.select("page_id", "url", "html", added.alias("added"))
    in_url = F.startswith("added", F.lit("URL "))
    return staged.select("page_id", F.when(in_url, F.concat("url", F.substr("added", F.lit(5)))).otherwise(F.col("url")).alias("url"),
                         F.when(in_url, F.col("html")).otherwise(F.concat("added", "html")).alias("html"))


def _dated_sql() -> str:
    whens = ""
    for i, place in enumerate(_DATE_PLACES):
        before, form, after = _date_place(place)
        day = f"strftime(DATE '2020-12-01' + CAST(page_id % 97 AS INTEGER), '{_SQL_FORMS[form]}')" if form else "''"
        whens += f" WHEN {i} THEN {S.lit(before)} || {day} || {S.lit(after)}"
    return f"""dated AS (
  SELECT page_id, CASE WHEN starts_with(added, 'URL ') THEN url || added[5:] ELSE url END AS url,
         CASE WHEN starts_with(added, 'URL ') THEN html ELSE added || html END AS html
  FROM (SELECT *, CASE page_id % {len(_DATE_PLACES)}{whens} END AS added FROM pages))"""


_DATED_SQL = _dated_sql()


@query("publish_date", f"""WITH {_DATED_SQL}
SELECT page_id, url, {S.publish_date()} AS date_publish FROM dated""")
def q_publish_date(spark, sf):
    d = _dated_pages_spark(load_table(spark, sf, "pages"))
    return d.select("page_id", "url",
                    H.publish_date(F.col("url"), F.col("html")).alias("date_publish"))


# ---------------------------------------------------------------- language

@query("lang_profile", f"""WITH {S.profile_ctes()}
SELECT lang, gram, n FROM profile""")
def q_lang_profile(spark, sf):
    return X.profile(spark, sf).select("lang", "gram", "n")


@query("language_detect", f"""{DISP}
SELECT warc_path, rec_idx, language FROM lang""")
def q_language_detect(spark, sf):
    return X.disp(spark, sf).where(F.col("language").isNotNull()).select(
        "warc_path", "rec_idx", "language")


# ---------------------------------------------------------------- counters


def _counts_sql(extra: str = "") -> str:
    return (f"CAST(count_if(disposition = 'extracted') AS BIGINT) AS extracted, "
            f"CAST(count_if(disposition = 'discarded') AS BIGINT) AS discarded, "
            f"CAST(count_if(disposition = 'errored') AS BIGINT) AS errored, "
            f"count(*) AS total{extra}")


@query("counters_per_warc", f"{DISP}\nSELECT warc_path, {_counts_sql()} FROM disp GROUP BY warc_path")
def q_counters_per_warc(spark, sf):
    return C.counters_per_warc(X.disp(spark, sf))


@query("counters_total", f"{DISP}\nSELECT {_counts_sql()} FROM disp")
def q_counters_total(spark, sf):
    return C.counters_total(X.disp(spark, sf))


@query("counters_rollup", f"""{DISP}
SELECT warc_path, CASE WHEN grouping(warc_path) = 1 THEN 'total' ELSE 'warc' END AS level,
       {_counts_sql()}
FROM disp GROUP BY ROLLUP (warc_path)""")
def q_counters_rollup(spark, sf):
    return C.counters_rollup(X.disp(spark, sf))


@query("nonempty_warcs", f"""{DISP}
SELECT * FROM (SELECT warc_path, {_counts_sql()} FROM disp GROUP BY warc_path)
WHERE extracted > 0""")
def q_nonempty_warcs(spark, sf):
    return C.nonempty_warcs(X.disp(spark, sf))


@query("error_rate", f"""{DISP}
SELECT extracted, errored, round(errored::DOUBLE / nullif(extracted, 0), 6) AS error_rate,
       errored < 0.1 * extracted AS passes
FROM (SELECT {_counts_sql()} FROM disp)""")
def q_error_rate(spark, sf):
    return C.error_rate(X.disp(spark, sf))




@query("limit_per_warc", f"""{RESP}
SELECT warc_path, rec_idx, rec_type FROM responses WHERE rec_idx < {LIMIT}""")
def q_limit_per_warc(spark, sf):
    return C.limit_per_warc(responses(spark, sf), LIMIT).select(
        "warc_path", "rec_idx", "rec_type")


_RUNNING_SQL = f"""running AS (
  SELECT * FROM (
    SELECT warc_path, rec_idx, rec_offset, file_size,
      coalesce(sum(CASE WHEN disposition = 'extracted' THEN 1 ELSE 0 END) OVER w, 0) AS extracted,
      coalesce(sum(CASE WHEN disposition = 'discarded' THEN 1 ELSE 0 END) OVER w, 0) AS discarded,
      coalesce(sum(CASE WHEN disposition = 'errored' THEN 1 ELSE 0 END) OVER w, 0) AS errored
    FROM disp
    WINDOW w AS (PARTITION BY warc_path ORDER BY rec_idx
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  WHERE rec_idx > 0 AND rec_idx % {REPORT_EVERY} = 0
)"""


@query("running_counters", f"""{DISP}, {_RUNNING_SQL}
SELECT warc_path, rec_idx, CAST(extracted AS BIGINT) AS extracted,
       CAST(discarded AS BIGINT) AS discarded, CAST(errored AS BIGINT) AS errored,
       CAST(extracted + discarded + errored AS BIGINT) AS total
FROM running""")
def q_running_counters(spark, sf):
    r = C.running_counters(X.disp(spark, sf), REPORT_EVERY)
    return r.select("warc_path", "rec_idx", "extracted", "discarded", "errored", "total")


@query("progress_percent", f"""{DISP}, {_RUNNING_SQL}
SELECT warc_path, rec_idx, round(100.0 * rec_offset / file_size, 2) AS percent
FROM running WHERE file_size > 0""")
def q_progress_percent(spark, sf):
    return C.progress_percent(C.running_counters(X.disp(spark, sf), REPORT_EVERY))


# ---------------------------------------------------------------- index

_PATHS_SQL = f"""paths AS (SELECT DISTINCT warc_path FROM responses),
parsed AS (
  SELECT warc_path,
         CASE WHEN regexp_matches(warc_path, '\\A[A-Za-z][A-Za-z0-9+.-]*:') THEN warc_path
              ELSE '{P.DEFAULT_DOMAIN}/' || regexp_replace(warc_path, '\\A/+', '') END AS warc_url,
         split_part(string_split(warc_path, '/')[-1], '.', 1) AS basename,
         {S.crawl_ts('warc_path')} AS crawl_ts,
         {S.serial('warc_path')} AS serial
  FROM paths
)"""


def _index_from_responses(spark, sf) -> DataFrame:
    lines = responses(spark, sf).select(F.col("warc_path").alias("value")).distinct()
    return I.parse_paths(lines)


@query("warc_index_parse", f"""{RESP}, {_PATHS_SQL}
SELECT warc_path, warc_url, basename, strftime(crawl_ts, '%Y-%m-%d %H:%M:%S') AS crawl_ts,
       serial FROM parsed""")
def q_warc_index_parse(spark, sf):
    i = _index_from_responses(spark, sf)
    return i.select("warc_path", "warc_url", "basename",
                    F.date_format("crawl_ts", "yyyy-MM-dd HH:mm:ss").alias("crawl_ts"),
                    "serial")


@query("warc_date_window", f"""{RESP}, {_PATHS_SQL}
SELECT warc_path, strftime(crawl_ts, '%Y-%m-%d %H:%M:%S') AS crawl_ts FROM parsed
WHERE crawl_ts >= TIMESTAMP '{WINDOW[0]:%Y-%m-%d %H:%M:%S}'
  AND crawl_ts < TIMESTAMP '{WINDOW[1]:%Y-%m-%d %H:%M:%S}'""")
def q_warc_date_window(spark, sf):
    i = _index_from_responses(spark, sf)
    return i.where(P.in_window(F.col("crawl_ts"), *WINDOW)).select(
        "warc_path", F.date_format("crawl_ts", "yyyy-MM-dd HH:mm:ss").alias("crawl_ts"))


@query("warc_count", f"""{RESP}, {_PATHS_SQL}
SELECT count(*) AS n_warcs FROM parsed
WHERE crawl_ts >= TIMESTAMP '{WINDOW[0]:%Y-%m-%d %H:%M:%S}'
  AND crawl_ts < TIMESTAMP '{WINDOW[1]:%Y-%m-%d %H:%M:%S}'""")
def q_warc_count(spark, sf):
    return I.warc_count(I.prune(_index_from_responses(spark, sf), *WINDOW))


@query("index_months", f"""{RESP}, {_PATHS_SQL},
win AS (SELECT min(crawl_ts) - INTERVAL 40 DAY AS s, max(crawl_ts) + INTERVAL 40 DAY AS e FROM parsed)
SELECT strftime(m, '%Y-%m') AS month,
       'crawl-data/CC-NEWS/' || strftime(m, '%Y') || '/' || strftime(m, '%m') || '/warc.paths.gz' AS index_path
FROM (SELECT unnest(generate_series(date_trunc('month', s), date_trunc('month', e - INTERVAL 1 SECOND),
                                    INTERVAL 1 MONTH)) AS m FROM win)""")
def q_index_months(spark, sf):
    i = _index_from_responses(spark, sf)
    win = i.agg((F.min("crawl_ts") - F.expr("INTERVAL 40 DAYS")).alias("s"),
                (F.max("crawl_ts") + F.expr("INTERVAL 40 DAYS")).alias("e"))
    m = win.select(F.explode(I.month_rows(F.col("s"), F.col("e"))).alias("m"))
    return m.select(F.date_format("m", "yyyy-MM").alias("month"),
                    F.concat(F.lit(P.DEFAULT_ROUTE + "/"), F.date_format("m", "yyyy"),
                             F.lit("/"), F.date_format("m", "MM"),
                             F.lit("/" + P.INDEX_NAME)).alias("index_path"))


# ---------------------------------------------------------------- joins

@query("record_crawl_date", f"""{RESP}, {_PATHS_SQL}
SELECT r.warc_path, r.rec_idx, strftime(p.crawl_ts, '%Y-%m-%d') AS date_crawled
FROM responses r JOIN parsed p USING (warc_path)""")
def q_record_crawl_date(spark, sf):
    idx = broadcast_if_bounded(_index_from_responses(spark, sf).select("warc_path", "crawl_ts"),
                               1_000_000)
    r = responses(spark, sf).select("warc_path", "rec_idx")
    return r.join(idx, "warc_path").select(
        "warc_path", "rec_idx", P.crawl_date(F.col("crawl_ts")).alias("date_crawled"))


_HOST_SQL = "regexp_extract(url, '://([^/?#]*)', 1)"
_ODD_GLOBS = ["*#top", "*/fr/[0-9]*.html", "http://m.*[!a-z]de/4???"]


@query("url_glob_semi_join", f"""{RESP},
u AS (SELECT warc_path, rec_idx, {S.header('rec_headers', 'WARC-Target-URI')} AS url FROM responses),
globs AS (
  SELECT DISTINCT '*://' || {_HOST_SQL} || '/en/*' AS glob FROM pages WHERE {_HOST_SQL} LIKE 'blog.%'
  UNION SELECT DISTINCT 'http*://*.' || regexp_extract(url, '://[^/?#.]*[.]([^/?#]*)', 1) || '/es/*' FROM pages
  UNION VALUES {', '.join(f"('{g}')" for g in _ODD_GLOBS)})
SELECT * FROM u WHERE EXISTS (SELECT 1 FROM globs WHERE u.url GLOB globs.glob)""")
def q_url_glob_semi_join(spark, sf):
    """Patterns: one per blog host and one per parent domain of ``pages``, and three
    that name no host."""
    from ..operators.records import url_semi_join
    pages = load_table(spark, sf, "pages")
    host = F.regexp_extract("url", "://([^/?#]*)", 1)
    parent = F.regexp_extract("url", "://[^/?#.]*[.]([^/?#]*)", 1)
    pats = (pages.where(F.startswith(host, F.lit("blog."))).select(F.concat(F.lit("*://"), host, F.lit("/en/*")).alias("glob"))
            .unionByName(pages.select(F.concat(F.lit("http*://*."), parent, F.lit("/es/*")).alias("glob")))
            .distinct().unionByName(spark.createDataFrame([(g,) for g in _ODD_GLOBS], "glob string")))
    r = responses(spark, sf).select("warc_path", "rec_idx",
                                    target_uri(F.col("rec_headers")).alias("url"))
    return url_semi_join(r, pats)


# ---------------------------------------------------------------- archive source

# Small enough that files of the fixtures are read by several tasks.
_SPLIT_BYTES = 2000


def _fixture_records(spark, sf, fmt: str, encodings: bool = False, **opts) -> DataFrame:
    from ..session import scratch_dir
    from ..sources.fixtures import write_fixture
    from ..sources.warc import read_warc
    root = scratch_dir(spark, "fixture")
    write_fixture(responses(spark, sf), root, fmt, encodings).count()
    return read_warc(spark, root, **opts)


def _rel(c):
    return F.regexp_extract(c, "crawl-data/.*$", 0)


def _scan_view(r: DataFrame) -> DataFrame:
    d = strict_utf8(F.col("payload"))
    return r.select(_rel(F.col("warc_path")).alias("warc_path"), "rec_idx", "rec_type",
                    target_uri(F.col("rec_headers")).alias("url"),
                    content_type(F.col("http_headers")).alias("content_type"),
                    F.col("http_status").cast("long").alias("http_status"),
                    d.alias("html"), F.octet_length("payload").cast("long").alias("n_bytes"))


_SCAN_SQL = f"""{RESP}
SELECT warc_path, rec_idx, rec_type, {S.header('rec_headers', 'WARC-Target-URI')} AS url,
       {S.header('http_headers', 'Content-Type')} AS content_type,
       CAST(http_status AS BIGINT) AS http_status, try(decode(payload)) AS html,
       CAST(octet_length(payload) AS BIGINT) AS n_bytes
FROM responses"""


@query("warc_scan", _SCAN_SQL)
def q_warc_scan(spark, sf):
    return _scan_view(_fixture_records(spark, sf, "warc.gz"))


@query("warc_scan_splits", _SCAN_SQL)
def q_warc_scan_splits(spark, sf):
    """The same rows, each file read in byte ranges by several tasks."""
    return _scan_view(_fixture_records(spark, sf, "warc.gz", split_bytes=_SPLIT_BYTES))


_ERRORS_SQL = f"""{RESP},
f AS (SELECT warc_path, count(*) AS n, CAST(regexp_extract(warc_path, '-([0-9]+)[.]', 1) AS BIGINT) % 4 AS k
      FROM responses GROUP BY warc_path)
SELECT warc_path, CASE k WHEN 0 THEN n WHEN 3 THEN 0 ELSE n - 1 END AS n_records,
       CASE k WHEN 0 THEN 0 ELSE 1 END AS n_errors, k = 3 AS missing
FROM f"""


@query("scan_errors", _ERRORS_SQL)
def q_scan_errors(spark, sf):
    """Readable records and gaps of files of which some are corrupt, cut or missing."""
    return _gaps(spark, sf)


@query("scan_errors_splits", _ERRORS_SQL)
def q_scan_errors_splits(spark, sf):
    return _gaps(spark, sf, split_bytes=_SPLIT_BYTES)


def _gaps(spark, sf, **opts):
    from ..session import scratch_dir
    from ..sources.fixtures import write_fixture
    from ..sources.warc import ERROR_TYPE, read_warc
    r, root = responses(spark, sf), scratch_dir(spark, "damaged")
    write_fixture(r, root, damage=True).count()
    # The list to read comes from the index, as in a run: it names missing files too.
    listed = [f"{root}/{x['warc_path']}" for x in _index_from_responses(spark, sf).select("warc_path").collect()]
    got = read_warc(spark, listed, payload=False, **opts)
    gap = F.col("rec_type").eqNullSafe(ERROR_TYPE)
    return got.groupBy(_rel(F.col("warc_path")).alias("warc_path")).agg(
        F.count_if(~gap).alias("n_records"), F.count_if(gap).cast("int").alias("n_errors"),
        F.bool_or(gap & (F.col("payload_error") == "missing file")).alias("missing"))


@query("http_body_decode", f"""{RESP}
SELECT replace(warc_path, '.warc.gz', '.warc') AS warc_path, rec_idx, try(decode(payload)) AS html,
       CAST(octet_length(payload) AS BIGINT) AS n_bytes, CAST(NULL AS VARCHAR) AS payload_error
FROM responses""")
def q_http_body_decode(spark, sf):
    r = _fixture_records(spark, sf, "warc", encodings=True)
    return r.select(_rel(F.col("warc_path")).alias("warc_path"), "rec_idx",
                    strict_utf8(F.col("payload")).alias("html"),
                    F.octet_length("payload").cast("long").alias("n_bytes"), "payload_error")


@query("arc_scan", f"""{RESP}
SELECT replace(warc_path, '.warc.gz', '.arc.gz') AS warc_path, rec_type,
       {S.header('rec_headers', 'WARC-Target-URI')} AS url,
       {S.header('http_headers', 'Content-Type')} AS content_type,
       CAST(http_status AS BIGINT) AS http_status, try(decode(payload)) AS html
FROM responses WHERE rec_type = 'response'""")
def q_arc_scan(spark, sf):
    r = _fixture_records(spark, sf, "arc")
    v = _scan_view(r)
    return v.where(F.col("rec_type") == "response").select(
        "warc_path", "rec_type", "url", "content_type", "http_status", "html")


# ---------------------------------------------------------------- lake sink / read

def _lake_dir(spark, name):
    from ..session import scratch_dir
    return scratch_dir(spark, name)


_ARTS_SQL = f"{DISP}\nSELECT {ARTICLE_COLS} FROM disp WHERE disposition = 'extracted'"


@query("lake_write_roundtrip", _ARTS_SQL)
def q_lake_write_roundtrip(spark, sf):
    from ..sources.lake import read_lake, write_lake
    url = _lake_dir(spark, "lake")
    write_lake(articles(X.disp(spark, sf)), url)
    return read_lake(spark, url)


@query("lake_write_custom_keys", _ARTS_SQL)
def q_lake_write_custom_keys(spark, sf):
    from ..sources.lake import read_lake, write_lake
    url = _lake_dir(spark, "lake-keys")
    write_lake(articles(X.disp(spark, sf)), url, keys=("language", "source_domain"))
    return read_lake(spark, url)


@query("max_records_per_file", f"""{DISP}
SELECT date_crawled, language, count(*) AS n_rows, true AS files_ok, true AS enough_files
FROM disp WHERE disposition = 'extracted' GROUP BY date_crawled, language""")
def q_max_records_per_file(spark, sf):
    from ..sources.lake import read_lake, write_lake
    url = _lake_dir(spark, "lake-cap")
    write_lake(articles(X.disp(spark, sf)), url, max_records=3)
    lake = read_lake(spark, url).select("date_crawled", "language",
                                        F.col("_metadata.file_path").alias("f"))
    per_file = lake.groupBy("date_crawled", "language", "f").count()
    return per_file.groupBy("date_crawled", "language").agg(
        F.sum("count").alias("n_rows"),
        F.bool_and(F.col("count") <= 3).alias("files_ok"),
        (F.count("f") >= F.ceil(F.sum("count") / 3.0)).alias("enough_files"))


@query("lake_append_twice", f"""{DISP}
SELECT date_crawled, language, 2 * count(*) AS n FROM disp
WHERE disposition = 'extracted' GROUP BY date_crawled, language""")
def q_lake_append_twice(spark, sf):
    from ..sources.lake import read_lake, write_lake
    url = _lake_dir(spark, "lake-append")
    arts = articles(X.disp(spark, sf))
    write_lake(arts, url)
    write_lake(arts, url)
    return read_lake(spark, url).groupBy("date_crawled", "language").agg(
        F.count(F.lit(1)).alias("n"))


@query("lake_read", f"""{DISP}
SELECT {ARTICLE_COLS} FROM disp WHERE disposition = 'extracted' AND language = 'en'""")
def q_lake_read(spark, sf):
    from ..sources.lake import read_lake, write_lake
    url = _lake_dir(spark, "lake-read")
    write_lake(articles(X.disp(spark, sf)), url)
    return read_lake(spark, url).where(F.col("language") == "en")


@query("articles_by_warc", f"""{DISP}
SELECT split_part(string_split(warc_path, '/')[-1], '.', 1) AS warc_basename, count(*) AS n
FROM disp WHERE disposition = 'extracted' GROUP BY 1""")
def q_articles_by_warc(spark, sf):
    from ..sources.lake import read_lake, write_lake
    url = _lake_dir(spark, "lake-by-warc")
    arts = articles(X.disp(spark, sf), ["warc_path"]).withColumn(
        "warc_basename", P.basename(F.col("warc_path")))
    write_lake(arts, url, keys=("warc_basename",), extra=("warc_basename",))
    return read_lake(spark, url, extra=("warc_basename",)).groupBy("warc_basename").agg(
        F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- index scan

_INDEX_LAYOUT = "{root}/crawl-data/CC-NEWS/yyyy={yyyy}/MM={MM}"


@query("warc_index_scan", f"""{RESP}, {_PATHS_SQL}
SELECT warc_path, warc_url, basename, strftime(crawl_ts, '%Y-%m-%d %H:%M:%S') AS crawl_ts,
       serial FROM parsed""")
def q_warc_index_scan(spark, sf):
    root = _lake_dir(spark, "index")
    paths = responses(spark, sf).select("warc_path").distinct()
    ts = P.crawl_ts(F.col("warc_path"))
    (paths.select("warc_path", F.date_format(ts, "yyyy").alias("yyyy"),
                  F.date_format(ts, "MM").alias("MM"))
     .write.partitionBy("yyyy", "MM").option("compression", "gzip")
     .text(f"{root}/crawl-data/CC-NEWS"))
    # The window spans a month before and after the data: those listings do
    # not exist and are skipped.
    idx = I.warc_index(spark, root, datetime(2020, 12, 1), datetime(2021, 3, 1),
                       layout=_INDEX_LAYOUT)
    return idx.select("warc_path", "warc_url", "basename",
                      F.date_format("crawl_ts", "yyyy-MM-dd HH:mm:ss").alias("crawl_ts"),
                      "serial")


# ---------------------------------------------------------------- whole run

RUN_WINDOW = (datetime(2021, 1, 1, 0, 0, 0), datetime(2021, 1, 1, 12, 0, 0))


def _archive(spark, sf) -> str:
    """Archive files and a gzip monthly index written from ``responses``."""
    from ..sources.fixtures import write_fixture
    root = _lake_dir(spark, "archive")
    r = responses(spark, sf)
    write_fixture(r, root).count()
    ts = P.crawl_ts(F.col("warc_path"))
    (r.select("warc_path", F.date_format(ts, "yyyy").alias("yyyy"),
              F.date_format(ts, "MM").alias("MM")).distinct()
     .write.partitionBy("yyyy", "MM").option("compression", "gzip")
     .text(f"{root}/listing"))
    return root


def _run(spark, sf):
    from ..plans.pipeline import run
    root = _archive(spark, sf)
    lake = _lake_dir(spark, "run-lake")
    res = run(spark, root, ["*"], *RUN_WINDOW, lake, profile=X.profile(spark, sf),
              index_root=root, layout="{root}/listing/yyyy={yyyy}/MM={MM}")
    return res, lake


_RUN_FILTER = (f"crawl_ts_of_path >= TIMESTAMP '{RUN_WINDOW[0]:%Y-%m-%d %H:%M:%S}' AND "
               f"crawl_ts_of_path < TIMESTAMP '{RUN_WINDOW[1]:%Y-%m-%d %H:%M:%S}'")
_RUN_DISP = f"""{DISP},
disp_w AS (SELECT *, {S.crawl_ts('warc_path')} AS crawl_ts_of_path FROM disp)"""


@query("run_end_to_end", f"""{_RUN_DISP}
SELECT {ARTICLE_COLS} FROM disp_w WHERE disposition = 'extracted' AND {_RUN_FILTER}""")
def q_run_end_to_end(spark, sf):
    from ..sources.lake import read_lake
    _, lake = _run(spark, sf)
    return read_lake(spark, lake)


@query("run_resume", f"""{_RUN_DISP}
SELECT {ARTICLE_COLS} FROM disp_w WHERE disposition = 'extracted' AND {_RUN_FILTER}""")
def q_run_resume(spark, sf):
    """The lake after a run that ended between two commits and was started again."""
    from ..plans.resume import run_resumable
    from ..sources.lake import read_lake
    root, lake, ledger = _archive(spark, sf), _lake_dir(spark, "resume-lake"), _lake_dir(spark, "resume-ledger")
    for commits in (1, None):
        run_resumable(spark, root, ["*"], *RUN_WINDOW, lake, ledger, profile=X.profile(spark, sf), files_per_commit=8,
                      max_commits=commits, index_root=root, layout="{root}/listing/yyyy={yyyy}/MM={MM}")
    return read_lake(spark, lake)


@query("run_counters", f"""{_RUN_DISP}
SELECT warc_path, {_counts_sql()} FROM disp_w WHERE {_RUN_FILTER} GROUP BY warc_path""")
def q_run_counters(spark, sf):
    res, _ = _run(spark, sf)
    return res.per_warc.select(_rel(F.col("warc_path")).alias("warc_path"), "extracted",
                               "discarded", "errored", "total")


@query("index_union", f"""{RESP}, {_PATHS_SQL}
SELECT warc_path, serial FROM parsed""")
def q_index_union(spark, sf):
    """Union-all of monthly listings: the paths are split over two month
    directories (by serial parity); reading the window's months unions them."""
    root = _lake_dir(spark, "index-union")
    paths = responses(spark, sf).select("warc_path").distinct()
    month = F.when(P.serial(F.col("warc_path")) % 2 == 0, F.lit("01")).otherwise(F.lit("02"))
    (paths.select("warc_path", F.lit("2021").alias("yyyy"), month.alias("MM"))
     .write.partitionBy("yyyy", "MM").option("compression", "gzip")
     .text(f"{root}/crawl-data/CC-NEWS"))
    idx = I.warc_index(spark, root, datetime(2021, 1, 1), datetime(2021, 3, 1),
                       layout=_INDEX_LAYOUT)
    return idx.select("warc_path", "serial")
