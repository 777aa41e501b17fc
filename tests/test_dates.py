"""Publish dates in the spellings and places that pages use."""

import duckdb
from pyspark.sql import functions as F

from warcsift.operators import html as H
from warcsift.plans import sql as S

DATES = {
    "2021-3-4": "2021-03-04", " 2021-03-04T10:00:00Z": "2021-03-04", "2021/3/4 10:00": "2021-03-04", "20210304T1000": "2021-03-04",
    "4 March 2021": "2021-03-04", "Thu, 04 Mar 2021 10:00:00 GMT": "2021-03-04", "4. Mar. 2021": "2021-03-04", "March 4, 2021": "2021-03-04",
    "Thursday, March 4 2021": "2021-03-04", "04.03.2021": "2021-03-04", "4. 3. 2021": "2021-03-04", "2021-02-30": None, "2021-13-01": None,
    "31.04.2021": None, "2021-03-045": None, "202103041": None, "12021-03-04": None, "0021-03-04": None, "yesterday": None, "": None,
    "3/4/2021": None, "2020-2-29": "2020-02-29",
}
LD = '<script type="application/ld+json">%s</script>'
PAGES = [
    ("https://e.org/2021/3/4/", "", "2021-03-04"), ("https://e.org/2021/3/4", "", "2021-03-04"), ("https://e.org/2021/3/45/x", "", None),
    ("https://e.org/a-2021-3-4.html", "", "2021-03-04"), ("https://e.org/id12021-3-4", "", None),
    ("https://e.org/2021/13/45/", '<meta name=x><meta name="date" content="4 March 2021">', "2021-03-04"),
    ("u", '<meta name="date" content="soon"><META Name="DC.Date" content="2021-3-4">', "2021-03-04"),
    ("u", '<meta content="2021-3-4" itemprop="datePublished">', "2021-03-04"), ("u", '<meta name="update" content="2021-3-4">', None),
    ("u", '<time datetime="x"></time><time pubdate datetime="2021-03-04">', "2021-03-04"),
    ("u", LD % '{"datePublished":"2021-3-4"}', "2021-03-04"), ("u", LD % '[{"a":1},{"datePublished":"March 4, 2021"}]', "2021-03-04"),
    ("u", LD % '{"@graph":[{"a":1},{"datePublished":"2021-02-30"},{"datePublished":"2021-3-4"}]}', "2021-03-04"),
    ("u", LD % '[{"@graph":[{"datePublished":"2021-3-4"}]}]', "2021-03-04"), ("u", LD % "{broken" + LD % '{"datePublished":"2021-3-4"}', "2021-03-04"),
    ("u", LD % '{"datePublished":"2021-3-4",}', "2021-03-04"), ("u", LD % "null" + LD % "7" + LD % "", None),
    ("u", LD % '{"a":{"datePublished":"2021-3-4"}}', "2021-03-04"), ("u", LD % '{"datePublished":{"x":1}}', None), ("u", "", None), (None, None, None),
]


def test_spellings_in_both_engines(spark):
    df = spark.createDataFrame([(d,) for d in DATES], "d string")
    assert {r["d"]: r["got"] for r in df.select("d", H.loose_date(F.col("d")).alias("got")).collect()} == DATES
    con = duckdb.connect()
    con.register("t", df.toPandas())
    assert dict(con.execute(f"SELECT d, {S.loose_date('d')} FROM t").fetchall()) == DATES


def test_places_in_both_engines(spark):
    df = spark.createDataFrame([(i, *p[:2]) for i, p in enumerate(PAGES)], "i int, url string, html string")
    want = {i: p[2] for i, p in enumerate(PAGES)}
    assert {r["i"]: r["got"] for r in df.select("i", H.publish_date(F.col("url"), F.col("html")).alias("got")).collect()} == want
    con = duckdb.connect()
    con.register("t", df.toPandas())
    assert dict(con.execute(f"SELECT i, {S.publish_date()} FROM t").fetchall()) == want
