"""The stack of open elements: containers, unclosed elements, tag soup."""

import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from warcsift.operators import html as H
from warcsift.plans import sql as S

STOP = "it is the one of the many that we have in the"


def main(spark, page):
    df = spark.createDataFrame([(page,)], "html string").select(H.blocks(F.col("html")).alias("b"))
    return df.select(H.main_text(F.col("b")).alias("m")).first()["m"]


CASES = [
    # text before and after an inner container belongs to the outer one
    ("<article>a<div>b</div>c</article>d", [("a", "article", [0, 1]), ("b", "div", [0, 1, 2]), ("c", "article", [0, 1]), ("d", "", [0])]),
    # what is never closed ends with its parent, or with the page
    ("<div><nav>menu</div>text", [("text", "", [0])]),
    ("a<nav>b<p>c", [("a", "", [0])]),
    ("<p>a<script>b</p><p>c", [("a", "p", [0])]),
    ("<p>a</p><style>x", [("a", "p", [0])]),
    ("a<!-- b", [("a", "", [0])]),
    ("a<!-- <script> -->b", [("a b", "", [0])]),
    ("a<script>x='<!--'</script>b<p>c", [("a b", "", [0]), ("c", "p", [0])]),
    ("a<script", [("a", "", [0])]),
    ("a <b", [("a", "", [0])]),
    ("1 < 2 and 3 > 2", [("1 < 2 and 3 > 2", "", [0])]),
    # a block tag ends an open p; </p> without one is ignored
    ("<p>a<div>b</p>c</div>d", [("a", "p", [0]), ("b", "div", [0, 2]), ("c", "div", [0, 2]), ("d", "", [0])]),
    # list items and table cells end the one before, but not an outer one
    ("<ul><li>a<li>b<ul><li>c</ul>d<li>e</ul>f", [("a", "li", [0]), ("b", "li", [0]), ("c", "li", [0]), ("d", "li", [0]), ("e", "li", [0]), ("f", "", [0])]),
    ("<li><div>a<li>b", [("a", "div", [0, 2]), ("b", "li", [0])]),
    ("<dl><dt>a<dd>b<dt>c</dl>d", [("a", "dt", [0]), ("b", "dd", [0]), ("c", "dt", [0]), ("d", "", [0])]),
    ("<table><tr><td>a<td>b<tr><td>c</table>d", [("a", "td", [0, 3]), ("b", "td", [0, 4]), ("c", "td", [0, 6]), ("d", "", [0])]),
    ("<table><tr><td><table><tr><td>a</table>b<td>c", [("a", "td", [0, 3, 6]), ("b", "td", [0, 3]), ("c", "td", [0, 8])]),
    # an end tag closes nothing outside of its table
    ("<div><table><tr><td>a</div>b</table>c</div>d", [("a", "td", [0, 1, 4]), ("b", "td", [0, 1, 4]), ("c", "div", [0, 1]), ("d", "", [0])]),
    ("<div><section>a</div>b", [("a", "section", [0, 1, 2]), ("b", "", [0])]),
    ("</div>a</section>", [("a", "", [0])]),
    # headings, the head
    ("<h1>a<h2>b</h3>c", [("a", "h1", [0]), ("b", "h2", [0]), ("c", "", [0])]),
    ("<head><title>t</title><meta x>y<body>a", [("a", "", [0])]),
    ("<head><meta x>y<p>a", [("a", "p", [0])]),
    ("<title>t<p>a", []),
    ("<DIV Class=x>a</DIV >b<division>c", [("a", "div", [0, 1]), ("bc", "", [0])]),
    ("", []),
]


def test_blocks(spark):
    df = spark.createDataFrame([(i, page) for i, (page, _) in enumerate(CASES)], "i int, html string")
    rows = df.select("i", H.blocks(F.col("html")).alias("b")).collect()
    got = {r["i"]: [(b["text"], b["tag"], list(b["path"])) for b in r["b"]] for r in rows}
    for i, (page, want) in enumerate(CASES):
        assert got[i] == want, page


def test_scores_reach_parent_and_grandparent(spark):
    """Three paragraphs in divs of their own: none of the divs wins, their article does."""
    def inner(n):
        return f"<div><p>{n} {STOP}</p></div>"
    page = f"<body><div><p>{STOP} teaser {STOP}</p></div><article>{inner('one')}{inner('two')}<p>own {STOP}</p>{inner('three')}</article></body>"
    assert [t.split()[0] for t in main(spark, page).split("\n\n")] == ["one", "two", "own", "three"]


def test_text_round_an_inner_container_is_kept(spark):
    page = f"<article><p>before {STOP}</p><div class=ad>buy</div><p>after {STOP}</p></article><div><p>{STOP}</p></div>"
    assert main(spark, page) == f"before {STOP}\n\nafter {STOP}"


def test_an_unclosed_script_is_no_text(spark):
    page = f"<article><p>{STOP}</p><script>var a = 'the of and in it is that we have'; <p>the of and in it is"
    assert main(spark, page) == STOP


def soup(seed, n):
    r = random.Random(seed)
    tags = [*H.STACK_TAGS, "body", "span", "a", "script", "style", "!--", "br"]
    out = []
    for _ in range(n):
        t = r.choice(tags)
        out.append(r.choice([f"<{t}>", f"</{t}>", f"<{t} id='x'>", f"<{t.upper()}>", r.choice(["the of and it is", "x", "<", "-->", "&amp;", " "])]))
    return "".join(out)


def test_tag_soup_in_both_engines(spark):
    pages = [(i, "u", soup(i, 5 + i % 120)) for i in range(150)] + [(1000, "u", "<div>" * 400 + "deep" + "</div>" * 300 + "less"),
                                                                  (1001, "u", "".join(f"<div><p>{k}</div>" for k in range(200))), (1002, "u", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = df.select("page_id", H.blocks(F.col("html")).alias("b")).select(
        "page_id", F.to_json("b").alias("b"), F.coalesce(H.main_text(F.col("b")), F.lit("")).alias("m")).collect()
    import json
    got = {r["page_id"]: (json.loads(r["b"]) if r["b"] else None, r["m"]) for r in got}
    con = duckdb.connect()
    con.register("soup", df.toPandas())
    ctes, last = S.blocks_ctes("soup", "page_id, url, html")
    want = con.execute(f"WITH RECURSIVE {ctes} SELECT page_id, blocks, {S.main_text()} FROM {last}").fetchall()
    assert len(want) == len(pages)
    for page_id, b, m in want:
        assert got[page_id] == (b, m or ""), pages[page_id] if page_id < 150 else page_id


def seconds(spark, page):
    df = spark.createDataFrame([(page,)], "html string").select(H.main_text(H.blocks(F.col("html"))).alias("m"))
    t = time.time()
    df.collect()
    return time.time() - t


@pytest.mark.parametrize("piece", ["<script>", "<script ", "<!--", "<div>a", "<a>x"])
def test_time_grows_with_the_page(spark, piece):
    seconds(spark, piece * 100)
    short, long = (min(seconds(spark, piece * (n // len(piece))) for _ in range(2)) for n in (20_000, 80_000))
    assert long < 9 * short + 1
