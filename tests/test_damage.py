"""Damaged, missing and mislabelled input; what a run reports and leaves behind."""

import fnmatch
import gzip
import os
import subprocess
import sys
import zlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from warcsift.contracts import check_limit
from warcsift.functions.globs import globs_to_python_regex, url_matches_any
from warcsift.functions.text import html_text
from warcsift.operators import html as H
from warcsift.operators.language import train_profile
from warcsift.functions.globs import glob_elements, glob_host, glob_regex, globs_to_regex
from warcsift.operators.records import url_semi_join
from warcsift.plans.pipeline import extract_warc, run
from warcsift.sources.framing import _decode_body
from warcsift.sources.warc import read_warc, scan_errors

from helpers import request, response, warcinfo, write

DAY = (datetime(2021, 1, 1), datetime(2021, 1, 2))
BODY = b"<html>" + bytes(range(32, 127)) * 40 + b"</html>"


def archive_name(n):
    return f"CC-NEWS-2021010100{n:02}00-{n:05}.warc.gz"


@pytest.fixture(scope="module")
def profile(spark):
    p = train_profile(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).persist()
    p.count()
    return p


@pytest.fixture()
def broken(tmp_dir):
    """Four listed files: sound, corrupt in its second record, cut in its third, missing."""
    folder = os.path.join(tmp_dir, "crawl-data", "CC-NEWS", "2021", "01")
    records = [response(url=f"https://news.example.com/{i}") for i in range(3)]
    sound = [gzip.compress(r, mtime=0) for r in records]
    flipped = bytearray(sound[1])
    flipped[len(flipped) // 2] ^= 0x55
    write(folder, archive_name(0), records)
    for n, parts in ((1, [sound[0], bytes(flipped), sound[2]]), (2, [*sound[:2], sound[2][:-30]])):
        with open(os.path.join(folder, archive_name(n)), "wb") as f:
            f.write(b"".join(parts))
    with gzip.open(os.path.join(folder, "warc.paths.gz"), "wt") as f:
        f.write("".join(f"crawl-data/CC-NEWS/2021/01/{archive_name(n)}\n" for n in range(4)))
    return tmp_dir


def test_a_run_counts_only_records_and_reports_the_gaps(spark, broken, profile, tmp_dir):
    res = run(spark, broken, ["*"], *DAY, os.path.join(tmp_dir, "lake"), profile=profile, report_every=1)
    assert res.n_warcs == len(res.files) == 4
    assert res.counters["total"] == 3 + 2 + 2 and res.counters["extracted"] == 7
    gaps = {r["warc_path"][-13:-8]: r["message"] for r in res.errors.collect()}
    assert set(gaps) == {"00001", "00002", "00003"}
    assert "corrupt" in gaps["00001"] and "truncated" in gaps["00002"] and gaps["00003"] == "missing file"
    per = {r["warc_path"][-13:-8]: r["total"] for r in res.per_warc.collect()}
    assert per == {"00000": 3, "00001": 2, "00002": 2}
    assert res.progress.count() == 2 + 1 + 1
    plan = res.per_warc._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan                  # the language is not detected again
    res.release()


def test_failfast_raises_for_every_kind_of_damage(spark, broken):
    folder = os.path.join(broken, "crawl-data", "CC-NEWS", "2021", "01")
    for n in (1, 2, 3):
        with pytest.raises(Exception, match="00001|00002|00003"):
            read_warc(spark, [os.path.join(folder, archive_name(n))], mode="FAILFAST").collect()
    assert read_warc(spark, [os.path.join(folder, archive_name(0))], mode="FAILFAST").count() == 3
    assert scan_errors(read_warc(spark, os.path.join(folder, "nowhere.warc.gz"))).count() == 1


@pytest.mark.parametrize("materialize", ["table", "cache"])
def test_release_leaves_nothing(spark, broken, tmp_dir, materialize):
    def state():
        tables = sorted(t.name for t in spark.catalog.listTables())
        kept = sorted(f for d, _, fs in os.walk(scratch) for f in fs)
        return tables, kept, spark.sparkContext._jsc.getPersistentRDDs().size()

    scratch = os.path.join(tmp_dir, "scratch")
    os.makedirs(scratch)
    before = state()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id >= 0")
    res = run(spark, broken, ["*"], *DAY, os.path.join(tmp_dir, "lake"), training_docs=docs, materialize=materialize,
              scratch="file:" + scratch, num_partitions=2)
    assert res.per_warc.count() == 3 and state() != before
    res.release()
    assert state() == before


def test_limit_zero_reads_nothing(spark, broken, profile, tmp_dir):
    assert check_limit(0) == 0
    path = os.path.join(broken, "crawl-data", "CC-NEWS", "2021", "01", archive_name(0))
    res = extract_warc(spark, path, ["*"], profile, limit=0)
    assert res.counters == {"extracted": 0, "discarded": 0, "errored": 0, "total": 0}


def test_payload_only_where_headers_allow_an_article(spark, tmp_dir):
    records = [warcinfo(), request(), response(), response(ct="application/json; charset=utf-8"), response(ct=None),
               response(ct="text/html; charset=iso-8859-1"), response(url="https://other.example.org/x"), response(ct="text/html; charset=UTF-8")]
    path = write(tmp_dir, archive_name(5), records)
    rx = globs_to_python_regex(["https://news.*", "[ab]?c.d*"])
    rows = read_warc(spark, path, payload="html", url_regex=rx).orderBy("rec_idx").collect()
    assert [r["payload"] is not None for r in rows] == [False, False, True, False, False, False, False, True]
    assert len(rows) == len(records)
    assert all(r["rec_headers"] for r in rows)


def test_batches_are_bounded_by_bytes(spark, tmp_dir):
    path = write(tmp_dir, archive_name(6), [response(body=b"x" * 5000) for _ in range(20)])
    rows = read_warc(spark, path, batch_bytes=6000).collect()
    assert [r["rec_idx"] for r in sorted(rows, key=lambda r: r["rec_idx"])] == list(range(20))
    assert all(len(r["payload"]) == 5000 for r in rows)


@pytest.mark.parametrize("stored, headers, want", [
    (BODY, "gzip", BODY), (BODY, "deflate", BODY), (gzip.compress(BODY), "gzip, identity", BODY), (gzip.compress(BODY), "X-GZIP", BODY),
    (gzip.compress(BODY[:9]) + gzip.compress(BODY[9:]), "gzip", BODY), (gzip.compress(BODY) + b"\0\0\0", "gzip", BODY),
    (zlib.compress(BODY), "deflate", BODY), (zlib.compress(BODY)[2:-4], "deflate", BODY), (zlib.compress(gzip.compress(BODY)), "gzip, deflate", BODY),
    (gzip.compress(BODY)[:-8], "gzip", BODY), (b"", "gzip", b""), (BODY, "identity", BODY),
])
def test_body_codings(stored, headers, want):
    assert _decode_body(stored, [("Content-Encoding", headers)]) == (want, None)


@pytest.mark.parametrize("stored, want", [
    (b"5\r\nhello\r\n0\r\n\r\n", b"hello"), (b"5;x=y\r\nhello\r\n3\r\nabc\r\n0\r\n\r\n", b"helloabc"), (b"plain text", b"plain text"),
    (b"9\r\nhello", b"hello"), (b"5\r\nhello\r\n", b"hello"), (b"", b""), (b"zz\r\nplain", b"zz\r\nplain"),
])
def test_chunked_bodies(stored, want):
    assert _decode_body(stored, [("Transfer-Encoding", "chunked")]) == (want, None)


def test_a_cut_body_keeps_what_it_has():
    got, error = _decode_body(gzip.compress(os.urandom(30_000))[:20_000], [("Content-Encoding", "gzip")])
    assert error is None and 15_000 < len(got) < 30_000


def test_semi_join_takes_any_number_of_patterns(spark):
    urls = ["https://a.site7.example.com/x", "https://site7.example.com/x", "https://site7.example.com.evil.org/x", "http://e.org/q://b.site9.example.com/",
            "ftp://nothing", None, "https://x.example.net/end.pdf", "https://site12000.example.com/y"]
    globs = [f"*://*.site{i}.example.com/*" for i in range(11_000)] + ["https://site12000.example.com/*", "*.pdf", "[!a-z]*", None]
    records = spark.createDataFrame(list(enumerate(urls)), "id int, url string")
    got = url_semi_join(records, spark.createDataFrame([(g,) for g in globs], "glob string"))
    assert sorted(r["id"] for r in got.collect()) == [0, 3, 6, 7]
    few = [g for g in globs if g][-200:] + globs[:20]
    want = records.where(F.coalesce(url_matches_any(F.col("url"), few), F.lit(False)))
    got = url_semi_join(records, spark.createDataFrame([(g,) for g in few], "glob string"))
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want.collect())
    assert url_semi_join(records, spark.createDataFrame([], "glob string")).count() == 0
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_semi_join_of_globs_without_a_host(spark):
    """100,000 of them, found by their rarest literal piece; odd ones against fnmatch."""
    urls = [f"https://s{i % 7}.example.org/a/{i}/page{i * 37 % 5000}.html" for i in range(3000)] + ["", "a", "ab", "x\ny", "é", "😀b", "[", "a]b", "zz^z", "a\0bc"]
    odd = ["?", "", "a?", "*\n*", "?b", "[[]", "[]a]]*", "*[!-a]b", "zz[^z]z", "[z-a]", "[!z-a]", "*[", "a\0b*", "*ge4?.h*", "[😀é]*", "*/a/12[0-9]/*"]
    many = [f"*/page{i}.*" for i in range(50_000)] + [f"*no-such-{i}?" for i in range(50_000)]
    records = spark.createDataFrame(list(enumerate(urls)), "id int, url string")
    got = url_semi_join(records, spark.createDataFrame([(g,) for g in many], "glob string"))
    assert {r["id"] for r in got.collect()} == set(range(3000))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "collect_set" not in plan
    for part in (odd, odd[:8], odd[8:12]):
        got = url_semi_join(records, spark.createDataFrame([(g,) for g in part], "glob string"))
        assert sorted(r["url"] for r in got.collect()) == sorted(u for u in urls if any(fnmatch.fnmatchcase(u, g) for g in part))


def test_semi_join_broadcasts_no_pieces_of_urls(spark, tmp_dir):
    """Read from files, a table's pieces look as small as its URLs; they are many times larger."""
    urls = [f"https://s{i % 7}.example.org/a/{i}/page{i * 37 % 500}.html" for i in range(1000)]
    globs = [f"*://s{i}.example.org/a/1*" for i in range(3)] + [f"*/page{i}.*" for i in range(40)] + ["*/a/12[0-9]/*"]
    spark.createDataFrame(list(enumerate(urls)), "id int, url string").write.parquet(f"{tmp_dir}/urls")
    spark.createDataFrame([(g,) for g in globs], "glob string").write.parquet(f"{tmp_dir}/globs")
    got = url_semi_join(spark.read.parquet(f"{tmp_dir}/urls"), spark.read.parquet(f"{tmp_dir}/globs"))
    assert sorted(r["url"] for r in got.collect()) == sorted(u for u in urls if any(fnmatch.fnmatchcase(u, g) for g in globs))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "BroadcastHashJoin" in x and " Inner" in x]


def test_globs_translated_in_columns(spark):
    globs = ["*", "a*b", "**?", "[a-c]x", "[!a-c]", "[]]", "[!]]", "[", "[]", "[!]", "[z-a]", "[!z-a]", "[a-]", "[--0]", "x[é-ü]\n", "a.b+c(d)", "[a][", "[^a]"]
    texts = ["", "a", "b", "ab", "axb", "bx", "]", "[", "[]", "[!]", "-", ".", "xë\n", "a.b+c(d)", "a[", "^", "é", "!"]
    rows = spark.createDataFrame([(g,) for g in globs], "g string").select("g", glob_regex(glob_elements(F.col("g"))).alias("rx"))
    match = rows.crossJoin(spark.createDataFrame([(t,) for t in texts], "t string")).select("g", "t", F.expr("coalesce(t rlike rx, false)").alias("m"))
    for r in match.collect():
        assert r["m"] == fnmatch.fnmatchcase(r["t"], r["g"]), r
    assert {r["g"] for r in rows.collect() if r["rx"] is None} == {g for g in globs if globs_to_regex([g]) is None}


def test_host_of_a_glob(spark):
    cases = {"*://*.a.org/*": "a.org", "https://b.org/x": "b.org", "https://b.org*": None, "*": None, "*://*a.org/": None, "[x://a.org/": None,
             "*://?.org/": None, "http://a.org:80/*": "a.org:80"}
    rows = spark.createDataFrame([(g,) for g in cases], "g string").select("g", glob_host(F.col("g")).alias("h"))
    assert {r["g"]: r["h"] for r in rows.collect()} == cases


def test_character_references_with_leading_zeros(spark):
    rows = [("&#00000065;&#x0000201C;b", "A“b"), ("&#" + "0" * 300 + "66; x", "B x"), ("&#99999999999; &#xFFFFFFFFFF;", "&#99999999999; &#xFFFFFFFFFF;"),
            ("no references < here", "no references < here"), ("a &amp; b", "a & b")]
    df = spark.createDataFrame(rows, "s string, want string")
    for r in df.select("want", html_text(F.col("s")).alias("t")).collect():
        assert r["t"] == r["want"]


def test_main_text_prefers_a_section_with_well_written_neighbours(spark):
    """Hand-made page: both sections have the same stop words, but the second follows
    a block with more than five, so it is the one chosen. Each is in an element of its
    own, which takes the half that goes outward."""
    plain = "<div><p>the one of the four in a row here</p></div>"
    long = "<p>it is the first time that the city of the north has been in the news</p>"
    page = (f"<html><body><main>{plain}</main><main><section>{long}</section></main><main><div><p>the two of the four in a row here</p>"
            "<p>and the next of the same is in it too</p></div></main></body></html>")
    df = spark.createDataFrame([(page,)], "html string").select(H.blocks(F.col("html")).alias("b"))
    got = df.select(H.main_text(F.col("b")).alias("m")).first()["m"]
    assert got == "the two of the four in a row here\n\nand the next of the same is in it too"


def test_profile_has_no_window(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id >= 0")
    assert "Window" not in train_profile(docs)._jdf.queryExecution().executedPlan().toString()


def test_package_can_be_shipped(tmp_dir):
    """Started elsewhere and without PYTHONPATH, the scan works after ship_package."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = write(tmp_dir, archive_name(8), [response()])
    script = (f"import sys; sys.path.insert(0, {root!r})\n"
              "from warcsift.session import get_spark, ship_package\n"
              "from warcsift.sources.warc import read_warc\n"
              "spark = get_spark('local[2]', 2)\nship_package(spark)\n"
              f"assert read_warc(spark, {path!r}).count() == 1\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", script], cwd=tmp_dir, env=env, check=True, timeout=300, capture_output=True)


def test_a_cluster_without_shared_folder_is_refused(monkeypatch):
    from warcsift.session import checkpoint_root

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


