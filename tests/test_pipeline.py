"""End to end: archive files + index -> run() -> lake; counters; extraction rules."""

import gzip
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from helpers import PAGE
from warcsift.operators import counters as C
from warcsift.operators import html as H
from warcsift.operators.language import detect_language, train_profile
from warcsift.plans.pipeline import run
from warcsift.sources.fixtures import write_fixture
from warcsift.sources.lake import read_lake, rows_per_file, write_lake
from warcsift.sources.responses import load_table, responses


@pytest.fixture(scope="module")
def archive(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="warcsift-archive-")
    rep = write_fixture(responses(spark, SF001), root).collect()
    rel = sorted(r["warc_path"].split("/crawl-data/", 1)[1] for r in rep)
    d = os.path.join(root, "crawl-data", "CC-NEWS", "2021", "01")
    with open(os.path.join(d, "warc.paths.gz"), "wb") as f:
        f.write(gzip.compress("\n".join("crawl-data/" + p for p in rel).encode()))
    return root


@pytest.fixture(scope="module")
def profile(spark):
    p = train_profile(load_table(spark, SF001, "documents")).persist()
    p.count()
    return p


def test_run_end_to_end(spark, archive, profile, tmp_dir):
    lake = os.path.join(tmp_dir, "lake")
    res = run(spark, archive, ["*"], datetime(2021, 1, 1), datetime(2021, 1, 2), lake,
              profile=profile, max_records=5)
    assert len(res.files) == 3          # 50 pages / 20 per file; all on 2021-01-01
    c = res.counters
    assert c["total"] == 50
    assert c["extracted"] + c["discarded"] + c["errored"] == c["total"]
    arts = read_lake(spark, lake)
    assert arts.count() == c["extracted"] > 0
    assert arts.columns == ["title", "main_text", "url", "source_domain", "date_publish",
                            "date_crawled", "language"]
    assert {r[0] for r in arts.select("date_crawled").distinct().collect()} == {"2021-01-01"}
    assert rows_per_file(arts).agg(F.max("count")).collect()[0][0] <= 5
    per = res.per_warc.agg(*[F.sum(k).alias(k) for k in c]).collect()[0].asDict()
    assert per == c
    # the same counters from the plain aggregate (observe == groupBy)
    # and the nonempty-file rule
    assert res.per_warc.where("extracted > 0").count() <= 3


def test_run_limit_and_window(spark, archive, profile, tmp_dir):
    lake = os.path.join(tmp_dir, "lake")
    res = run(spark, archive, ["*"], datetime(2021, 1, 1, 2), datetime(2021, 1, 1, 4), lake,
              profile=profile, limit=7)
    assert len(res.files) == 1            # only file 1 (02:02:11) lies in the window
    assert res.counters["total"] == 7     # exactly `limit` records per file


def test_run_empty_patterns_rejects_all(spark, archive, profile, tmp_dir):
    res = run(spark, archive, [], datetime(2021, 1, 1), datetime(2021, 1, 2),
              os.path.join(tmp_dir, "lake"), profile=profile)
    assert res.counters["extracted"] == 0 and res.counters["discarded"] == 50


def test_run_no_files(spark, archive, profile, tmp_dir):
    res = run(spark, archive, ["*"], datetime(2020, 5, 1), datetime(2020, 5, 2),
              os.path.join(tmp_dir, "lake"), profile=profile)
    assert res.files == [] and res.counters["total"] == 0


def test_append_twice_and_dynamic_overwrite(spark, tmp_dir):
    from warcsift.plans import context as X
    arts = X.disp(spark, SF001).where("disposition = 'extracted'")
    url = os.path.join(tmp_dir, "lake")
    write_lake(arts, url)
    n = read_lake(spark, url).count()
    write_lake(arts, url)
    assert read_lake(spark, url).count() == 2 * n
    write_lake(arts, url, mode="overwrite_partitions")
    assert read_lake(spark, url).count() == n


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert len(E.queries()) >= 40
    assert set(E.oracle_sql()) <= set(E.queries())


def test_extraction_of_hand_made_page(spark):
    df = spark.createDataFrame([("https://news.example.com/2021/01/02/bridge", PAGE)],
                               "url string, html string")
    b = df.select("url", "html", H.blocks(F.col("html")).alias("b"))
    r = b.select(H.title(F.col("html"), F.col("b")).alias("t"),
                 H.main_text(F.col("b")).alias("m"),
                 H.publish_date(F.col("url"), F.col("html")).alias("d")).collect()[0]
    assert r["t"] == "Council approves the new harbour bridge plan"
    assert r["m"].startswith("The council voted on Monday")
    assert "Home" not in r["m"] and "(c) paper" not in r["m"]
    assert r["m"].count("\n\n") == 1
    assert r["d"] == "2021-01-02"


def test_title_split_and_og(spark):
    rows = [("<title>Big news today | The Paper</title>", "Big news today"),
            ("<title>Short - Much longer second part here</title>", "Much longer second part here"),
            ('<title>The Story of it all - Site</title><meta property="og:title" '
             'content="The Story of it all">', "The Story of it all"),
            ("<title></title><h1>Only a heading with words</h1>", "Only a heading with words")]
    df = spark.createDataFrame(rows, "html string, want string")
    b = df.select("html", "want", H.blocks(F.col("html")).alias("b"))
    got = b.select("want", H.title(F.col("html"), F.col("b")).alias("t")).collect()
    assert [r["t"] for r in got] == [r["want"] for r in got]


def test_publish_date_rules(spark):
    rows = [("https://x.example/2021/02/30/a", "", None),
            ("https://x.example/a-2020-05-06", "", "2020-05-06"),
            ("https://x.example/a", '<time datetime="2019-03-04T10:00">', "2019-03-04"),
            ("https://x.example/a", '{"datePublished": "2018-07-08"}', "2018-07-08"),
            ("https://x.example/a", '<meta content="2017-01-02" name="pubdate">', "2017-01-02")]
    df = spark.createDataFrame(rows, "url string, html string, want string")
    got = df.select("want", H.publish_date(F.col("url"), F.col("html")).alias("d")).collect()
    assert [r["d"] for r in got] == [r["want"] for r in got]


def test_language_detection_on_documents(spark, profile):
    docs = load_table(spark, "/root/testdata/sf0.01", "documents")
    lang = detect_language(docs.select("doc_id", "text"), ["doc_id"], "text", profile)
    j = lang.join(docs.select("doc_id", "lang"), "doc_id")
    acc = j.select(F.avg((F.col("language") == F.col("lang")).cast("double"))).collect()[0][0]
    assert acc > 0.95


def test_running_counters_and_progress(spark):
    from warcsift.plans import context as X
    d = X.disp(spark, SF001)
    run_ = C.running_counters(d, 5)
    rows = run_.collect()
    assert all(r["rec_idx"] % 5 == 0 and r["rec_idx"] > 0 for r in rows)
    assert all(r["total"] == r["rec_idx"] for r in rows)      # covers 0..idx-1
    p = C.progress_percent(run_).collect()
    assert all(0 <= r["percent"] <= 100 for r in p)


def test_language_from_title_and_errored_without_text(spark, profile, tmp_dir):
    """Body empty -> language from the title; neither -> errored (Q15)."""
    from helpers import write
    from helpers import response as resp
    from warcsift.operators.article import dispositions
    from warcsift.operators.records import classify
    from warcsift.sources.warc import read_warc
    only_title = ("<html><head><title>The council and the city approve the bridge</title>"
                  "</head><body><div>x</div></body></html>").encode()
    nothing = b"<html><body><div>1 2 3</div></body></html>"
    path = write(tmp_dir, "CC-NEWS-20210102084234-01434.warc.gz",
                 [resp(body=only_title), resp(body=nothing), resp()])
    d = dispositions(classify(read_warc(spark, path), ["*"]), profile)
    rows = {r["rec_idx"]: r for r in d.collect()}
    assert rows[0]["main_text"] == "" and rows[0]["language"] == "en"
    assert rows[0]["disposition"] == "extracted"
    assert rows[1]["disposition"] == "errored"
    assert rows[2]["disposition"] == "extracted"
    assert rows[2]["date_crawled"] == "2021-01-02"


def test_records_without_headers_are_discarded(spark, profile):
    """warcinfo records have no HTTP headers: discarded, never an error (Q5)."""
    from warcsift.plans import context as X
    d = X.disp(spark, SF001)
    kinds = {r["rec_type"]: r["d"] for r in d.groupBy("rec_type").agg(
        F.collect_set("disposition").alias("d")).collect()}
    assert kinds["warcinfo"] == ["discarded"] and kinds["request"] == ["discarded"]


def test_extract_single_warc_with_explicit_date(spark, archive, profile, tmp_dir):
    from warcsift.plans.pipeline import extract_warc
    from warcsift.sources.lake import bucket_url
    path = os.path.join(archive, "crawl-data/CC-NEWS/2021/01/CC-NEWS-20210101000000-00000.warc.gz")
    lake = os.path.join(tmp_dir, "lake")
    res = extract_warc(spark, path, ["*"], profile, date_crawled=datetime(2021, 1, 5),
                       limit=20, out_url=lake)
    got = read_lake(spark, lake)
    assert got.count() == res.counters["extracted"] > 0
    assert res.counters["total"] == 20
    assert {r[0] for r in got.select("date_crawled").distinct().collect()} == {"2021-01-05"}
    assert bucket_url("news-lake") == "s3a://news-lake/"
    with pytest.raises(TypeError):
        extract_warc(spark, 1, ["*"], profile)


def test_profile_artifact_roundtrip(spark, archive, profile, tmp_dir):
    from warcsift.operators.language import load_profile, save_profile
    from warcsift.session import fs_and_path
    url = os.path.join(tmp_dir, "profile")
    save_profile(profile, url)
    back = load_profile(spark, url)
    assert back.count() == profile.count()
    res = run(spark, archive, ["*"], datetime(2021, 1, 1), datetime(2021, 1, 2),
              os.path.join(tmp_dir, "lake"), profile=url)
    assert res.counters["extracted"] > 0
    fs, p = fs_and_path("file:" + tmp_dir)
    assert p == tmp_dir


def test_sink_splits_a_hot_key(spark, tmp_dir):
    """One language holds most rows; the rebalance spreads it over several files."""
    from warcsift.plans import context as X
    arts = X.disp(spark, "/root/testdata/sf0.01").where("disposition = 'extracted'")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "4k")
    try:
        url = os.path.join(tmp_dir, "lake")
        write_lake(arts, url)
    finally:
        spark.conf.set(key, old)
    per = rows_per_file(read_lake(spark, url)).withColumn(
        "lang", F.regexp_extract("file_path", "language=([a-z]+)", 1))
    files = {r["lang"]: r["n"] for r in per.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    en_rows = arts.where("language = 'en'").count()
    assert en_rows > arts.count() / 3
    assert files["en"] > 1
    assert read_lake(spark, url).count() == arts.count()


def test_numeric_character_references(spark):
    from warcsift.functions.text import html_text
    rows = [("it&#8217;s &#x201C;ok&#X201d;", "it’s “ok”"),
            ("&amp;#39; &#0; &#xD800; &#1114112;", "&#39; &#0; &#xD800; &#1114112;"),
            ("<p>&#65;&#66;C &lt;b&gt;</p>", "ABC <b>")]
    df = spark.createDataFrame(rows, "s string, want string")
    got = df.select("want", html_text(F.col("s")).alias("t")).collect()
    assert [r["t"] for r in got] == [r["want"] for r in got]


def test_job_survives_failed_tasks(archive, tmp_dir):
    """Every scan task fails once (as on a lost executor); with task retries the
    results equal those of an undisturbed run."""
    import json
    import subprocess
    import sys
    here = os.path.dirname(os.path.abspath(__file__))
    d = os.path.join(archive, "crawl-data", "CC-NEWS", "2021", "01")
    got = {}
    for flaky in ("0", "1"):
        out = os.path.join(tmp_dir, f"out{flaky}.json")
        subprocess.run([sys.executable, os.path.join(here, "retry_job.py"), d, out, flaky],
                       check=True, timeout=600, capture_output=True)
        got[flaky] = json.load(open(out))
    assert got["1"] == got["0"]
    assert got["1"]["counters"]["total"] == 50


def test_articles_plan_has_no_shuffle_after_the_key_table(spark, profile, tmp_dir):
    """Language aggregate and join back run on the bucketed key table: the only
    exchange left in the plan is the broadcast of the profile."""
    import re
    from tools.plan_shape import plan_shape
    from warcsift.operators.article import articles, dispositions
    from warcsift.operators.language import load_profile, save_profile
    from warcsift.operators.records import classify
    url = os.path.join(tmp_dir, "profile")
    save_profile(profile, url)
    d = dispositions(classify(responses(spark, SF001), ["*"]), load_profile(spark, url))
    shape = plan_shape(articles(d))
    ops = re.findall(r"(\w*Exchange)", shape)
    assert not ops                                 # languages are stored too
    assert "Sort" not in shape
    assert "warcsift_fields_" in shape


def test_run_with_cached_materialisation(spark, archive, profile, tmp_dir):
    res = run(spark, archive, ["*"], datetime(2021, 1, 1), datetime(2021, 1, 2),
              os.path.join(tmp_dir, "lake"), profile=profile, materialize="cache")
    assert res.counters["total"] == 50 and res.counters["extracted"] > 0
    res.release()


def test_running_counters_sum_blocks_not_records(spark):
    """A row a report enters the window; files of any length, holes and unknown sizes."""
    from warcsift.operators import counters as C
    import random
    r = random.Random(4)
    rows = [(p, i, i * 100, None if p == "c" else 9000, r.choice(["extracted", "discarded", "errored"]))
            for p, n in (("a", 30), ("b", 7), ("c", 21), ("d", 1)) for i in range(n) if (p, i) != ("c", 10)]
    d = spark.createDataFrame(rows, "warc_path string, rec_idx long, rec_offset long, file_size long, disposition string")
    for every in (1, 5, 7):
        got = {(x["warc_path"], x["rec_idx"]): (x["extracted"], x["discarded"], x["errored"], x["total"], x["rec_offset"], x["file_size"])
               for x in C.running_counters(d, every).collect()}
        want = {}
        for p, i, off, size, _ in rows:
            if i and i % every == 0:
                before = [x[4] for x in rows if x[0] == p and x[1] < i]
                want[p, i] = (*(before.count(k) for k in ("extracted", "discarded", "errored")), len(before), off, size)
        assert got == want
    plan = C.running_counters(d, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("HashAggregate")  # the window stands above the sums
