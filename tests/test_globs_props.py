"""Property tests: glob translation vs fnmatch, content type vs the Python rule."""

import fnmatch
import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from warcsift.functions.globs import glob_to_regex, globs_to_regex
from warcsift.functions.text import UTF8_HTML_RX

ALPHA = "ab/.-*?[]!^\\é\n"
patterns = st.text(alphabet=ALPHA, max_size=8)
strings = st.text(alphabet="ab/.-[]!^\\é\n", max_size=8)


def spark_match(spark, rows, rx):
    df = spark.createDataFrame([(s,) for s in rows], "s string")
    return [r[0] for r in df.select(F.col("s").rlike(rx)).collect()]


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(pat=patterns, samples=st.lists(strings, min_size=1, max_size=8))
def test_glob_matches_like_fnmatch(spark, pat, samples):
    rx = globs_to_regex([pat])
    expected = [fnmatch.fnmatchcase(s, pat) for s in samples]
    if rx is None:
        assert not any(expected)
        return
    # Java regex (Spark) and Python agree with fnmatch
    assert [bool(re.fullmatch(_py(rx), s)) for s in samples] == expected
    assert spark_match(spark, samples, rx) == expected
    assert duck_match(samples, rx) == expected


def duck_match(rows, rx):
    import duckdb
    con = duckdb.connect()
    return [con.execute("SELECT regexp_matches(?, ?)", [s, rx]).fetchall()[0][0] for s in rows]


def _py(rx: str) -> str:
    # Python spells \x{HEX} as \U0000HEX and \z as \Z
    out = re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: "\\U%08X" % int(m.group(1), 16), rx)
    return out.replace("\\z", "\\Z").replace("\\A", "")


def test_glob_examples(spark):
    pats = ["*bbc.co.uk*"]
    urls = ["https://www.bbc.co.uk/news/1", "https://www.BBC.co.uk/news/1", "https://x.com/"]
    assert spark_match(spark, urls, globs_to_regex(pats)) == [True, False, False]
    assert glob_to_regex("[z-a]") is None
    assert globs_to_regex([]) is None


# The rule content types must follow, in Python terms (our spec).
PY_RULE = re.compile(r"^(?P<mime>[\w\/]+);\s?charset=(?P<charset>.*)$")


def py_ok(ct: str) -> bool:
    m = PY_RULE.match(ct)
    return bool(m) and m.group("mime") == "text/html" and m.group("charset").lower() == "utf-8"


CT_CASES = ["text/html; charset=utf-8", "text/html;charset=UTF-8", "text/html",
            "text/html;  charset=utf-8", "text/html; charset=\"utf-8\"", "text/html; charset=utf8",
            "TEXT/HTML; charset=utf-8", "text/html; charset=utf-8; q=1",
            "application/json; charset=utf-8", "text/html; charset=iso-8859-1",
            "text/html;\tcharset=utf-8", "text/html;\xa0charset=utf-8",
            "text/html; charset=utf-8\n", "text/html; charset=utf-8\r"]


def test_content_type_cases(spark):
    got = spark_match(spark, CT_CASES, UTF8_HTML_RX)
    assert got == [py_ok(c) for c in CT_CASES]
    assert duck_match(CT_CASES, UTF8_HTML_RX) == got


@settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.builds(lambda a, b, c: a + b + c,
                          st.sampled_from(["text/html;", "text/html", "text/xml;", "x"]),
                          st.text(alphabet=" \t\x0b\xa0\u2003", max_size=2),
                          st.sampled_from(["charset=utf-8", "charset=UTF-8", "charset=utf-8\n",
                                           "charset=latin1", ""])),
                min_size=1, max_size=10))
def test_content_type_property(spark, cts):
    assert spark_match(spark, cts, UTF8_HTML_RX) == [py_ok(c) for c in cts]
