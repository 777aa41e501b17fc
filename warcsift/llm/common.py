"""Helpers shared by the operators of this subpackage.

Text rules used everywhere: a word is a run of characters other than space
and 0x09-0x0D; a null text counts as empty; only A-Z are lower-cased.
"""

from __future__ import annotations

import atexit
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SCRATCH: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def without(text: Column, chars: str) -> Column:
    for ch in chars:
        text = F.replace(text, F.lit(ch), F.lit(""))
    return text


def words(text: Column) -> Column:
    """The words in order; one-character splits are several times a regex split."""
    for ch in SPACE_CHARS[1:]:
        text = F.replace(text, F.lit(ch), F.lit(" "))
    return F.filter(F.split(text, " "), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside inner lambdas."""
    return F.transform(F.array(value), body).getItem(0)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that clash with none of ``df``'s, whatever the case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def most_frequent(counts: DataFrame, limit: int) -> DataFrame:
    """The rows of ``counts`` (a written table with a count ``n`` > 0) of the largest
    counts, at most ``limit``.

    The cut-off comes from a histogram of the counts' logarithms (some hundred
    rows), so that no task sends its own top rows to the driver.
    """
    level = F.floor(F.log2("n") * 16)
    cut, room = 1 << 30, limit
    for row in sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("rows")).collect(), reverse=True):
        if row["rows"] > room:
            break
        cut, room = row["level"], room - row["rows"]
    return counts.filter(level >= cut)


@contextmanager
def small_batches(spark: SparkSession):
    """Arrow batches bounded in rows and bytes while a table is written, so that
    long texts and sets do not add up in a Python worker; the write's shuffle files
    are deleted with it."""
    bounds = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
              "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
              "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    before = {k: spark.conf.get(k, None) for k in bounds}
    for k, v in bounds.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read back.

    Cuts the lineage with files that every executor sees; ``release`` removes them
    after their last reader, ``release_scratch`` (also run when the driver's Python
    ends) what is left. Shuffle files of the write go when it ends.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{name}")
    _SCRATCH.append(path)
    with small_batches(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` returned, once nothing unwritten reads them."""
    for done in tables:
        if done.scratch_path in _SCRATCH:
            _SCRATCH.remove(done.scratch_path)
            _delete(done.sparkSession, done.scratch_path)


def scratch_tables() -> set[str]:
    return set(_SCRATCH)


def release_newer(before: set[str], keep: DataFrame) -> DataFrame:
    """``keep``, after every other table written since ``before`` (``scratch_tables``) is deleted."""
    for path in [p for p in _SCRATCH if p not in before and p != keep.scratch_path]:
        _SCRATCH.remove(path)
        _delete(keep.sparkSession, path)
    return keep


def release_scratch(spark: SparkSession) -> None:
    """Delete every table that ``materialise`` has written in this process."""
    while _SCRATCH:
        _delete(spark, _SCRATCH.pop())


def rows_that_stay(docs: DataFrame, key: Column, verdict: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``verdict`` lets stay, all columns as they were.

    ``verdict``: a written table ``doc_id, key, rows, stays`` with one row per
    (doc_id, key); rows of ``docs`` that it does not name stay. Where several rows
    with one such pair stay, they are merged into one of them. The verdict grows
    with ``docs``, so it is never broadcast: texts move once, past a hash table of
    the narrow rows that go.
    """
    mark, own, row = fresh(docs, "stay_key", "stay_own", "stay_row")
    narrow = lambda df: df.select(F.col("doc_id").alias(row), F.col("key").alias(own)).hint("shuffle_hash")
    same = (F.col(mark) == F.col(own)) & F.col("doc_id").cast(verdict.schema["doc_id"].dataType).eqNullSafe(F.col(row))
    left = docs.withColumn(mark, key).join(narrow(verdict.filter("NOT stays")), same, "left_anti")
    again = verdict.filter("stays AND rows > 1")
    if again.isEmpty():  # no row is repeated
        return left.select(*docs.columns)
    single = left.join(narrow(again), same, "left_anti")
    merged = left.join(narrow(again), same, "left_semi").dropDuplicates(["doc_id", mark])
    return single.unionByName(merged).select(*docs.columns)


@atexit.register
def _at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if _SCRATCH and spark is not None and spark.sparkContext._jsc is not None:
        release_scratch(spark)
