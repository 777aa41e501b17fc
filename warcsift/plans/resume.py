"""A run that can be ended at any time and started again: every article is appended once.

The files of the window that the ledger has not settled are read in batches;
each batch's articles and ledger rows are committed together (see
:mod:`warcsift.sources.ledger`). Starting the same run again reads only what is
missing from the ledger: files of later batches, and files that were missing or
could not be read.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import contracts as K
from ..functions import paths as P
from ..operators.article import articles
from ..operators.counters import counters_per_warc
from ..operators.language import load_profile, train_profile
from ..sources.index import DEFAULT_LAYOUT, warc_index
from ..sources.lake import DEFAULT_KEYS, write_lake
from ..sources.ledger import LEDGER, SETTLED, Ledger
from ..sources.warc import UNREADABLE
from .pipeline import NO_COUNTERS, _scan, extract

log = logging.getLogger(__name__)


@dataclass
class ResumeResult:
    ledger: DataFrame         # every row of the ledger after the run
    commits: int              # batches that this run committed
    read: list[str]           # archive files that this run read
    open: int                 # files of the window that are still to be read


def _status(message: Column) -> Column:
    return (F.when(message.isNull(), "done").when(message == "missing file", "missing")
            .when(F.startswith(message, F.lit(UNREADABLE)), "failed").otherwise("damaged"))


def batch_rows(batch: str, files: DataFrame, per_warc: DataFrame, errors: DataFrame) -> DataFrame:
    """Ledger rows of a batch: a row per file, its worst gap, and its counters if it is settled."""
    order = F.array_position(F.array(*map(F.lit, ("damaged", "missing", "failed"))), _status(F.col("message")))
    worst = errors.groupBy("warc_path").agg(F.max(F.struct(order.alias("order"), "message"))["message"].alias("message"))
    rows = files.join(per_warc, "warc_path", "left").join(worst, "warc_path", "left").withColumn("status", _status(F.col("message")))
    count = lambda c: F.when(F.col("status").isin(*SETTLED), F.coalesce(c, F.lit(0))).otherwise(F.lit(0)).cast("long").alias(c)
    return rows.select(F.lit(batch).alias("batch"), "warc_path", "status", "message", *[count(c) for c in NO_COUNTERS])


def run_resumable(spark: SparkSession, archive_root: str, patterns: list[str], start: datetime, end: datetime,
                  out_url: str, ledger_url: str, training_docs: DataFrame | None = None,
                  profile: DataFrame | str | None = None, files_per_commit: int = 64, max_commits: int | None = None,
                  max_records: int | None = None, keys: tuple[str, ...] = DEFAULT_KEYS, index_root: str | None = None,
                  layout: str = DEFAULT_LAYOUT, prefix: str = P.DEFAULT_PREFIX, num_partitions: int | None = None,
                  materialize: str = "table", scratch: str | None = None, split_bytes: int | None = None) -> ResumeResult:
    """Extract the articles of ``[start, end)`` that ``ledger_url`` does not hold yet, and
    append them to ``out_url``, ``files_per_commit`` archive files at a time.

    ``max_commits`` ends the run after so many batches; the next one goes on.
    The other arguments are those of :func:`warcsift.plans.pipeline.run`.
    """
    K.check_patterns(patterns)
    K.check_window(start, end)
    K.check_partitions(keys)
    if max_records is not None:
        K.check_max_records(max_records)
    if type(files_per_commit) is not int or files_per_commit < 1:
        raise ValueError("files_per_commit must be a positive integer.")
    own = None
    if not isinstance(profile, DataFrame):
        if profile is None and training_docs is None:
            raise ValueError("Give a language profile or training documents.")
        own = profile = (load_profile(spark, profile) if profile else train_profile(training_docs)).persist()

    book = Ledger(spark, ledger_url, out_url)
    for batch in book.recover():
        log.info("Finished the commit of batch %s.", batch)
    root = F.lit(archive_root.rstrip("/") + "/")
    idx = warc_index(spark, index_root or archive_root, start, end, layout, prefix=prefix)
    wanted = idx.select(F.concat(root, F.regexp_replace("warc_path", "^/+", "")).alias("warc_path")).distinct()
    # file names are scan planning metadata, as in run()
    todo = sorted(r["warc_path"] for r in wanted.join(book.settled(), "warc_path", "left_anti").collect())
    batches = [todo[i:i + files_per_commit] for i in range(0, len(todo), files_per_commit)]
    read: list[str] = []
    for files in batches[:max_commits]:
        batch = book.begin()
        staged = extract(_scan(spark, files, patterns, None, "PERMISSIVE", split_bytes), patterns, profile, prefix,
                         num_partitions, materialize, scratch)
        listed = spark.createDataFrame([(f,) for f in files], "warc_path string")
        batch_rows(batch, listed, counters_per_warc(staged.disp), staged.errors).coalesce(1).write.parquet(book.staged_rows(batch))
        rows = spark.read.schema(LEDGER).parquet(book.staged_rows(batch))
        # at most files_per_commit rows
        unsettled = F.broadcast(rows.where(~F.col("status").isin(*SETTLED)).select("warc_path"))
        write_lake(articles(staged.disp.join(unsettled, "warc_path", "left_anti")), book.staged_lake(batch), keys, max_records)
        book.commit(batch)
        staged.release()
        read += files
    if own is not None:
        own.unpersist()
    ledger = book.rows()
    return ResumeResult(ledger, len(batches[:max_commits]), read, wanted.join(book.settled(), "warc_path", "left_anti").count())


__all__ = ["run_resumable", "ResumeResult", "batch_rows"]
