"""The whole run: index -> prune -> scan -> classify -> extract -> lake.

``run`` is one Spark application step: the archive index of the months in
``[start, end)`` is read and pruned by file-name time, the remaining files
are scanned (one task per file), every record is classified, valid pages
become articles with a language, and the articles are appended to the lake
in a single write job. Run counters ride along that job through
``observe``; per-file counters come from the same materialised rows.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from .. import contracts as K
from ..functions import paths as P
from ..functions.globs import globs_to_python_regex
from ..operators.article import Staged, articles, stage
from ..operators.counters import (counters_per_warc, counters_total, observe_counters,
                                  running_counters)
from ..operators.language import load_profile, train_profile
from ..operators.records import classify
from ..sources.index import DEFAULT_LAYOUT, warc_index
from ..sources.lake import DEFAULT_KEYS, write_lake
from ..sources.warc import read_warc

log = logging.getLogger(__name__)

FILES_PER_BUCKET = 4


NO_COUNTERS = {"extracted": 0, "discarded": 0, "errored": 0, "total": 0}


@dataclass
class RunResult:
    counters: dict            # extracted / discarded / errored / total of the run
    per_warc: DataFrame       # counters per file (lazy, from the stored rows)
    files: list[str]          # archive files that the run was to scan
    errors: DataFrame         # warc_path, rec_offset, message: gaps, missing files
    n_warcs: int              # archive files in the window, from the index
    progress: DataFrame | None = None     # running counters, with ``report_every``
    staged: Staged | None = None
    profile: DataFrame | None = None      # persisted by the run itself

    def release(self) -> None:
        """Delete everything the run stored for these results."""
        if self.staged is not None:
            self.staged.release()
        if self.profile is not None:
            self.profile.unpersist()


def extract(records: DataFrame, patterns: list[str], profile: DataFrame,
            prefix: str = P.DEFAULT_PREFIX, num_partitions: int | None = None,
            materialize: str = "table", scratch: str | None = None) -> Staged:
    """Records -> every record with article fields, language and disposition, stored."""
    return stage(classify(records, K.check_patterns(patterns)), profile, prefix,
                 num_partitions, materialize, scratch)


def _scan(spark: SparkSession, files, patterns: list[str], limit: int | None, read_mode: str,
          split_bytes: int | None = None) -> DataFrame:
    """The records, with payloads only where the headers allow an article."""
    return read_warc(spark, files, split_bytes, limit=limit, mode=read_mode, payload="html",
                     url_regex=globs_to_python_regex(patterns) or "(?!)")


def _totals(disp: DataFrame, patterns: list[str], obs: Observation | None) -> dict:
    """Observed run counters. Where no URL can match, Spark plans a write of
    nothing without the observed node: then they come from the stored rows, as
    they do without a write."""
    if obs is not None and globs_to_python_regex(patterns) is not None:
        metrics = obs.get
    else:
        metrics = counters_total(disp).collect()[0].asDict()
    return {k: int(metrics[k] or 0) for k in NO_COUNTERS}


def run(spark: SparkSession, archive_root: str, patterns: list[str], start: datetime,
        end: datetime, out_url: str, training_docs: DataFrame | None = None,
        profile: DataFrame | str | None = None, limit: int | None = None,
        max_records: int | None = None, keys: tuple[str, ...] = DEFAULT_KEYS,
        mode: str = "append", index_root: str | None = None,
        layout: str = DEFAULT_LAYOUT, prefix: str = P.DEFAULT_PREFIX,
        num_partitions: int | None = None, materialize: str = "table",
        read_mode: str = "PERMISSIVE", report_every: int | None = None,
        scratch: str | None = None, split_bytes: int | None = None) -> RunResult:
    """Extract the articles of ``[start, end)`` and append them to ``out_url``.

    ``num_partitions`` sizes the one exchange (and the buckets) of extracted
    fields; by default it is the larger of ``spark.sql.shuffle.partitions``
    and one bucket per ``FILES_PER_BUCKET`` archive files (about 200 MB of
    article fields per bucket for ~1 GB archive files).
    ``profile`` is a profile DataFrame or the URL of one saved with
    :func:`save_profile`; else one is trained from ``training_docs``.
    ``materialize``: ``table`` (default; extracted fields written once to the
    shared checkpoint folder or ``scratch``, bucketed on the record key) or
    ``cache``. ``read_mode``: ``PERMISSIVE`` reports damaged and missing files
    in ``errors`` and goes on; ``FAILFAST`` raises. ``report_every`` adds the
    running counters before every so many records of a file as ``progress``.
    ``split_bytes`` lets several tasks read one file larger than that (worth its
    extra pass where the run has fewer files than the cluster has cores).
    Call ``release()`` on the result when done with its tables.
    """
    K.check_patterns(patterns)
    K.check_window(start, end)
    K.check_limit(limit)
    K.check_partitions(keys)
    if max_records is not None:
        K.check_max_records(max_records)
    if report_every is not None:
        K.check_report_every(report_every)
    own_profile = None
    if not isinstance(profile, DataFrame):
        if profile is None and training_docs is None:
            raise ValueError("Give a language profile or training documents.")
        profile = load_profile(spark, profile) if profile else train_profile(training_docs)
        own_profile = profile = profile.persist()

    idx = warc_index(spark, index_root or archive_root, start, end, layout, prefix=prefix)
    # The pruned file list is metadata (a few hundred files a month): it is
    # what the scan plans its one-partition-per-file layout from.
    root = archive_root.rstrip("/")
    files = [f"{root}/{r['warc_path'].lstrip('/')}" for r in idx.select("warc_path").collect()]
    log.info("Found %d WARC files to process.", len(files))
    if not files:
        log.error("No WARC files were found.")
        counters = spark.createDataFrame([], "warc_path string, extracted long, "
                                             "discarded long, errored long, total long")
        errors = spark.createDataFrame([], "warc_path string, rec_offset long, message string")
        return RunResult(dict(NO_COUNTERS), counters, [], errors, 0, profile=own_profile)

    records = _scan(spark, files, patterns, limit, read_mode, split_bytes)
    n = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                              -(-len(files) // FILES_PER_BUCKET))
    staged = extract(records, patterns, profile, prefix, n, materialize, scratch)
    observed, obs = observe_counters(staged.disp)
    write_lake(articles(observed), out_url, keys, max_records, mode)
    progress = running_counters(staged.disp, report_every) if report_every else None
    return RunResult(_totals(staged.disp, patterns, obs), counters_per_warc(staged.disp), files, staged.errors,
                     len(files), progress, staged, own_profile)


def extract_warc(spark: SparkSession, warc_url: str, patterns: list[str],
                 profile: DataFrame, date_crawled: datetime | None = None,
                 limit: int | None = None, out_url: str | None = None,
                 keys: tuple[str, ...] = DEFAULT_KEYS, max_records: int | None = None,
                 prefix: str = P.DEFAULT_PREFIX, read_mode: str = "PERMISSIVE",
                 report_every: int | None = None, scratch: str | None = None,
                 split_bytes: int | None = None) -> RunResult:
    """One archive file -> articles (and, with ``out_url``, the lake).

    ``date_crawled`` overrides the crawl date taken from the file name (a
    file whose name carries no time needs it).
    """
    K.check_url(warc_url)
    K.check_patterns(patterns)
    K.check_limit(limit)
    if date_crawled is not None:
        K.check_date_crawled(date_crawled)
    if report_every is not None:
        K.check_report_every(report_every)
    staged = extract(_scan(spark, warc_url, patterns, limit, read_mode, split_bytes), patterns, profile, prefix, scratch=scratch)
    if date_crawled is not None:
        staged.disp = staged.disp.withColumn("date_crawled", F.lit(date_crawled.strftime("%Y-%m-%d")))
    obs = None
    if out_url is not None:
        observed, obs = observe_counters(staged.disp)
        write_lake(articles(observed), out_url, keys, max_records)
    progress = running_counters(staged.disp, report_every) if report_every else None
    return RunResult(_totals(staged.disp, patterns, obs), counters_per_warc(staged.disp), [warc_url], staged.errors,
                     1, progress, staged)


def main(argv: list[str] | None = None) -> None:  # pragma: no cover - CLI
    """spark-submit entry: configuration from environment variables."""
    import json
    import os

    from ..session import get_spark
    from ..sources.responses import load_table

    env = os.environ
    spark = get_spark()
    start, end = K.window_from_env(env.get("START_DATE"), env.get("END_DATE"))
    patterns = K.patterns_from_env(env.get("URL_PATTERNS"))
    max_records = env.get("MAX_RECORDS_PER_FILE")
    limit, split_bytes = env.get("LIMIT"), env.get("SPLIT_BYTES")
    profile = env.get("PROFILE_URL")
    docs = None if profile else load_table(spark, env["TRAINING_DIR"], "documents")
    res = run(spark, env["ARCHIVE_ROOT"], patterns, start, end, env["LAKE_URL"],
              training_docs=docs, profile=profile,
              max_records=int(max_records) if max_records else None,
              limit=int(limit) if limit else None,
              split_bytes=int(split_bytes) if split_bytes else None)
    log.info("Completed extraction job.")
    print(json.dumps(res.counters))


__all__ = ["run", "extract", "extract_warc", "RunResult"]
