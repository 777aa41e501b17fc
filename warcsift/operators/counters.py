"""Counters (extracted / discarded / errored / total), progress and limits.

Per-file counters are a plain ``groupBy`` with partial aggregation, so a hot
file or a skewed day costs one small row per task before the shuffle. The
run totals come from the same rows (``observe`` on the write job) or from a
global aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..contracts import check_report_every
from ..schemas import DISPOSITIONS


def _counts() -> list[Column]:
    cols = [F.count_if(F.col("disposition") == d).alias(d) for d in DISPOSITIONS]
    return cols + [F.count(F.lit(1)).alias("total")]


def counters_per_warc(disp: DataFrame) -> DataFrame:
    """(warc_path, extracted, discarded, errored, total); total is their sum."""
    return disp.groupBy("warc_path").agg(*_counts())


def counters_total(disp: DataFrame) -> DataFrame:
    return disp.agg(*_counts())


def counters_rollup(disp: DataFrame) -> DataFrame:
    """Per-file rows plus one total row (``level`` = 'warc' / 'total')."""
    return (disp.rollup("warc_path")
            .agg(F.when(F.grouping("warc_path") == 1, F.lit("total"))
                 .otherwise(F.lit("warc")).alias("level"), *_counts()))


def nonempty_warcs(disp: DataFrame) -> DataFrame:
    """Files that yielded at least one article (only these feed the sink)."""
    return counters_per_warc(disp).where(F.col("extracted") > 0)


def error_rate(disp: DataFrame, max_rate: float = 0.1) -> DataFrame:
    """Run-level quality bar: errored must stay below ``max_rate`` x extracted."""
    t = counters_total(disp)
    return t.select(
        "extracted", "errored",
        F.round(F.try_divide(F.col("errored").cast("double"), F.col("extracted")), 6)
        .alias("error_rate"),
        (F.col("errored") < F.lit(max_rate) * F.col("extracted")).alias("passes"))


def observe_counters(disp: DataFrame, name: str = "counters"
                     ) -> tuple[DataFrame, Observation]:
    """Attach run counters to whatever job consumes ``disp`` (no second pass)."""
    obs = Observation(name)
    return disp.observe(obs, *_counts()), obs


def limit_per_warc(records: DataFrame, limit: int | None) -> DataFrame:
    """First ``limit`` records of each file, in file order.

    ``rec_idx`` is the 0-based ordinal of a record in its file, so this is a
    plain filter (no window, no shuffle) that the scan can also apply itself.
    """
    if limit is None:
        return records
    return records.where(F.col("rec_idx") < F.lit(limit))


def running_counters(disp: DataFrame, report_every: int = 5000) -> DataFrame:
    """Counters reported before each record whose index is a positive multiple
    of ``report_every``; they cover records ``0 .. rec_idx - 1`` of the file.

    Segmented prefix sums: every run of ``report_every`` records of a file is
    added up with partial aggregation, so that only a row per report, not per
    record, is shuffled and summed in file order.
    """
    check_report_every(report_every)
    block = F.call_function("div", F.col("rec_idx"), F.lit(report_every))
    head = F.col("rec_idx") % report_every == 0
    blocks = disp.groupBy("warc_path", block.alias("_block")).agg(
        *[F.count_if(F.col("disposition") == d).alias(f"_{d}") for d in DISPOSITIONS],
        F.count_if(head).alias("_heads"),
        *[F.max(F.when(head, F.col(c))).alias(c) for c in ("rec_offset", "file_size")])
    w = (Window.partitionBy("warc_path").orderBy("_block")
         .rowsBetween(Window.unboundedPreceding, -1))
    running = blocks.select(
        "warc_path", (F.col("_block") * report_every).alias("rec_idx"), "rec_offset", "file_size", "_heads",
        *[F.coalesce(F.sum(f"_{d}").over(w), F.lit(0)).alias(d) for d in DISPOSITIONS])
    return (running.where((F.col("rec_idx") > 0) & (F.col("_heads") > 0)).drop("_heads")
            .withColumn("total", sum(F.col(d) for d in DISPOSITIONS)))


def progress_percent(running: DataFrame) -> DataFrame:
    """Percent of the file read at each report; no row when the size is unknown."""
    return (running.where(F.col("file_size") > 0)
            .select("warc_path", "rec_idx",
                    F.round(F.lit(100.0) * F.col("rec_offset") / F.col("file_size"), 2)
                    .alias("percent")))
