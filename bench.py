"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Before timing, every headline query runs once on the smallest data set
(sf0.001 if present) so JIT compilation and code generation are warm; each
timed run then collects its full result at BENCH_SF_DIR starting from cold
caches (cached inputs of earlier runs are dropped), so it does all its work.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from warcsift.plans import context as X  # noqa: E402
from warcsift.plans.registry import QUERIES  # noqa: E402
from warcsift.session import get_spark  # noqa: E402

HEADLINE = ["articles", "language_detect", "lang_profile", "html_blocks", "main_text",
            "title", "valid_records", "counters_per_warc", "running_counters",
            "warc_scan", "lake_write_roundtrip", "run_end_to_end"]


def _reset(spark):
    X.reset()
    spark.catalog.clearCache()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                      extra={"spark.driver.memory": "16g"})
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    # warm-up: JVM JIT, Python workers, code generation (smallest data set)
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in HEADLINE:
        _reset(spark)
        QUERIES[name](spark, warm_dir).collect()

    times = {}
    for name in HEADLINE:
        _reset(spark)
        t0 = time.time()
        QUERIES[name](spark, sf_dir).collect()
        times[name] = round(time.time() - t0, 3)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    total = round(sum(times.values()), 3)
    out = {"metric": "headline_queries_total", "value": total, "unit": "sec",
           "queries": times, "sf": sf, "pages": pages,
           "pages_per_sec_articles": round(pages / times["articles"], 1)
           if times.get("articles") else None}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
