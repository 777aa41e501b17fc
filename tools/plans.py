"""Write PLANS.md: physical operator trees of the key queries (sf0.01)."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tools.plan_shape import plan_shape  # noqa: E402
from warcsift.plans import context as X  # noqa: E402
from warcsift.plans.registry import QUERIES  # noqa: E402
from warcsift.session import get_spark  # noqa: E402

KEYS = ["articles", "language_detect", "counters_per_warc", "running_counters",
        "valid_records", "limit_per_warc", "lake_read", "url_glob_semi_join",
        "record_crawl_date"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", 8)
    out = ["# Physical plans of key queries", "",
           f"Generated by `python tools/plans.py` on `{os.path.basename(sf)}`, `local[8]`.",
           "Operator trees only (`explain(\"formatted\")` without the per-node details).",
           "Adaptive plans are shown before execution, so AQE rewrites are not visible.", "",
           "How to read `articles`: the page scan and all HTML work run in a separate job that",
           "writes a table bucketed on the record key (not shown); both the",
           "language branch (word count, gram `Generate`, `BroadcastHashJoin` with the",
           "profile, partial/final aggregates) and the left side of the join back read",
           "that table (`Scan parquet ... warcsift_fields_...`) with no `Exchange`.", ""]
    for k in KEYS:
        df = QUERIES[k](spark, sf)
        shape = plan_shape(df)
        shape = re.sub(r"Statistics\([^)]*\)", "", shape)
        out += [f"## {k}", "", "```", shape.strip(), "```", ""]
    # the scan of the archive source with a pushed predicate
    from warcsift.session import scratch_dir
    from warcsift.sources.fixtures import write_fixture
    from warcsift.sources.responses import responses
    from warcsift.sources.warc import read_warc
    from pyspark.sql import functions as F
    root = scratch_dir(spark, "plans")
    files = [r[0] for r in write_fixture(responses(spark, sf), root).collect()]
    scan = read_warc(spark, files).where((F.col("rec_type") == "response")
                                         & (F.col("rec_idx") < 10))
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        scan.select("warc_path", "rec_idx").explain("formatted")
    text = buf.getvalue()
    out += ["## archive scan with pushed predicates", "",
            "`read_warc(files).where(rec_type = 'response' AND rec_idx < 10)`: both",
            "predicates (and their implied NOT NULL checks) are taken by the source:",
            "no Filter above the scan, and the reader stops each file after 10 records.", "",
            "```", text.split("\n\n(1)")[0].strip(), "```", ""]
    X.reset()
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
