"""Run the extraction with a source whose first attempt of each task fails.

Usage: python retry_job.py <archive_dir> <out_json> <flaky 0|1>
Runs on local[2,4] (up to 4 attempts per task) in its own process.
"""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from warcsift.operators.article import articles  # noqa: E402
from warcsift.operators.counters import counters_total  # noqa: E402
from warcsift.operators.language import train_profile  # noqa: E402
from warcsift.plans.pipeline import extract  # noqa: E402
from warcsift.sources.responses import load_table  # noqa: E402
from warcsift.sources.warc import WarcDataSource, WarcReader  # noqa: E402


class FlakyReader(WarcReader):
    def read(self, partition):
        from pyspark import TaskContext
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("simulated lost executor")
        yield from super().read(partition)


class FlakyWarc(WarcDataSource):
    @classmethod
    def name(cls):
        return "flakywarc"

    def reader(self, schema):
        return FlakyReader(dict(self.options))


def main():
    archive, out, flaky = sys.argv[1], sys.argv[2], sys.argv[3] == "1"
    spark = (SparkSession.builder.master("local[2,4]")
             .config("spark.sql.shuffle.partitions", "4")
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    spark.dataSource.register(FlakyWarc)
    fmt = "flakywarc" if flaky else "warc"
    if not flaky:
        spark.dataSource.register(WarcDataSource)
    records = spark.read.format(fmt).load(archive)
    prof = train_profile(load_table(spark, "/root/testdata/sf0.001", "documents")).persist()
    disp = extract(records, ["*"], prof).disp
    row = counters_total(disp).collect()[0].asDict()
    arts = sorted(tuple(r) for r in articles(disp).collect())
    with open(out, "w") as f:
        json.dump({"counters": row, "articles": arts}, f)


if __name__ == "__main__":
    main()
