"""warcsift: web-archive crawls -> partitioned Parquet article lake, on Spark."""

from .operators.article import articles, dispositions  # noqa: F401
from .operators.counters import (counters_per_warc, counters_rollup,  # noqa: F401
                                 counters_total, progress_percent, running_counters)
from .operators.language import (detect_language, load_profile, save_profile,  # noqa: F401
                                 train_profile)
from .operators.records import classify, url_semi_join  # noqa: F401
from .plans.pipeline import RunResult, extract, extract_warc, run  # noqa: F401
from .sources.index import warc_index  # noqa: F401
from .sources.lake import bucket_url, read_lake, write_lake  # noqa: F401
from .sources.warc import read_warc, register as register_warc, scan_errors  # noqa: F401
