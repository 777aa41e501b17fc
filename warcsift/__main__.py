"""``python -m warcsift`` / spark-submit entry: one run configured by environment.

ARCHIVE_ROOT, LAKE_URL, TRAINING_DIR (a directory with documents.parquet) or
PROFILE_URL; optional URL_PATTERNS (JSON list, default every URL),
START_DATE and END_DATE (ISO, both or neither; default yesterday),
MAX_RECORDS_PER_FILE, LIMIT.
"""

from .plans.pipeline import main

if __name__ == "__main__":
    main()
