"""Column functions (all built-in Spark expressions, no Python UDFs)."""

from .globs import glob_to_regex, globs_to_regex, url_matches_any  # noqa: F401
from .headers import header, make_headers  # noqa: F401
from .text import (  # noqa: F401
    strict_utf8, is_utf8_html, html_text, squeeze, unescape_entities,
    source_domain, date_text, detect_input, word_count,
)
from .paths import crawl_ts, serial, basename, absolute_url, crawl_date, in_window  # noqa: F401
