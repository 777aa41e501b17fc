"""Fixed schemas of every table the engine produces (no schema inference)."""

from pyspark.sql import types as T

HEADER = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("value", T.StringType()),
])
HEADERS = T.ArrayType(HEADER)

# One row per record of a web-archive file, in file order.
RAW_RECORDS = T.StructType([
    T.StructField("warc_path", T.StringType()),
    T.StructField("rec_idx", T.LongType()),
    T.StructField("rec_offset", T.LongType()),
    T.StructField("file_size", T.LongType()),
    T.StructField("rec_type", T.StringType()),
    T.StructField("rec_headers", HEADERS),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("http_headers", HEADERS),
    T.StructField("payload", T.BinaryType()),
    T.StructField("payload_error", T.StringType()),
])

# Parsed monthly archive index.
WARC_INDEX = T.StructType([
    T.StructField("warc_path", T.StringType()),
    T.StructField("warc_url", T.StringType()),
    T.StructField("basename", T.StringType()),
    T.StructField("crawl_ts", T.TimestampNTZType()),
    T.StructField("serial", T.IntegerType()),
])

# Output article; field order is part of the contract.
ARTICLE_FIELDS = ("title", "main_text", "url", "source_domain",
                  "date_publish", "date_crawled", "language")
ARTICLE = T.StructType([T.StructField(f, T.StringType()) for f in ARTICLE_FIELDS])

HTML_BLOCKS = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("section", T.IntegerType()),
    T.StructField("path", T.ArrayType(T.IntegerType())),
    T.StructField("tag", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("n_words", T.IntegerType()),
    T.StructField("n_stop", T.IntegerType()),
    T.StructField("link_words", T.IntegerType()),
    T.StructField("n_links", T.IntegerType()),
])

LANG_PROFILE = T.StructType([
    T.StructField("lang", T.StringType()),
    T.StructField("gram", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("w", T.DoubleType()),
])

COUNTERS = T.StructType([
    T.StructField("warc_path", T.StringType()),
    T.StructField("extracted", T.LongType()),
    T.StructField("discarded", T.LongType()),
    T.StructField("errored", T.LongType()),
    T.StructField("total", T.LongType()),
])

DISPOSITIONS = ("extracted", "discarded", "errored")
