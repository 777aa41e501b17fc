"""Scalar column functions on text: decoding, content type, entities, URLs, dates.

All of them are built-in Spark expressions evaluated in the JVM (those with
lambdas are interpreted, the others compiled). Regex texts stick to the common subset of Java and RE2.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters Python's ``\s`` accepts in a ``str`` pattern
# (the content-type check must accept exactly these between ';' and 'charset').
PY_WHITESPACE_CLASS = (
    "[\\x{9}-\\x{D}\\x{1C}-\\x{20}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)

# Content type accepted as a UTF-8 HTML page: exactly "text/html;", at most one
# whitespace, "charset=", then utf-8 in any ASCII case; a final newline is
# tolerated, as a Python "$" would.
UTF8_HTML_RX = ("\\Atext/html;" + PY_WHITESPACE_CLASS + "?charset=(?i:utf-8)\\n?\\z")

# ASCII whitespace runs (tab, LF, VT, FF, CR, space).
WS_RUN_RX = "[\\x{9}-\\x{D} ]+"

# HTML entities decoded in text, in this order, "&amp;" last.
HTML_ENTITIES = (
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
    ("&#39;", "'"), ("&apos;", "'"), ("&middot;", "\u00b7"), ("&copy;", "\u00a9"),
    ("&reg;", "\u00ae"), ("&mdash;", "\u2014"), ("&ndash;", "\u2013"),
    ("&hellip;", "\u2026"), ("&laquo;", "\u00ab"), ("&raquo;", "\u00bb"),
    ("&amp;", "&"),
)

URL_ORIGIN_RX = "\\A([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)"


def once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body).getItem(0)


def strict_utf8(payload: Column) -> Column:
    """Bytes -> string if they are valid UTF-8, else NULL (never raises)."""
    return F.try_validate_utf8(payload.cast("string"))


def is_utf8_html(content_type: Column) -> Column:
    return content_type.rlike(UTF8_HTML_RX)


# Any number of leading zeros; more digits than these are beyond U+10FFFF.
NUM_DEC_RX = "\\A0*([0-9]{1,7});"
NUM_HEX_RX = "\\A[xX]0*([0-9a-fA-F]{1,6});"


def decode_numeric(c: Column) -> Column:
    """Decode ``&#NNN;`` / ``&#xHHHH;``; non-characters (0, surrogates, beyond
    U+10FFFF) and malformed references stay as written."""
    def piece(p, i):
        dec = F.regexp_extract(p, NUM_DEC_RX, 1)
        hx = F.regexp_extract(p, NUM_HEX_RX, 1)
        n = (F.when(dec != "", dec.cast("long"))
             .when(hx != "", F.conv(hx, 16, 10).cast("long")))
        used = F.instr(p, ";")
        ok = n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
        ch = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return (F.when(i == 0, p)
                .when(ok, F.concat(ch, F.substr(p, used + 1)))
                .otherwise(F.concat(F.lit("&#"), p)))
    decoded = F.array_join(F.transform(F.split(c, "&#"), piece), "")
    return F.when(F.contains(c, F.lit("&#")), decoded).otherwise(c)


def unescape_entities(c: Column) -> Column:
    """Named entities, then numeric references, then ``&amp;`` (so that
    ``&amp;#39;`` stays ``&#39;``)."""
    *named, amp = HTML_ENTITIES
    out = c
    for ent, ch in named:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    out = F.replace(once(out, decode_numeric), F.lit(amp[0]), F.lit(amp[1]))
    return F.when(F.contains(c, F.lit("&")), out).otherwise(c)


def squeeze(c: Column) -> Column:
    """Collapse whitespace runs to one blank and trim."""
    return F.trim(F.regexp_replace(c, WS_RUN_RX, " "))


BR_RX = "(?i)<br(?:[\\x{9}-\\x{D} /][^>]*)?>"
# A '<' before anything else is text.
TAG_RX = "<[A-Za-z/!?][^>]*>"


def strip_tags(c: Column) -> Column:
    """Drop markup: line breaks become blanks, other tags vanish."""
    out = F.regexp_replace(c, BR_RX, " ")
    return F.when(F.contains(c, F.lit("<")), F.regexp_replace(out, TAG_RX, "")).otherwise(c)


def html_text(c: Column) -> Column:
    """Visible text of an HTML fragment: tags out, entities in, blanks squeezed."""
    return once(c, lambda raw: once(strip_tags(raw), lambda bare: squeeze(unescape_entities(bare))))


def word_count(text: Column) -> Column:
    """Words of an already squeezed text (0 for the empty string)."""
    return F.when(text == "", F.lit(0)).otherwise(F.size(F.split(text, " ")))


def source_domain(url: Column) -> Column:
    """scheme://authority of a URL (port and user info kept); NULL if no scheme."""
    scheme = F.regexp_extract(url, URL_ORIGIN_RX, 1)
    auth = F.regexp_extract(url, URL_ORIGIN_RX, 2)
    return F.when(scheme != "", F.concat(F.lower(scheme), F.lit("://"), auth))


def date_text(c: Column) -> Column:
    """'yyyy-MM-dd' text of a date string, or NULL when it is not a real date."""
    return F.date_format(F.try_to_date(c, "yyyy-MM-dd"), "yyyy-MM-dd")


def detect_input(main_text: Column, title: Column) -> Column:
    """Text used for language detection: the body, else the title, else NULL."""
    return F.coalesce(F.nullif(main_text, F.lit("")), F.nullif(title, F.lit("")))
