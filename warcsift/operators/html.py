"""HTML page -> block table -> title, main text, publish date.

Everything is computed inside the page's own row with higher-order array
functions: the page is split into blocks, blocks carry their section number,
features and text, and the best section is chosen from that array. No row of
block text ever crosses a shuffle; the explode form (``html_blocks``) exists
for inspection and checks only.

Rules (ours; they keep the outputs and failure rules of the reference job):

* comments and the elements whose content is no markup (``script style`` and the
  like) are removed in one pass from left to right; one that is never closed ends
  with the page;
* block tags split the page into pieces, and a fold over the pieces keeps the
  stack of open elements, as HTML does: a block tag ends an open ``p``, an ``li``
  the ``li`` before it, a table cell the one before it, and so on; an end tag
  closes its nearest open element, with what is open inside it, but none outside
  of its table; other end tags are ignored; what is never closed ends with
  its parent;
* a piece is a *block* of the innermost open element; its *path* is the ids of
  the open ``article section main div td`` elements (containers) round it, from
  the page itself, 0; an id is the number of the piece that the element opens. Pieces
  inside ``head nav footer aside`` are dropped;
* block text = tags stripped (``<br>`` -> blank), entities decoded, blanks
  squeezed; anchors give the link count and the link words;
* a block is *good* when it is not an ``h1``, has more than 2 stop words and
  ``link_words * n_links < n_words`` (low link density);
* a good block's score goes to its container, and half of it to the next one
  outward; the container with the largest sum wins (ties -> the one that opens
  first); the good blocks anywhere inside it, joined by a blank line, are the
  main text ('' if there is none).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..functions.text import (once, html_text, squeeze, unescape_entities, word_count,
                              date_text)
from .stopwords import STOP_WORDS

C_BLK, C_TAG = "\x01", "\x02"

# Tag sets of HTML.
RAW_TAGS = ("script", "style", "noscript", "textarea", "title", "iframe", "xmp", "noembed", "noframes")
DROP_TAGS = ("head", "nav", "footer", "aside")
CONTAINER_TAGS = ("article", "section", "main", "div", "td")
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
BLOCK_TAGS = ("p", *HEADINGS, "li", "th", "tr", "table",
              "ul", "ol", "dl", "dt", "dd", "blockquote", "pre", "header",
              "figure", "figcaption")
STACK_TAGS = DROP_TAGS + CONTAINER_TAGS + BLOCK_TAGS
TABLE_SCOPE = ("table", "td", "th")
MAX_DEPTH = 100  # elements opened deeper are not put on the stack


def _but(*tags: str) -> tuple[str, ...]:
    return tuple(t for t in STACK_TAGS if t not in tags)


# What a tag closes: the nearest open element of the first set, unless one of the second
# set is nearer. Start tags then also end an open p (or head) at the top of the stack,
# headings an open heading too.
OPEN_RULES = {"li": (("li",), _but("li", "p", "div")),
              "dt": (("dt", "dd"), _but("dt", "dd", "p", "div")),
              "dd": (("dt", "dd"), _but("dt", "dd", "p", "div")),
              "tr": (("tr",), ("table",)),
              "td": (("td", "th"), ("tr", "table")),
              "th": (("td", "th"), ("tr", "table")),
              "body": (("head",), ())}
END_RULES = {t: ((t,), tuple(x for x in TABLE_SCOPE if x != t)) for t in STACK_TAGS} | {
    **{h: (HEADINGS, TABLE_SCOPE) for h in HEADINGS},
    "li": (("li",), ("ul", "ol", *TABLE_SCOPE)),
    "dt": (("dt",), ("dl", *TABLE_SCOPE)), "dd": (("dd",), ("dl", *TABLE_SCOPE)),
    "tr": (("tr",), ("table",)), "td": (("td",), ("tr", "table")), "th": (("th",), ("tr", "table")),
    "table": (("table",), ()), "head": (("head",), ())}

# "tag name ends here": optional blank or slash plus attributes, then '>'
_TAG_END = "(?:[\\x{9}-\\x{D} /][^>]*)?>"
# Put after a page, so that a tag that is never finished ends there.
PAGE_END = "<!>"

RAW_RX = "(?is)<(?:!--.*?(?:-->|\\z)|" + "|".join(
    f"{t}{_TAG_END}.*?(?:</{t}[\\x{{9}}-\\x{{D}} ]*>|\\z)" for t in RAW_TAGS) + ")"
BLOCK_RX = "(?i)<(/?)(body|" + "|".join(STACK_TAGS) + ")" + _TAG_END
ANCHOR_RX = "(?is)<a" + _TAG_END + "(.*?)(?:</a[\\x{9}-\\x{D} ]*>|\\z)"
TITLE_RX = "(?is)<title" + _TAG_END + "(.*?)</title[\\x{9}-\\x{D} ]*>"
OG_TITLE_RX = ("(?is)<meta[^>]*property=[\"']og:title[\"'][^>]*content=[\"']"
               "([^\"']*)[\"']")
OG_TITLE_REV_RX = ("(?is)<meta[^>]*content=[\"']([^\"']*)[\"'][^>]*"
                   "property=[\"']og:title[\"']")
NON_WORD_RX = "[^\\p{L} ]"
NON_ALNUM_RX = "[^\\p{L}\\p{N}]"

# Publish-date sources, tried in this order: URL path, meta tags, <time>, JSON-LD, and
# a datePublished anywhere in the page (such as JSON that does not parse).
# Names of meta tags.
DATE_KEYS = ("article:published_time", "article_date_original", "date", "datepublished", "dc[.]date", "dc[.]date[.]issued",
             "dcterms[.]created", "dcterms[.]issued", "og:published_time", "originalpublicationdate", "parsely-pub-date", "pubdate",
             "publication_date", "publish_date", "publishdate", "sailthru[.]date")
_KEY = "(?:property|name|itemprop)=[\"'](?:" + "|".join(DATE_KEYS) + ")[\"']"
URL_DATE_SLASH_RX = "/([12][0-9]{3}/[0-9]{1,2}/[0-9]{1,2})(?:[/?#]|\\z)"
URL_DATE_DASH_RX = "(?:\\A|[^0-9])([12][0-9]{3}-[0-9]{1,2}-[0-9]{1,2})(?:[^0-9]|\\z)"
META_DATE_RX = "(?is)<meta[^>]*" + _KEY + "[^>]*content=[\"']([^\"']*)[\"']"
META_DATE_REV_RX = "(?is)<meta[^>]*content=[\"']([^\"']*)[\"'][^>]*" + _KEY
TIME_DATE_RX = "(?is)<time[^>]*datetime=[\"']([^\"']*)[\"']"
JSONLD_RX = ("(?is)<script[^>]*type=[\"']application/ld[+]json[\"'][^>]*>(.*?)(?:</script|\\z)")
JSONLD_DATE_RX = "\"datePublished\"[\\x{9}-\\x{D} ]*:[\\x{9}-\\x{D} ]*\"([^\"]*)\""
# Spellings of a date, tried in this order: (regex, which groups are year, month, day).
_START, _STOP = "(?i)\\A[\\x{9}-\\x{D} ]*", "(?:[^0-9]|\\z)"
_MONTH = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*[.]?"
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
DATE_FORMS = (
    (_START + "([12][0-9]{3})-([0-9]{1,2})-([0-9]{1,2})" + _STOP, (1, 2, 3)),
    (_START + "([12][0-9]{3})/([0-9]{1,2})/([0-9]{1,2})" + _STOP, (1, 2, 3)),
    (_START + "([12][0-9]{3})([0-9]{2})([0-9]{2})" + _STOP, (1, 2, 3)),
    (_START + "(?:[a-z]+,? +)?([0-9]{1,2})[.]? +" + _MONTH + ",? +([12][0-9]{3})" + _STOP, (3, 2, 1)),
    (_START + "(?:[a-z]+, +)?" + _MONTH + " +([0-9]{1,2}),? +([12][0-9]{3})" + _STOP, (3, 1, 2)),
    (_START + "([0-9]{1,2})[.] ?([0-9]{1,2})[.] ?([12][0-9]{3})" + _STOP, (3, 2, 1)),
)

# Title delimiters, tried in this order; the longest piece is kept.
TITLE_SPLITTERS = ("|", " - ", "_", " / ", " » ")


def clean_html(html: Column) -> Column:
    return F.regexp_replace(F.concat(html, F.lit(PAGE_END)), RAW_RX, " ")


def marked_html(html: Column) -> Column:
    """Block tags rewritten to markers: \\x01 tag \\x02 (end tags with their slash)."""
    return F.regexp_replace(clean_html(html), BLOCK_RX, C_BLK + "$1$2" + C_TAG)


def _stop_count(text: Column) -> Column:
    words = F.split(F.regexp_replace(F.lower(text), NON_WORD_RX, ""), " ")
    return F.size(F.filter(words, lambda w: w.isin(*STOP_WORDS)))


# --- the stack of open elements ---------------------------------------------------------------

_BIT = {t: 1 << i for i, t in enumerate(STACK_TAGS)}
_STACK = "array<struct<bit:bigint,tag:string,id:int,dropped:boolean>>"
_CHUNK = 64


def _bits(tags) -> int:
    return sum(_BIT[t] for t in set(tags))


_RULE = ("near", "stop", "top", "top2", "own")


def _tag_rules() -> Column:
    """MAP of a marked tag to what it does to the stack: the sets of its rule, of the
    two elements that it ends at the top, and its own bit if it opens an element."""
    none = ((), ())
    entries = []
    for tag in ("body", *STACK_TAGS):
        tops = _bits(("p", "head")), _bits(HEADINGS if tag in HEADINGS else ())
        for name, (near, stop), top, own in ((tag, OPEN_RULES.get(tag, none), tops, _BIT.get(tag, 0)),
                                             ("/" + tag, END_RULES.get(tag, none), (0, 0), 0)):
            values = zip(_RULE, (_bits(near), _bits(stop), *top, own), strict=True)
            entries.append(f"'{name}', named_struct({', '.join(f'{k!r}, {v}L' for k, v in values)})")
    return F.expr(f"map({', '.join(entries)})")  # one literal


def _has(element: Column, mask: Column | int) -> Column:
    return element["bit"].bitwiseAND(mask) != 0


def _pop(stack: Column, k: Column | int) -> Column:
    return F.slice(stack, F.lit(1) + k, F.greatest(F.size(stack), F.lit(1)))


def _step(stack: Column, e: Column) -> Column:
    """The stack (innermost element first) after the tag of piece ``e``."""
    def closed(s):
        place = F.array_position(F.transform(s, lambda x: _has(x, e["near"].bitwiseOR(e["stop"]))), True).cast("int")
        return F.when(e["near"] == 0, s).otherwise(once(place, lambda at: F.when(
            (at > 0) & _has(F.get(s, at - 1), e["near"]), _pop(s, at)).otherwise(s)))

    def without_top(s, mask):
        return F.when(_has(F.get(s, F.lit(0)), mask), _pop(s, 1)).otherwise(s)

    def opened(s):
        outer = F.get(s, F.lit(0))
        new = F.struct(
            e["own"].alias("bit"), e["tag"].alias("tag"), e["pos"].alias("id"),
            (F.coalesce(outer["dropped"], F.lit(False)) | (e["own"].bitwiseAND(_bits(DROP_TAGS)) != 0)).alias("dropped"))
        return F.when((e["own"] != 0) & (F.size(s) < MAX_DEPTH), F.array_prepend(s, new)).otherwise(s)

    return once(closed(stack), lambda a: once(without_top(a, e["top"]), lambda b: once(
        without_top(b, e["top2"]), opened)))


def _inside(events: Column) -> Column:
    """For each piece the innermost open element's tag, whether it is dropped, and its path.

    The fold runs twice, so that no array grows with the page inside it: over
    chunks for the stack at the start of each, then within each chunk.
    """
    # an array built in a lambda would be built again for every chunk
    return once(events, _folded)


def _folded(pieces: Column) -> Column:
    empty = F.array().cast(_STACK)
    part = lambda c: F.slice(pieces, c * _CHUNK + 1, F.lit(_CHUNK))

    def element(stack):
        top = F.get(stack, F.lit(0))
        ids = F.transform(F.filter(stack, lambda x: _has(x, _bits(CONTAINER_TAGS))), lambda x: x["id"])
        return F.struct(F.coalesce(top["tag"], F.lit("")).alias("tag"), F.coalesce(top["dropped"], F.lit(False)).alias("dropped"),
                        F.reverse(F.array_append(ids, F.lit(0))).alias("path"))

    last = F.floor((F.size(pieces) - 1) / _CHUNK).cast("int")
    starts = F.aggregate(
        F.slice(F.sequence(F.lit(0), last), F.lit(1), last),
        F.struct(F.array().cast(f"array<{_STACK}>").alias("all"), empty.alias("stack")),
        lambda acc, c: F.struct(F.array_append(acc["all"], acc["stack"]).alias("all"),
                                F.aggregate(part(c), acc["stack"], _step).alias("stack")),
        lambda acc: F.array_append(acc["all"], acc["stack"]))
    none = F.array().cast("array<struct<tag:string,dropped:boolean,path:array<int>>>")
    return F.flatten(F.transform(starts, lambda stack, c: F.aggregate(
        part(c), F.struct(stack.alias("stack"), none.alias("out")),
        lambda acc, e: once(_step(acc["stack"], e), lambda s: F.struct(
            s.alias("stack"), F.array_append(acc["out"], element(s)).alias("out"))),
        lambda acc: acc["out"])))


def blocks(html: Column) -> Column:
    """ARRAY<STRUCT<pos, section, path, tag, text, n_words, n_stop, link_words, n_links>>.

    Only blocks with non-empty text are kept; ``pos`` is the block's index
    among all pieces of the page, so it orders blocks; ``section`` is the last
    of its path.
    """
    rules = _tag_rules()
    still = F.struct(*[F.lit(0).cast("long").alias(k) for k in _RULE])

    def event(p, i):
        at = F.instr(p, C_TAG)
        tag = F.when(at > 0, F.lower(F.substring(p, F.lit(1), at - 1))).otherwise(F.lit(""))
        return once(tag, lambda t: once(F.coalesce(F.try_element_at(rules, t), still), lambda r: F.struct(
            i.alias("pos"), t.alias("tag"), *[r[k].alias(k) for k in _RULE])))

    def placed(pieces):
        seen = F.transform(_inside(F.transform(pieces, event)), lambda e, i: F.struct(
            i.alias("pos"), e["dropped"].alias("dropped"), e["path"].alias("path"), e["tag"].alias("tag")))
        return F.transform(F.filter(seen, lambda b: ~b["dropped"]), lambda b: once(body(F.get(pieces, b["pos"])), lambda text: F.struct(
            b["pos"].alias("pos"), b["path"].alias("path"), b["tag"].alias("tag"), text.alias("body"),
            F.regexp_extract_all(text, F.lit(ANCHOR_RX), F.lit(1)).alias("anchors"))))

    def body(piece):
        return F.substr(piece, F.instr(piece, C_TAG) + 1)  # a page's first piece has no mark

    split = once(F.split(marked_html(html), C_BLK), placed)

    def texts(b):
        return F.struct(
            b["pos"].alias("pos"), b["path"].alias("path"), b["tag"].alias("tag"),
            html_text(b["body"]).alias("text"),
            F.when(F.size(b["anchors"]) > 0, html_text(F.array_join(b["anchors"], " ")))
            .otherwise(F.lit("")).alias("link_text"),
            F.size(b["anchors"]).alias("n_links"))

    def features(b):
        return F.struct(
            b["pos"].alias("pos"), F.element_at(b["path"], -1).alias("section"), b["path"].alias("path"),
            b["tag"].alias("tag"), b["text"].alias("text"),
            word_count(b["text"]).alias("n_words"),
            _stop_count(b["text"]).alias("n_stop"),
            word_count(b["link_text"]).alias("link_words"),
            b["n_links"].alias("n_links"))

    with_text = F.filter(F.transform(split, texts), lambda b: b["text"] != "")
    return F.transform(with_text, features)


def is_good(b: Column) -> Column:
    return ((b["tag"] != "h1") & (b["n_stop"] > 2)
            & (b["link_words"] * b["n_links"] < b["n_words"]))


BOOST, BOOST_OVER, BOOST_REACH = 5, 5, 3


def scored_blocks(blks: Column) -> Column:
    """Good blocks as (path, text, score): the block's stop words, and ``BOOST``
    more if one of the ``BOOST_REACH`` blocks before it has over ``BOOST_OVER``."""
    def score(all_blocks):
        def near(i):
            hits = [F.coalesce(F.get(all_blocks, i - k)["n_stop"] > BOOST_OVER, F.lit(False))
                    for k in range(1, BOOST_REACH + 1)]
            return hits[0] | hits[1] | hits[2]

        marked = F.transform(all_blocks, lambda b, i: F.struct(
            is_good(b).alias("good"), b["path"].alias("path"), b["text"].alias("text"),
            (b["n_stop"] + F.when(near(i), F.lit(BOOST)).otherwise(F.lit(0))).alias("score")))
        return F.filter(marked, lambda b: b["good"])

    return once(blks, score)


def _best(good: Column) -> Column:
    """The container with the largest sum of scores, half a block's score counting for
    the second one outward; the lower id on ties; -1 if there is no good block."""
    def votes(b):
        one = F.struct(F.element_at(b["path"], -1).alias("id"), (b["score"] * 2).alias("score"))
        two = F.struct(F.try_element_at(b["path"], F.lit(-2)).alias("id"), b["score"].alias("score"))
        return F.when(F.size(b["path"]) > 1, F.array(one, two)).otherwise(F.array(one))

    zero = F.struct(F.lit(-1).alias("cur"), F.lit(0).alias("cur_sum"),
                    F.lit(-1).alias("best"), F.lit(-1).alias("best_sum"))

    def merge(acc, v):
        same = v["id"] == acc["cur"]
        close = ~same & (acc["cur_sum"] > acc["best_sum"])
        return F.struct(
            v["id"].alias("cur"),
            F.when(same, acc["cur_sum"] + v["score"]).otherwise(v["score"]).alias("cur_sum"),
            F.when(close, acc["cur"]).otherwise(acc["best"]).alias("best"),
            F.when(close, acc["cur_sum"]).otherwise(acc["best_sum"]).alias("best_sum"))

    return F.aggregate(F.sort_array(F.flatten(F.transform(good, votes))), zero, merge, lambda acc: F.when(
        acc["cur_sum"] > acc["best_sum"], acc["cur"]).otherwise(acc["best"]))


def best_section(blks: Column) -> Column:
    """The container that wins (NULL if there is no good block)."""
    return once(_best(scored_blocks(blks)), lambda best: F.when(best >= 0, best))


def main_text(blks: Column) -> Column:
    """Good blocks inside the best container, joined by a blank line ('' if none)."""
    return once(scored_blocks(blks), lambda good: once(_best(good), lambda best: F.array_join(
        F.transform(F.filter(good, lambda b: F.array_contains(b["path"], best)), lambda b: b["text"]),
        "\n\n")))


def _longest(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(""),
                       lambda acc, x: F.when(F.length(x) > F.length(acc), x).otherwise(acc))


def _norm(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), NON_ALNUM_RX, "")


def split_title(t: Column) -> Column:
    """Longest piece at the first delimiter present (the whole title if none)."""
    out = t
    for d in reversed(TITLE_SPLITTERS):
        pieces = F.transform(F.split(t, "\\Q" + d + "\\E"), lambda x: F.trim(x))
        out = F.when(F.contains(t, F.lit(d)), _longest(pieces)).otherwise(out)
    return out


def title_text(html: Column) -> Column:
    """Text of the first ``<title>`` element ('' if none)."""
    return squeeze(unescape_entities(F.regexp_replace(
        F.regexp_extract(html, TITLE_RX, 1), "<[^>]*>", "")))


def og_title(html: Column) -> Column:
    """``og:title`` meta content ('' if none)."""
    return squeeze(unescape_entities(F.coalesce(
        F.nullif(F.regexp_extract(html, OG_TITLE_RX, 1), F.lit("")),
        F.regexp_extract(html, OG_TITLE_REV_RX, 1))))


def choose_title(t: Column, blks: Column, og: Column) -> Column:
    """Title from <title> text ``t``, the longest <h1> (if over 2 words) and
    og:title. Pass ``t`` and ``og`` as columns: each is referenced several times."""
    h1 = _longest(F.transform(F.filter(blks, lambda b: b["tag"] == "h1"),
                              lambda b: b["text"]))
    h = F.when(word_count(h1) > 2, h1).otherwise(F.lit(""))
    return (F.when(t == "", F.coalesce(F.nullif(h, F.lit("")), og))
            .when((h != "") & (_norm(h) == _norm(t)), h)
            .when((h != "") & (og != "") & (_norm(h) == _norm(og)), h)
            .when((og != "") & F.startswith(_norm(t), _norm(og)), og)
            .otherwise(split_title(t)))


def title(html: Column, blks: Column) -> Column:
    """Title of a page (convenience form of :func:`choose_title`)."""
    return choose_title(title_text(html), blks, og_title(html))


def loose_date(c: Column) -> Column:
    """'yyyy-MM-dd' of a date in one of ``DATE_FORMS``; NULL if it is none, or no real date."""
    def form(rx, groups):
        year, month, day = (F.regexp_extract(c, rx, k) for k in groups)
        named = F.instr(F.lit(MONTHS), F.lower(F.substring(month, 1, 3)))
        number = month if "jan" not in rx else ((named + 2) / 3).cast("int").cast("string")
        text = F.concat_ws("-", year, F.lpad(number, 2, "0"), F.lpad(day, 2, "0"))
        return F.when(F.regexp_like(c, F.lit(rx)), date_text(text))

    return F.coalesce(*[form(rx, groups) for rx, groups in DATE_FORMS])


def jsonld_dates(html: Column) -> Column:
    """Every ``datePublished`` of the page's JSON-LD: of an object, of the objects of an
    array, and of those in a ``@graph``. What is no JSON has none."""
    def date(v):
        return F.array(F.try_variant_get(v, "$.datePublished", "string"))

    def items(v, path):
        return F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))

    def graph(v):
        return F.flatten(F.transform(items(v, "$['@graph']"), date))

    def script(text):
        return once(F.try_parse_json(text), lambda v: F.concat(
            date(v), graph(v), F.flatten(F.transform(items(v, "$"), lambda x: F.concat(date(x), graph(x))))))

    return F.flatten(F.transform(F.regexp_extract_all(html, F.lit(JSONLD_RX), F.lit(1)), script))


def publish_date(url: Column, html: Column) -> Column:
    """First real date of the page's sources, in their order."""
    found = lambda c, rx: F.regexp_extract_all(c, F.lit(rx), F.lit(1))
    none = F.array().cast("array<string>")
    cands = F.concat(*[F.coalesce(c, none) for c in (
        found(url, URL_DATE_SLASH_RX), found(url, URL_DATE_DASH_RX), found(html, META_DATE_RX), found(html, META_DATE_REV_RX),
        found(html, TIME_DATE_RX), F.when(F.contains(html, F.lit("ld+json")), jsonld_dates(html)), found(html, JSONLD_DATE_RX))])
    return F.get(F.filter(F.transform(cands, loose_date), lambda d: d.isNotNull()), F.lit(0))
