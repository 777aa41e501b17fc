"""DuckDB SQL for the correctness oracles.

The same rules as the Spark operators, written a second time in plain SQL
over the driver's pre-registered tables. Regex texts, entity table and
stop-word list are shared with the Spark code (they are fixed values), the
logic is not: here it is list lambdas and CTEs.
"""

from __future__ import annotations

from ..functions import text as T
from ..functions.globs import globs_to_regex
from ..operators import html as H
from ..operators.stopwords import STOP_WORDS
from ..sources import responses as R


def lit(s: str) -> str:
    """SQL string literal; control characters become chr() calls."""
    parts, buf = [], ""
    for ch in s:
        if ord(ch) < 32:
            if buf:
                parts.append("'" + buf.replace("'", "''") + "'")
                buf = ""
            parts.append(f"chr({ord(ch)})")
        else:
            buf += ch
    if buf or not parts:
        parts.append("'" + buf.replace("'", "''") + "'")
    return "(" + " || ".join(parts) + ")"


def rx_replace(x: str, rx: str, rep: str) -> str:
    return f"regexp_replace({x}, {lit(rx)}, {rep}, 'g')"


# ---------------------------------------------------------------- scalar text

def decode_numeric(x: str) -> str:
    dec = f"regexp_extract(p, {lit(T.NUM_DEC_RX)}, 1)"
    hx = f"regexp_extract(p, {lit(T.NUM_HEX_RX)}, 1)"
    n = (f"(CASE WHEN {dec} <> '' THEN CAST({dec} AS BIGINT) "
         f"WHEN {hx} <> '' THEN CAST('0x' || {hx} AS BIGINT) END)")
    used = "strpos(p, ';')"
    return (f"array_to_string(list_transform(string_split({x}, '&#'), lambda p, i: "
            f"CASE WHEN i = 1 THEN p "
            f"WHEN {n} BETWEEN 1 AND 1114111 AND NOT ({n} BETWEEN 55296 AND 57343) "
            f"THEN chr(CAST({n} AS INTEGER)) || substring(p, {used} + 1) "
            f"ELSE '&#' || p END), '')")


def unescape(x: str) -> str:
    *named, amp = T.HTML_ENTITIES
    for ent, ch in named:
        x = f"replace({x}, {lit(ent)}, {lit(ch)})"
    return f"replace({decode_numeric(x)}, {lit(amp[0])}, {lit(amp[1])})"


def squeeze(x: str) -> str:
    return f"trim({rx_replace(x, T.WS_RUN_RX, lit(' '))})"


def strip_tags(x: str) -> str:
    return rx_replace(rx_replace(x, T.BR_RX, lit(" ")), T.TAG_RX, lit(""))


def html_text(x: str) -> str:
    return squeeze(unescape(strip_tags(x)))


def word_count(t: str) -> str:
    return f"(CASE WHEN {t} = '' THEN 0 ELSE len(string_split({t}, ' ')) END)"


STOP_LIST = ", ".join(lit(w) for w in STOP_WORDS)


def stop_count(t: str) -> str:
    words = f"string_split({rx_replace(f'lower({t})', H.NON_WORD_RX, lit(''))}, ' ')"
    return f"len(list_filter({words}, lambda w: w IN ({STOP_LIST})))"


def header(h: str, name: str) -> str:
    return f"(list_filter({h}, lambda x: lower(x.name) = {lit(name.lower())})[1].value)"


def date_text(x: str) -> str:
    return f"strftime(try_cast({x} AS DATE), '%Y-%m-%d')"


def source_domain(url: str) -> str:
    s = f"regexp_extract({url}, {lit(T.URL_ORIGIN_RX)}, 1)"
    a = f"regexp_extract({url}, {lit(T.URL_ORIGIN_RX)}, 2)"
    return f"(CASE WHEN {s} <> '' THEN lower({s}) || '://' || {a} END)"


def crawl_ts(path: str, prefix: str = "CC-NEWS") -> str:
    rx = prefix + "-([0-9]{14})-([0-9]{5})"
    return (f"try_strptime(nullif(regexp_extract({path}, {lit(rx)}, 1), ''), "
            f"'%Y%m%d%H%M%S')")


def serial(path: str, prefix: str = "CC-NEWS") -> str:
    rx = prefix + "-([0-9]{14})-([0-9]{5})"
    return f"CAST(nullif(regexp_extract({path}, {lit(rx)}, 2), '') AS INTEGER)"


def crawl_date(path: str) -> str:
    return f"strftime({crawl_ts(path)}, '%Y-%m-%d')"


def url_match(url: str, patterns: list[str]) -> str:
    rx = globs_to_regex(patterns)
    return "false" if rx is None else f"regexp_matches({url}, {lit(rx)})"


# ---------------------------------------------------------------- responses

def responses_cte() -> str:
    cts = "[" + ", ".join("NULL" if c is None else lit(c) for c in R.CONTENT_TYPES) + "]"
    hdr_t = "STRUCT(name VARCHAR, value VARCHAR)[]"
    return f"""responses AS (
  SELECT
    'crawl-data/CC-NEWS/' || strftime(ts, '%Y/%m') || '/CC-NEWS-' || strftime(ts, '%Y%m%d%H%M%S')
      || '-' || lpad(CAST(file_no AS VARCHAR), 5, '0') || '.warc.gz' AS warc_path,
    rec_idx,
    rec_idx * 4096 AS rec_offset,
    CASE WHEN file_no % 4 = 3 THEN NULL ELSE CAST({R.RECORDS_PER_FILE * 4096} AS BIGINT) END AS file_size,
    rec_type,
    list_filter([{{'name': 'WARC-Type', 'value': rec_type}},
                 {{'name': 'WARC-Target-URI', 'value': CASE WHEN rec_type <> 'warcinfo' THEN url END}},
                 {{'name': 'WARC-Date', 'value': strftime(ts, '%Y-%m-%dT%H:%M:%SZ')}}],
                lambda h: h.value IS NOT NULL) AS rec_headers,
    CASE WHEN rec_type = 'response' THEN 200 END AS http_status,
    CASE WHEN rec_type = 'warcinfo' THEN NULL
         WHEN rec_type = 'request' THEN CAST([] AS {hdr_t})
         ELSE list_filter([{{'name': 'Content-Type', 'value': ct}}], lambda h: h.value IS NOT NULL)
    END AS http_headers,
    CASE WHEN page_id % 17 = 0 THEN encode(html) || '\\xFF'::BLOB ELSE encode(html) END AS payload,
    CAST(NULL AS VARCHAR) AS payload_error
  FROM (
    SELECT page_id, url, html,
           page_id // {R.RECORDS_PER_FILE} AS file_no,
           CAST(page_id % {R.RECORDS_PER_FILE} AS BIGINT) AS rec_idx,
           TIMESTAMP '2021-01-01 00:00:00' + to_seconds((page_id // {R.RECORDS_PER_FILE}) * {R.SECONDS_PER_FILE}) AS ts,
           CASE WHEN page_id % 11 = 0 THEN 'request' WHEN page_id % 13 = 0 THEN 'warcinfo'
                ELSE 'response' END AS rec_type,
           {cts}[page_id % 7 + 1] AS ct
    FROM pages
  )
)"""


def classified_cte(patterns: list[str], src: str = "responses") -> str:
    url = header("rec_headers", "WARC-Target-URI")
    ct = header("http_headers", "Content-Type")
    return f"""classified0 AS (
  SELECT *, {url} AS url, {ct} AS content_type FROM {src}
),
classified AS (
  SELECT *, CASE WHEN valid AND payload_error IS NULL THEN try(decode(payload)) END AS html
  FROM (
    SELECT *, coalesce(rec_type = 'response' AND rec_headers IS NOT NULL
                       AND http_headers IS NOT NULL AND url IS NOT NULL
                       AND content_type IS NOT NULL
                       AND regexp_matches(content_type, {lit(T.UTF8_HTML_RX)})
                       AND {url_match('url', patterns)}, false) AS valid
    FROM classified0
  )
)"""


# ---------------------------------------------------------------- html

def _tags(tags) -> str:
    return "[" + ", ".join(lit(t) for t in tags) + "]::VARCHAR[]"


def _rule(kind: int) -> str:
    """CASE over a piece's tag: the elements it may close (0) or that stop it (1)."""
    whens = "".join(f" WHEN {lit(t)} THEN {_tags(r[kind])}" for t, r in H.OPEN_RULES.items()) + "".join(
        f" WHEN {lit('/' + t)} THEN {_tags(r[kind])}" for t, r in H.END_RULES.items())
    return f"CASE e.tag{whens} ELSE []::VARCHAR[] END"


def blocks_ctes(src: str, cols: str, prefix: str = "b") -> tuple[str, str]:
    """CTEs (of a WITH RECURSIVE) adding ``blocks`` to rows of ``src`` (needs url, html).
    Returns (sql, last). The stack of open elements is a recursive query over pieces."""
    marked = rx_replace(rx_replace(f"(html || {lit(H.PAGE_END)})", H.RAW_RX, lit(" ")),
                        H.BLOCK_RX, f"{lit(H.C_BLK)} || '\\1\\2' || {lit(H.C_TAG)}")
    at = f"instr(piece, {lit(H.C_TAG)})"
    anchors = f"regexp_extract_all(body, {lit(H.ANCHOR_RX)}, 1)"
    hit = "list_position(list_transform(s.stack, lambda x: list_contains(e.near || e.stop, x.tag)), true)"
    heads = _tags(H.HEADINGS)
    sql = f"""{prefix}1 AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, {cols}, {marked} AS marked FROM {src}
),
{prefix}2 AS (
  SELECT rid, i - 1 AS pos, CASE WHEN {at} > 0 THEN lower(substring(piece, 1, {at} - 1)) ELSE '' END AS tag,
         CASE WHEN {at} > 0 THEN substring(piece, {at} + 1) ELSE piece END AS body
  FROM (SELECT rid, unnest(string_split(marked, {lit(H.C_BLK)})) AS piece,
               generate_subscripts(string_split(marked, {lit(H.C_BLK)}), 1) AS i FROM {prefix}1)
),
{prefix}3 AS MATERIALIZED (SELECT e.*, {_rule(0)} AS near, {_rule(1)} AS stop FROM {prefix}2 e),
{prefix}s AS (
  SELECT rid, 0::BIGINT AS pos, []::STRUCT(tag VARCHAR, id BIGINT)[] AS stack FROM {prefix}1 WHERE marked IS NOT NULL
  UNION ALL
  SELECT rid, pos, CASE WHEN starts_with(tag, '/') OR tag = 'body' OR len(stack) >= {H.MAX_DEPTH} THEN stack
                        ELSE [{{'tag': tag, 'id': pos}}] || stack END
  FROM (SELECT rid, pos, tag, CASE WHEN list_contains({heads}, tag) AND list_contains({heads}, stack[1].tag) THEN stack[2:] ELSE stack END AS stack
        FROM (SELECT rid, pos, tag, CASE WHEN NOT starts_with(tag, '/') AND stack[1].tag IN ('p', 'head') THEN stack[2:] ELSE stack END AS stack
              FROM (SELECT e.rid, e.pos, e.tag, CASE WHEN {hit} > 0 AND list_contains(e.near, s.stack[{hit}].tag)
                                                     THEN s.stack[{hit} + 1:] ELSE s.stack END AS stack
                    FROM {prefix}s s JOIN {prefix}3 e ON e.rid = s.rid AND e.pos = s.pos + 1)))
),
{prefix}4 AS (
  SELECT e.rid, e.pos, coalesce(s.stack[1].tag, '') AS tag, body,
         [0::BIGINT] || list_reverse(list_transform(list_filter(s.stack, lambda x: list_contains({_tags(H.CONTAINER_TAGS)}, x.tag)),
                                                    lambda x: x.id)) AS path
  FROM {prefix}3 e JOIN {prefix}s s ON s.rid = e.rid AND s.pos = e.pos
  WHERE NOT list_has_any(list_transform(s.stack, lambda x: x.tag), {_tags(H.DROP_TAGS)})
),
{prefix}5 AS (
  SELECT rid, pos, tag, path, {html_text('body')} AS text, {html_text(f"array_to_string({anchors}, ' ')")} AS link_text,
         len({anchors}) AS n_links
  FROM {prefix}4
),
{prefix}6 AS (
  SELECT rid, list({{'pos': pos, 'section': path[-1], 'path': path, 'tag': tag, 'text': text,
      'n_words': {word_count('text')}, 'n_stop': {stop_count('text')},
      'link_words': {word_count('link_text')}, 'n_links': n_links}} ORDER BY pos) AS blocks
  FROM {prefix}5 WHERE text <> '' GROUP BY rid
),
{prefix}7 AS (
  SELECT {prefix}1.* EXCLUDE (rid, marked), CASE WHEN marked IS NOT NULL THEN coalesce(blocks, []) END AS blocks
  FROM {prefix}1 LEFT JOIN {prefix}6 USING (rid)
)"""
    return sql, f"{prefix}7"


GOOD = "(b.tag <> 'h1' AND b.n_stop > 2 AND b.link_words * b.n_links < b.n_words)"


def _scored(blocks: str) -> str:
    # 5 more for a block with over 5 stop words in one of the three blocks before it
    marked = (f"list_transform({blocks}, lambda b, i: {{'good': {GOOD}, 'path': b.path, 'score': b.n_stop + "
              f"CASE WHEN coalesce(list_max(list_transform({blocks}[greatest(i - 3, 1):i - 1], lambda p: p.n_stop)), 0) > 5 "
              f"THEN 5 ELSE 0 END}})")
    return f"list_filter({marked}, lambda m: m.good)"


def best_section(blocks: str = "blocks") -> str:
    """The container of the largest score, counted twice for a block's own container
    and once for the next one outward."""
    good = _scored(blocks)
    ids = f"list_distinct(flatten(list_transform({good}, lambda m: m.path)))"
    scored = (f"list_transform({ids}, lambda s: {{'score': list_sum(list_transform({good}, lambda m: "
              f"m.score * (CASE WHEN m.path[-1] = s THEN 2 WHEN len(m.path) > 1 AND m.path[-2] = s THEN 1 ELSE 0 END))), 'neg': -s}})")
    return f"(-(list_max({scored}).neg))"


def main_text(blocks: str = "blocks") -> str:
    best = best_section(blocks)
    chosen = f"list_filter({blocks}, lambda b: {GOOD} AND list_contains(b.path, {best}))"
    return f"array_to_string(list_transform({chosen}, lambda b: b.text), chr(10) || chr(10))"


def longest(lst: str) -> str:
    return (f"list_reduce({lst}, lambda acc, x: CASE WHEN length(x) > length(acc) "
            f"THEN x ELSE acc END, '')")


def norm(x: str) -> str:
    return rx_replace(f"lower({x})", H.NON_ALNUM_RX, lit(""))


def split_title(t: str) -> str:
    whens = " ".join(
        f"WHEN contains({t}, {lit(d)}) THEN "
        f"{longest(f'list_transform(string_split({t}, {lit(d)}), lambda x: trim(x))')}"
        for d in H.TITLE_SPLITTERS)
    return f"(CASE {whens} ELSE {t} END)"


def title_ctes(src: str, prefix: str = "t") -> tuple[str, str]:
    t = squeeze(unescape(rx_replace(f"regexp_extract(html, {lit(H.TITLE_RX)}, 1)",
                                    "<[^>]*>", lit(""))))
    h1 = longest("list_transform(list_filter(blocks, lambda b: b.tag = 'h1'), lambda b: b.text)")
    og = squeeze(unescape(f"coalesce(nullif(regexp_extract(html, {lit(H.OG_TITLE_RX)}, 1), ''), "
                          f"regexp_extract(html, {lit(H.OG_TITLE_REV_RX)}, 1))"))
    sql = f"""{prefix}1 AS (
  SELECT *, {t} AS _t, {h1} AS _h1, {og} AS _og FROM {src}
),
{prefix}2 AS (
  SELECT *, CASE WHEN {word_count('_h1')} > 2 THEN _h1 ELSE '' END AS _h FROM {prefix}1
),
{prefix}3 AS (
  SELECT * EXCLUDE (_t, _h1, _og, _h),
    CASE WHEN _t = '' THEN coalesce(nullif(_h, ''), _og)
         WHEN _h <> '' AND {norm('_h')} = {norm('_t')} THEN _h
         WHEN _h <> '' AND _og <> '' AND {norm('_h')} = {norm('_og')} THEN _h
         WHEN _og <> '' AND starts_with({norm('_t')}, {norm('_og')}) THEN _og
         ELSE {split_title('_t')} END AS title
  FROM {prefix}2
)"""
    return sql, f"{prefix}3"


def loose_date(x: str) -> str:
    whens = ""
    for rx, groups in H.DATE_FORMS:
        year, month, day = (f"regexp_extract({x}, {lit(rx)}, {k})" for k in groups)
        if "jan" in rx:
            month = f"CAST((instr({lit(H.MONTHS)}, lower({month}[1:3])) + 2) // 3 AS VARCHAR)"
        text = f"{year} || '-' || lpad({month}, 2, '0') || '-' || lpad({day}, 2, '0')"
        whens += f" CASE WHEN regexp_matches({x}, {lit(rx)}) THEN {date_text(f'({text})')} END,"
    return f"coalesce({whens} NULL)"


def publish_date(url: str = "url", html: str = "html") -> str:
    def found(c, rx):
        return f"coalesce(regexp_extract_all({c}, {lit(rx)}, 1), [])"

    strings = lambda path: f"coalesce(json_extract_string(j, '{path}'), [])"
    jsonld = (f"flatten(list_transform(list_filter({found(html, H.JSONLD_RX)}, lambda j: json_valid(j)), lambda j: "
              f"[json_extract_string(j, '$.datePublished')] || {strings('$.\"@graph\"[*].datePublished')} || "
              f"{strings('$[*].datePublished')} || {strings('$[*].\"@graph\"[*].datePublished')}))")
    cands = " || ".join([found(url, H.URL_DATE_SLASH_RX), found(url, H.URL_DATE_DASH_RX), found(html, H.META_DATE_RX),
                         found(html, H.META_DATE_REV_RX), found(html, H.TIME_DATE_RX), jsonld, found(html, H.JSONLD_DATE_RX)])
    return f"(list_filter(list_transform({cands}, lambda c: {loose_date('c')}), lambda d: d IS NOT NULL)[1])"


# ---------------------------------------------------------------- language

def words(x: str) -> str:
    return f"string_split(trim({rx_replace(f'lower({x})', '[^\\p{L}]+', lit(' '))}), ' ')"


def grams(w: str) -> str:
    return (f"unnest([substring(' ' || {w} || ' ', i, 3) "
            f"for i in range(1, length({w}) + 1)])")


def profile_ctes(floor: float = 1e-6) -> str:
    return f"""doc_words AS (
  SELECT lang, unnest({words('text')}) AS word FROM documents
  WHERE lang IS NOT NULL AND text IS NOT NULL
),
doc_grams AS (SELECT lang, {grams('word')} AS gram FROM doc_words WHERE word <> ''),
profile_n AS (SELECT lang, gram, count(*) AS n FROM doc_grams GROUP BY lang, gram),
profile AS (
  SELECT lang, gram, n, ln(n) - ln(sum(n) OVER (PARTITION BY lang)) - ln({floor!r}) AS w
  FROM profile_n
)"""


def lang_ctes(src: str, keys: str = "warc_path, rec_idx", text: str = "detect_text") -> str:
    return f"""det_words AS (
  SELECT {keys}, unnest({words(text)}) AS word FROM {src} WHERE {text} IS NOT NULL
),
det_grams AS (SELECT {keys}, {grams('word')} AS gram FROM det_words WHERE word <> ''),
det_scores AS (
  SELECT {keys}, lang, sum(w) AS score FROM det_grams JOIN profile USING (gram)
  GROUP BY ALL
),
lang AS (
  SELECT {keys}, lang AS language FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, lang) AS rn
    FROM det_scores) WHERE rn = 1
)"""


# ---------------------------------------------------------------- pipeline

def dispositions_ctes(patterns: list[str] | None = None) -> str:
    """CTEs ending in ``disp``: every record with article fields and disposition."""
    patterns = ["*"] if patterns is None else patterns
    blocks_sql, last = blocks_ctes(
        "classified", "warc_path, rec_idx, rec_offset, file_size, rec_type, url, valid, html")
    title_sql, tlast = title_ctes(last)
    return f"""WITH RECURSIVE {responses_cte()},
{classified_cte(patterns)},
{blocks_sql},
{title_sql},
fields AS (
  SELECT warc_path, rec_idx, rec_offset, file_size, rec_type, url, valid,
         html IS NOT NULL AS decoded,
         CASE WHEN html IS NOT NULL THEN title END AS title,
         CASE WHEN html IS NOT NULL THEN {main_text()} END AS main_text,
         CASE WHEN html IS NOT NULL THEN {source_domain('url')} END AS source_domain,
         CASE WHEN html IS NOT NULL THEN {publish_date()} END AS date_publish,
         {crawl_date('warc_path')} AS date_crawled
  FROM {tlast}
),
fields2 AS (
  SELECT *, coalesce(nullif(main_text, ''), nullif(title, '')) AS detect_text FROM fields
),
{profile_ctes()},
{lang_ctes('fields2')},
disp AS (
  SELECT f.*, l.language,
         CASE WHEN NOT f.valid THEN 'discarded'
              WHEN NOT f.decoded OR l.language IS NULL THEN 'errored'
              ELSE 'extracted' END AS disposition
  FROM fields2 f LEFT JOIN lang l USING (warc_path, rec_idx)
)"""
