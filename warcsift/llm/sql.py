"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from .quality import MIN_WORDS, MAX_REPEAT_PERCENT, STOP_WORDS

_SPACE = r"[\x20\x09-\x0D]+"
_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)

OP8 = rf"""
WITH a AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '{_SPACE}', '', 'g') <> '') AS ls
  FROM documents),
b AS (
  SELECT *, list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS g
  FROM a),
p AS (SELECT doc_id, unnest(g) AS g, generate_subscripts(g, 1) AS i FROM b),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM p),
c AS (SELECT doc_id, count(DISTINCT j) AS n_repeat
      FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT b.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (length(t) - length(regexp_replace(t, '[!?]', '', 'g')))::BIGINT AS n_marks,
         len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: lower(regexp_replace(x, '[.,]', '', 'g')) IN ({_STOPS})))::BIGINT AS n_stop
  FROM b LEFT JOIN c ON c.doc_id = b.doc_id),
v AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND 100 * word_chars >= 150 * n_words AND 100 * word_chars <= 2500 * n_words
  AND 100 * n_symbols <= 30 * n_words AND 100 * n_marks <= 50 * n_words AND 100 * n_stop >= 3 * n_words
  AND 100 * n_dup_lines <= 60 * n_lines AS kept
FROM v
"""

OP6 = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""

ORACLES = {"op6_exact_dedup": OP6, "op8_quality_rules": OP8}

OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents),
w AS (
  SELECT rid, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM d),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(term) AS v FROM (SELECT DISTINCT lang FROM d) LEFT JOIN k USING (lang) GROUP BY lang),
c AS (SELECT w.lang, source, w.term, count(*) AS n FROM w JOIN k ON k.lang = w.lang AND k.term = w.term GROUP BY w.lang, source, w.term),
cell AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
share AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p,
         1 + (1000000000::HUGEINT * (sum(n) OVER (PARTITION BY lang, term) + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q
  FROM cell JOIN v USING (lang)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM share WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
WHERE part = 'pair' OR rank <= 50
"""

ORACLES["op13_source_divergence"] = OP13
