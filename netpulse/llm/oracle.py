"""Reference SQL (DuckDB) for the text operators that SQL can express."""

from __future__ import annotations

from . import rules

#: op9: equal after lower-casing A-Z; the largest id of a group stays.
OP9 = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM t WINDOW g AS (PARTITION BY norm)
"""

#: op10: trigram stupid backoff, all counts from the documents themselves.
OP10 = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
t AS (SELECT doc_id, unnest(ws) AS w3, generate_subscripts(ws, 1) AS i FROM d),
g AS (SELECT *, lag(w3) OVER o AS w2, lag(w3, 2) OVER o AS w1 FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
uni AS (SELECT w3 AS b, count(*) AS n FROM g GROUP BY 1),
bi AS (SELECT w2 AS a, w3 AS b, count(*) AS n FROM g WHERE w2 IS NOT NULL GROUP BY 1, 2),
tri AS (SELECT w1 AS a, w2 AS b, w3 AS c, count(*) AS n FROM g WHERE w1 IS NOT NULL GROUP BY 1, 2, 3),
s AS (
  SELECT g.doc_id, g.i,
    CASE WHEN tri.n >= 1 THEN 2 WHEN b23.n >= 1 THEN 1 ELSE 0 END AS context,
    CASE WHEN tri.n >= 1 THEN ln(tri.n / b12.n)
         WHEN b23.n >= 1 THEN ln(b23.n / u2.n) + CASE WHEN g.i > 2 THEN ln(0.4::DOUBLE) ELSE 0 END
         ELSE ln(u3.n / (SELECT count(*) FROM t)) + least(g.i - 1, 2) * ln(0.4::DOUBLE) END AS ls
  FROM g JOIN uni u3 ON u3.b = g.w3 LEFT JOIN uni u2 ON u2.b = g.w2
  LEFT JOIN bi b23 ON b23.a = g.w2 AND b23.b = g.w3 LEFT JOIN bi b12 ON b12.a = g.w1 AND b12.b = g.w2
  LEFT JOIN tri ON tri.a = g.w1 AND tri.b = g.w2 AND tri.c = g.w3)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words,
       count(s.i) FILTER (WHERE context < least(s.i - 1, 2)) AS n_backed_off, round(sum(ls) / len(d.ws), 6) AS log_score
FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id, len(d.ws)
"""

#: op12: integer BM25 of every document for every item.
OP12 = r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
l AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
a AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM l),
m AS (SELECT doc_id, 100 - 90 + (90 * n * docs) // terms AS m FROM l, a),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM c, a GROUP BY term, docs),
s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN c USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""

#: op13: lines whose key three documents share stay in the largest document alone.
OP13 = r"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM s),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS keep_id FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
d AS (SELECT k.*, coalesce(doc_id <> keep_id, false) AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""


def _divergence_sql() -> str:
    """op5: counting rules, histograms in long form, medians of permille shares as references, limits."""
    commons = " ".join(f"WHEN lang = '{k}' THEN {v.split()}" for k, v in rules.COMMON_WORDS.items())
    listed = ", ".join(f"'{k}'" for k in rules.COMMON_WORDS)
    part = "CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({a} + {b})) ELSE 0 END"
    pq = part.format(a="p", b="q") + " + " + part.format(a="q", b="p")
    counted = "length(regexp_replace(text, '{}', '', 'g'))"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i + 4], ' ')) AS n
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
rep AS (SELECT doc_id, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n_repeat_words
    FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM win WHERE n > 1) GROUP BY doc_id),
b AS (SELECT w.*, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    {counted.format('[^#*$%&|<>]')}::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    list_transform(ws, lambda x: rtrim(lower(x), '.,')) AS plain, CASE {commons} END AS cw
    FROM w LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    [{counted.format('[^A-Z]')}, {counted.format('[\x00-\x7F]')}, length(text) - word_chars,
     {counted.format('[^.,;:!?]')}, n_symbols] AS c5,
    coalesce(list_transform(cw, lambda c: len(list_filter(plain, lambda x: x = c))), [0 for _ in range({rules.N_COMMON})]) AS w20
    FROM b),
g AS (SELECT *, list_append(c5, length(text) - list_sum(c5)) AS cs, list_append(w20, n_words - list_sum(w20)) AS wv FROM f),
long AS (SELECT doc_id, lang, 'c' AS kind, unnest(cs) AS v, generate_subscripts(cs, 1) AS pos FROM g
    UNION ALL SELECT doc_id, lang, 'w', unnest(wv), generate_subscripts(wv, 1) FROM g),
h AS (SELECT *, v / nullif(sum(v) OVER (PARTITION BY doc_id, kind), 0) AS p FROM long),
sound AS (SELECT min(doc_id) AS doc_id FROM g WHERE NOT base_failed AND n_words >= {rules.REFERENCE_WORDS} GROUP BY lang, text),
s AS (SELECT lang, kind, pos, (1000 * v) // (sum(v) OVER (PARTITION BY doc_id, kind))::BIGINT AS s FROM long JOIN sound USING (doc_id)),
m1 AS (SELECT lang, kind, pos, quantile_disc(s, 0.5) AS m FROM s GROUP BY lang, kind, pos HAVING count(*) >= {rules.REFERENCE_TEXTS}),
m0 AS (SELECT kind, pos, quantile_disc(s, 0.5) AS m FROM s WHERE kind = 'c' OR lang IN ({listed}) GROUP BY kind, pos),
r AS (SELECT lang, kind, pos, coalesce(m1.m, m0.m) AS m FROM (SELECT DISTINCT lang FROM g) CROSS JOIN m0 LEFT JOIN m1 USING (lang, kind, pos)
    WHERE kind = 'c' OR lang IN ({listed})),
q AS (SELECT lang, kind, pos, m / sum(m) OVER (PARTITION BY lang, kind) AS q FROM r),
d2 AS (SELECT doc_id, sqrt(greatest(sum({pq}) FILTER (WHERE kind = 'c'), 0) / 2) AS c, sqrt(greatest(sum({pq}) FILTER (WHERE kind = 'w'), 0) / 2) AS w
    FROM h JOIN q USING (lang, kind, pos) WHERE p IS NOT NULL GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT (n_words >= {rules.MIN_CLASS_WORDS} AND coalesce(c, 0) > {rules.MAX_CLASS_DISTANCE})
    AND NOT (n_words >= {rules.MIN_WORD_WORDS} AND coalesce(w, 0) > {rules.MAX_WORD_DISTANCE}) AS kept
FROM g LEFT JOIN d2 USING (doc_id)
"""


ORACLE_SQL = {"op5_quality_rules": _divergence_sql(), "op10_lm_scoring": OP10, "op12_ranked_search": OP12, "op13_line_dedup": OP13,
              "op9_exact_dedup": OP9}
