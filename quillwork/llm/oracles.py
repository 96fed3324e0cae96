"""DuckDB SQL for the queries that SQL can express."""

from . import licenses

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP2 = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
k AS (SELECT doc_id, i, line, translate(trim(line, {BLANKS}), '{UP}', '{LOW}') AS key FROM l),
c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, k.i, k.line, c.last IS NOT NULL AND c.last <> k.doc_id AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP8 = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, source, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
e AS (SELECT doc_id, unnest(ws) AS w0, unnest(range(len(ws))) AS i FROM w),
t3 AS (SELECT doc_id, i, w0, lead(w0) OVER o AS w1, lead(w0, 2) OVER o AS w2 FROM e WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i FROM t3 WHERE w2 IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, w0, w1, w2) > 1),
cov AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r) GROUP BY doc_id),
ln AS (SELECT doc_id, source, unnest(ls) AS line FROM w),
nk AS (SELECT doc_id, source, lower(regexp_replace(trim(line, {BLANKS}), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS k,
  len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n FROM ln),
hd AS (SELECT source, count(*) AS docs FROM documents GROUP BY source),
c AS (SELECT nk.source, k FROM nk JOIN hd ON nk.source IS NOT DISTINCT FROM hd.source GROUP BY nk.source, k, docs HAVING count(DISTINCT doc_id) > 10 AND 100 * count(DISTINCT doc_id) > 5 * docs),
lost AS (SELECT nk.doc_id, sum(nk.n) AS n FROM nk JOIN c ON nk.k = c.k AND nk.source IS NOT DISTINCT FROM c.source GROUP BY nk.doc_id),
b AS (SELECT w.doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
  coalesce(cov.n, 0) AS n_repeat_words, coalesce(lost.n, 0)::BIGINT AS n_lost_words
  FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_lost_words <= 0.5 * n_words AS kept, n_lost_words
FROM b
"""

OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), '{UP}', '{LOW}') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS c FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
langs AS (SELECT lang, sum(c)::HUGEINT AS n, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
own AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
tot AS (SELECT lang, source, sum(c)::HUGEINT AS n FROM own GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(o.c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(o.c, 0) + 5)) // (coalesce(t.n, 0) + 5 * l.v) AS p,
  1 + (1000000000::HUGEINT * (k.c + 5)) // (l.n + 5 * l.v) AS q
  FROM g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term LEFT JOIN tot t ON t.lang = g.lang AND t.source = g.source),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

OP12 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), '{UP}', '{LOW}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
s AS (SELECT count(*)::BIGINT AS n, sum(len(ts))::BIGINT AS l FROM d WHERE len(ts) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY r, term),
df AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, s GROUP BY term, n),
m AS (SELECT r, doc_id, 75 + (25 * len(ts) * n) // l AS m FROM d, s WHERE len(ts) > 0),
q AS (SELECT i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UP}', '{LOW}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM (SELECT row_number() OVER () AS i, * FROM benchmark)),
x AS (SELECT i, item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score FROM q JOIN df USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id, r) AS rank FROM x WHERE score > 0) WHERE rank <= 20
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: Words stand between two spaces each here, so a signature may take one on either side. Every detection is compared with every other of its row.
RULES = ", ".join(f"({i}, {_quoted(label)}, {_quoted(key)}, {cls}, {_quoted(' (?:' + regex.replace(' ', '  ') + ') ')})" for i, (label, key, cls, regex) in enumerate(licenses.rules()))
PLACES = " UNION ALL ".join(
    f"SELECT r, unnest(list_filter(range(1, len(ws) + 1), lambda i: ws[i:i + {len(words) - 1}] = {words}))::BIGINT - 1 AS pos, {_quoted(label)} AS label FROM d"
    for words, label in ((phrase.split(), label) for phrase, label in licenses.PHRASES.items())
)
OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UP}', '{LOW}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
t AS (SELECT r, ' ' || array_to_string(ws, '  ') || ' ' AS t, ws FROM d),
rules(rule, label, key, class, regex) AS (VALUES {RULES}),
hit AS (SELECT r, rule, rules.label, class, regexp_extract_all(t, regex) AS ms, string_split_regex(t, regex) AS gaps FROM t, rules WHERE list_contains(ws, key) AND regexp_matches(t, regex)),
each AS (SELECT r, rule, label, class, length(ms[i]) AS n, list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS a
  FROM hit, unnest(range(1, len(ms) + 1)) AS u(i)),
found AS (SELECT r, rule, label, class, a, a + n AS b FROM each),
kept AS (SELECT * FROM found f WHERE NOT EXISTS (SELECT 1 FROM found g WHERE g.r = f.r AND g.class <= f.class AND g.a <= f.a AND g.b >= f.b
  AND (g.b - g.a > f.b - f.a OR (g.class, g.rule) < (f.class, f.rule)))),
places AS ({PLACES}),
base AS (SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list_sort(list_distinct(list(label))) AS ls FROM places GROUP BY r),
own AS (SELECT r, list(DISTINCT label) AS ls, max(CASE class WHEN 1 THEN 1.0 WHEN 2 THEN 0.9 ELSE 0.6 END)::DOUBLE AS worth FROM kept GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word, coalesce(array_to_string(base.ls, ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.ls, []), coalesce(own.ls, [])))), ',') AS labels,
  greatest(coalesce(worth, 0.0), CASE WHEN n_base > 0 THEN 0.9 ELSE 0.0 END)::DOUBLE AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN own USING (r)
"""

SQL = {"op2_line_dedup": OP2, "op8_quality_rules": OP8, "op11_source_divergence": OP11, "op12_lexical_search": OP12, "op13_license_scan": OP13}
