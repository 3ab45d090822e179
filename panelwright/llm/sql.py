"""DuckDB SQL of the operators that SQL can express."""

from panelwright.llm import line_rules as rules

_BLANK = r"[\x20\x09-\x0D]+"

#: The base counts and the verdict of the line rules for each row of ``documents``.
LINE_RULES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, [x for x in regexp_split_to_array(t, '{_BLANK}') if x <> ''] AS ws FROM d),
win AS (
  SELECT r, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
keyed AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k FROM win),
twice AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, k) AS n FROM keyed) WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT i + o) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS o) GROUP BY r),
lines AS (
  SELECT r, doc_id, host, t, unnest(string_split(t, chr(10))) AS raw FROM d),
full_lines AS (
  SELECT * FROM lines WHERE regexp_matches(raw, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT raw) AS n FROM full_lines GROUP BY r),
folded AS (
  SELECT r, doc_id, host, t, len([x for x in regexp_split_to_array(raw, '{_BLANK}') if x <> '']) AS words,
    trim(regexp_replace(regexp_replace(lower(raw), '[0-9]', '0', 'g'), '{_BLANK}', ' ', 'g')) AS line
  FROM full_lines),
often AS (
  SELECT host, line FROM folded GROUP BY host, line HAVING count(DISTINCT t) > {rules.MAX_DOCS}),
lost AS (
  SELECT doc_id, sum(words) AS n FROM folded JOIN often USING (host, line) GROUP BY doc_id),
counts AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '{rules.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(lost.n, 0) AS BIGINT) AS lost_words
  FROM w LEFT JOIN dup USING (r) LEFT JOIN covered USING (r) LEFT JOIN lost ON lost.doc_id = w.doc_id)
SELECT doc_id, n_words, word_chars, n_repeat_words, n_symbols, n_dup_lines,
  n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed,
  lost_words,
  NOT (n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words)
    AND lost_words <= {rules.MAX_LOST} * n_words AS kept
FROM counts
"""

#: What the formatted conversations hold, from the turns themselves.
CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(role) + length(regexp_replace(role, '[^~<[|]', '', 'g'))
    + length(text) + length(regexp_replace(text, '[^~<[|]', '', 'g')) + 8 AS chars
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

#: Rows of ``embeddings`` that take part, as integer vectors.
_VECTORS = """
  SELECT row_number() OVER () AS r, vec_id, CAST(label AS BIGINT) AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

#: The five rows of highest inner product for each query.
TOP_K = f"""
WITH v AS ({_VECTORS}),
s AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM ranked WHERE k <= 5
"""

#: The negatives of each anchor and positive.
HARD_NEGATIVES = f"""
WITH all_rows AS ({_VECTORS}),
v AS (
  SELECT r, vec_id, q, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM all_rows WHERE label IS NOT NULL),
s AS (
  SELECT a.r, a.vec_id AS anchor_id, b.r AS other, b.vec_id, a.label = b.label AS same,
    CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS k FROM s WHERE same),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
    s.score AS negative_score, row_number() OVER (PARTITION BY p.r, p.k ORDER BY s.score DESC, s.vec_id) AS k
  FROM p JOIN s ON s.r = p.r AND NOT s.same
  WHERE p.k <= 5 AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE k <= 5
"""

#: Divergences of every pair of sources over all kept terms, and the terms that stand out.
DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
sizes AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM grp LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    CAST(1 + (1000000000 * (coalesce(c.n, 0)::HUGEINT + 2)) // (s.total::HUGEINT + 2 * l.v) AS HUGEINT) AS p,
    CAST(1 + (1000000000 * (k.n::HUGEINT + 2)) // (l.total::HUGEINT + 2 * l.v) AS HUGEINT) AS q
  FROM sizes AS s JOIN kept AS k USING (lang) JOIN langs AS l USING (lang)
  LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM grp AS a JOIN grp AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums AS s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS k FROM pairs
  UNION ALL
  SELECT * FROM (
    SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value,
      row_number() OVER (PARTITION BY lang, source ORDER BY ((p - q) * (p - q)) // (p + q) DESC, term) AS k
    FROM p WHERE n > 0 AND p > q) WHERE k <= 10)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(k AS INTEGER) AS rank FROM ranked
"""
