"""The equivalent SQL of the registered queries that SQL can express."""

from __future__ import annotations

EXPECTED_SQL: dict[str, str] = {}

#: Words of a text, as every query here cuts them.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

EXPECTED_SQL["op10_quality_rules"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
starts AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) > 3),
windows AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t FROM starts),
twice AS (SELECT *, count(*) OVER (PARTITION BY r, t) AS n FROM windows),
hit AS (
  SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS j FROM twice WHERE n > 1),
repeats AS (SELECT r, sum(least(3, i - coalesce(j, -2))) AS n FROM hit GROUP BY r),
m AS (
  SELECT doc_id, text, w, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
    len(string_split(text, chr(10))) AS n_lines, coalesce(repeats.n, 0) AS n_repeat_words
  FROM d LEFT JOIN repeats USING (r)),
b AS (
  SELECT *, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 14 * n_words
    OR 100 * n_symbols > 5 * greatest(word_chars, 1) OR 100 * n_dup_lines > 30 * n_lines
    OR 100 * len(list_distinct(w)) < 15 * least(greatest(n_words, 1), 200)
    OR 100 * length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) > 30 * greatest(word_chars, 1)
    OR 100 * len(list_filter(string_split(text, chr(10)),
        lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) > 90 * n_lines) AS kept
FROM b
"""

EXPECTED_SQL["op11_hard_negatives"] = """
WITH r AS (
  SELECT row_number() OVER () AS r, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::DOUBLE) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)),
s AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
    list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM r a JOIN r b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
p AS (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS k FROM s WHERE alike),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
    s.score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p.k ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.a = s.a AND NOT s.alike
    AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
  WHERE p.k <= 5)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5
"""
