"""DuckDB statement of the phrase report: all n-grams counted directly."""

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def collocations_sql(min_count: int = 100, top: int = 2000) -> str:
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces),
totals AS (SELECT lang, sum(len(ws)) AS n FROM worded GROUP BY lang),
grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase
  FROM worded, (VALUES (1), (2), (3), (4), (5)) AS sizes(m) WHERE len(ws) >= m),
f AS (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY lang, m, phrase HAVING count(*) >= {min_count}),
kept AS (
  SELECT lang, m, phrase, a FROM f AS c
  WHERE m >= 2 AND NOT EXISTS (
    SELECT 1 FROM f AS q WHERE q.lang = c.lang AND q.m > c.m AND 100 * q.a >= 100 * c.a
      AND contains(' ' || q.phrase || ' ', ' ' || c.phrase || ' '))),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
         array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS tail
  FROM kept, (VALUES (1), (2), (3), (4)) AS places(k) WHERE k < m),
valued AS (
  SELECT c.lang, c.phrase, c.a, c.k, h.a AS l, t.a AS r, n,
         ((1000 * c.a)::HUGEINT * n::HUGEINT) // (h.a::HUGEINT * t.a::HUGEINT) AS score
  FROM cuts AS c JOIN f AS h ON h.lang = c.lang AND h.phrase = c.head
  JOIN f AS t ON t.lang = c.lang AND t.phrase = c.tail JOIN totals ON totals.lang = c.lang),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM valued),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE place = 1)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= {top}"""
