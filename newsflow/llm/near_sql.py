"""DuckDB SQL for the near-duplicate query: the same links found by exact prefix filtering.

Sets whose Jaccard similarity reaches 0.8 share a shingle among the rarest
n - ceil(0.8 n) + 1 of each, so joining those prefixes loses no pair.
"""

from __future__ import annotations


def near_duplicates_sql(percent: int = 80) -> str:
    """Two-word shingles of ``documents``; columns of ``op3_near_duplicates``."""
    return f"""WITH RECURSIVE
    words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
              FROM documents),
    sets AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) < 2 THEN w ELSE
                list_transform(list_zip(w[1:len(w) - 1], w[2:]), lambda p: p[1] || ' ' || p[2]) END)) AS s FROM words),
    keyed AS (SELECT doc_id, len(s) AS n, s, md5(array_to_string(s, chr(10))) AS digest FROM sets),
    class AS MATERIALIZED (SELECT digest, min(doc_id) AS id, any_value(n) AS n, any_value(s) AS s FROM keyed WHERE n > 0 GROUP BY digest),
    shingle AS MATERIALIZED (SELECT id, n, unnest(s) AS sh FROM class),
    common AS (SELECT sh, count(*) AS df FROM shingle GROUP BY sh),
    ranked AS (SELECT id, n, sh, row_number() OVER (PARTITION BY id ORDER BY df, sh) AS place
               FROM shingle JOIN common USING (sh)),
    prefix AS MATERIALIZED (SELECT id, n, sh FROM ranked WHERE place <= n - ({percent} * n + 99) // 100 + 1),
    candidate AS (SELECT DISTINCT a.id AS a, b.id AS b, a.n AS an, b.n AS bn FROM prefix a JOIN prefix b ON a.sh = b.sh
                  WHERE a.id < b.id AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)),
    counted AS (SELECT a, b, an, bn, count(*) AS shared FROM candidate
                JOIN shingle x ON x.id = a JOIN shingle y ON y.id = b AND y.sh = x.sh GROUP BY a, b, an, bn),
    link AS MATERIALIZED (SELECT a, b FROM counted WHERE 100 * shared >= {percent} * (an + bn - shared)),
    edge AS MATERIALIZED (SELECT a AS u, b AS v FROM link UNION ALL SELECT b, a FROM link),
    reach AS (SELECT id, id AS root FROM class
              UNION SELECT e.v, r.root FROM reach r JOIN edge e ON e.u = r.id WHERE r.root < e.v),
    root AS (SELECT id, min(root) AS root FROM reach GROUP BY id)
    SELECT k.doc_id, CAST(k.n AS BIGINT) AS n_shingles, coalesce(r.root, k.doc_id) AS component_id,
           coalesce(r.root, k.doc_id) = k.doc_id AS kept, coalesce(c.id, k.doc_id) AS class_id
    FROM keyed k LEFT JOIN class c ON c.digest = k.digest AND k.n > 0 LEFT JOIN root r ON r.id = c.id"""
