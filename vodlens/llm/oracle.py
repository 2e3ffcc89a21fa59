"""DuckDB SQL of the operators that SQL can express on whole tables."""

from __future__ import annotations

RANKED_SEARCH = r"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents WHERE text IS NOT NULL
),
counts AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term),
lengths AS (SELECT doc_id, CAST(sum(tf) AS bigint) AS n FROM counts GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS bigint) AS size FROM lengths),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double)) AS bigint) AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), total
),
norms AS (SELECT doc_id, 50 + (50 * n * docs) // size AS m FROM lengths, total),
asked AS (
  SELECT DISTINCT item_id, term FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE text IS NOT NULL)
),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS bigint) AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN norms USING (doc_id)
  GROUP BY item_id, doc_id
),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS integer) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

# Words and their runs of a fixed length, joined by a blank (no word holds one).
SUBSTRING = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, unnest([array_to_string(w[k:k + 19], ' ') for k in range(1, len(w) - 18)]) AS s
  FROM texts WHERE len(w) >= 20
),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS no FROM windows) WHERE no > 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM again),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM texts)
  ANTI JOIN gone USING (doc_id, i)
  GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS bigint) AS n_words, CAST(len(w) - coalesce(n, 0) AS bigint) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""

# Bytes as pairs of hexadecimal digits: byte b is at digit 2 * b + 1.
SUFFIX = r"""
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
strings AS (
  SELECT doc_id, b, substr(h, 2 * b + 1, 200) AS s
  FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS b FROM texts WHERE n >= 100)
),
again AS (
  SELECT doc_id, b FROM (SELECT doc_id, b, row_number() OVER (PARTITION BY s ORDER BY doc_id, b) AS no FROM strings) WHERE no > 1
),
islands AS (
  SELECT doc_id, b, sum(fresh) OVER (PARTITION BY doc_id ORDER BY b ROWS UNBOUNDED PRECEDING) AS island
  FROM (SELECT doc_id, b, CASE WHEN b <= lag(b) OVER (PARTITION BY doc_id ORDER BY b) + 100 THEN 0 ELSE 1 END AS fresh FROM again)
),
spans AS (SELECT doc_id, min(b) AS x, max(b) + 100 AS y FROM islands GROUP BY doc_id, island),
counts AS (SELECT doc_id, CAST(sum(y - x) AS bigint) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id),
pieces AS (  -- from the end of one span to the start of the next
  SELECT doc_id, x AS y, lag(y, 1, 0) OVER (PARTITION BY doc_id ORDER BY x) AS x
  FROM (SELECT doc_id, x, y FROM spans UNION ALL SELECT doc_id, n, n FROM texts)
),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY x, y) AS t FROM pieces JOIN texts USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(n AS bigint) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(t)) AS kept_sha256
FROM texts JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)
"""

# Documents with one shingle set are one class; links are looked for between classes.
JACCARD = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[k:k + 4], ' ') for k in range(1, len(w) - 3)]
    ELSE [array_to_string(w, ' ')] END) AS s
  FROM texts WHERE len(w) > 0
),
sets AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS id FROM shingles GROUP BY doc_id),
classes AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY id, n) AS class FROM sets),
held AS (SELECT class, n, s FROM classes JOIN shingles USING (doc_id) WHERE doc_id = class),
links AS (
  SELECT a.class AS a, b.class AS b
  FROM held a JOIN held b ON a.s = b.s AND a.class <> b.class AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.class, b.class, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
reached(class, other) AS (
  SELECT DISTINCT class, class FROM classes
  UNION
  SELECT r.class, l.b FROM reached r JOIN links l ON l.a = r.other
),
components AS (SELECT class, min(other) AS component_id FROM reached GROUP BY class)
SELECT doc_id, CAST(coalesce(n, 0) AS bigint) AS n_shingles, coalesce(component_id, doc_id) AS component_id, class AS class_id
FROM texts LEFT JOIN classes USING (doc_id) LEFT JOIN components USING (class)
"""

ORACLE_SQL: dict[str, str] = {
    "op3_suffix_dedup": SUFFIX, "op7_jaccard": JACCARD, "op9_substring": SUBSTRING, "op12_ranked_search": RANKED_SEARCH,
}
