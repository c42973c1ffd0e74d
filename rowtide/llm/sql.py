"""SQL for the corpus queries that SQL can express, over the same tables."""

from __future__ import annotations

import string

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"

OP1 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '{_WORD}') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 4 THEN ws ELSE ws[i:i + 3] END AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 3))) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), r AS (
  SELECT doc_id, doc_id AS m FROM w
  UNION
  SELECT r.doc_id, e.b FROM r JOIN (SELECT a, b FROM l UNION ALL SELECT b, a FROM l) e ON e.a = r.m
), k AS (
  SELECT doc_id, min(m) AS component_id FROM r GROUP BY doc_id
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, k.component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN k ON k.doc_id = w.doc_id
"""

OP6 = rf"""
WITH d AS (
  SELECT doc_id, coalesce('=' || source, 'null') AS host, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents
), x AS (
  SELECT doc_id, host, t, line, regexp_extract_all(line, '{_WORD}') AS lw
  FROM (SELECT doc_id, host, t, unnest(string_split(t, chr(10))) AS line FROM d)
), l AS (
  SELECT doc_id, host, line, len(lw) AS words, string_split(nl, ' ') AS seq, substr(md5(nl), 1, 16) AS h FROM (
    SELECT *, regexp_replace(translate(array_to_string(lw, ' '), {_LOWER}), '[0-9]+', '0', 'g') AS nl FROM x WHERE len(lw) > 0)
), sk AS (
  SELECT doc_id, md5(string_agg(DISTINCT h, ',' ORDER BY h)) AS page, count(*) - count(DISTINCT line) AS dup FROM l GROUP BY doc_id
), pl AS (
  SELECT DISTINCT host, page, h, seq FROM l JOIN sk USING (doc_id)
), c AS (
  SELECT host, h, any_value(seq) AS seq FROM pl GROUP BY host, h HAVING count(*) >= 10
), o AS (
  SELECT host, page, sum(len(pl.seq)) FILTER (WHERE c.h IS NOT NULL) AS common, coalesce(sum(len(pl.seq)) FILTER (WHERE c.h IS NULL), 0) AS rare,
    coalesce(string_agg(h, ',' ORDER BY h) FILTER (WHERE c.h IS NULL), '') AS own
  FROM pl LEFT JOIN c USING (host, h) GROUP BY host, page HAVING common > 0
), r AS (
  SELECT host, page, pl.h, pl.seq FROM pl JOIN o USING (host, page) ANTI JOIN c USING (host, h) WHERE o.rare > 0 AND o.common >= o.rare
), e AS (
  SELECT host, page, sum(len(seq)) AS edited FROM (
    SELECT DISTINCT r.host, r.page, r.h, r.seq FROM r JOIN c ON c.host = r.host
    WHERE least(coalesce(list_position(list_transform(list_zip(r.seq, c.seq), lambda z: z[1] IS NOT DISTINCT FROM z[2]), false), 1) - 1
        + coalesce(list_position(list_transform(list_zip(list_reverse(r.seq), list_reverse(c.seq)), lambda z: z[1] IS NOT DISTINCT FROM z[2]), false), 1) - 1,
        len(r.seq), len(c.seq)) >= 0.7::DOUBLE * greatest(len(r.seq), len(c.seq))
      AND NOT EXISTS (SELECT 1 FROM pl q WHERE q.host = r.host AND q.page = r.page AND q.h = c.h)
  ) GROUP BY host, page
), w AS (
  SELECT host, page, CASE WHEN rare = 0 THEN 'all ' || page WHEN 2 * coalesce(edited, 0) >= rare THEN 'near' ELSE 'own ' || own END AS same
  FROM o LEFT JOIN e USING (host, page)
), f AS (
  SELECT host, h FROM pl JOIN c USING (host, h) JOIN w USING (host, page) GROUP BY host, h HAVING count(DISTINCT same) >= 10
), b AS (
  SELECT l.doc_id, sum(l.words) AS lost FROM l JOIN f ON f.host = l.host AND f.h = l.h GROUP BY l.doc_id
), v AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times
  FROM (SELECT doc_id, i, ws[i:i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d))
), a AS (
  SELECT doc_id, count(DISTINCT i + k) AS again
  FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS k FROM v WHERE times > 1) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda c: length(c))), 0) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(sk.dup, 0) AS n_dup_lines,
    coalesce(a.again, 0) AS n_repeat_words, coalesce(b.lost, 0) AS n_boiler_words
  FROM d LEFT JOIN sk ON sk.doc_id = d.doc_id LEFT JOIN a ON a.doc_id = d.doc_id LEFT JOIN b ON b.doc_id = d.doc_id
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines,
  n_repeat_words, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * n_boiler_words <= 70 * n_words AS kept,
  CAST(n_boiler_words AS BIGINT) AS n_boiler_words
FROM m
"""

# Every pair is compared: the queries are a fiftieth of the rows.
OP7 = """
WITH c AS (
  SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 AND NOT isnan(x) THEN 1 ELSE 0 END) AS bits FROM embeddings
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS id,
    CAST(list_sum(list_transform(list_zip(q.bits, c.bits), lambda z: abs(z[1] - z[2]))) AS INTEGER) AS distance
  FROM c q, c WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS INTEGER) AS rank FROM p
)
SELECT query_id, rank, id, distance FROM r WHERE rank <= 10
"""

ORACLES = {"op1_jaccard": OP1, "op6_quality": OP6, "op7_hamming": OP7}
