"""Queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .byte_bpe import op10_byte_bpe
from .chunks import op6_substring_dedup
from .decontaminate import op3_decontamination
from .embeddings import op8_embedding_dedup
from .hmm import op1_hmm_score
from .jaccard import op4_ngram_jaccard
from .lines import op7_line_dedup
from .mixing import op13_source_mix
from .pages import op9_html_extraction
from .quality import op2_quality
from .spelling import op11_spelling_variants
from .unigram import op5_token_counts
from .whiten import op12_embedding_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hmm_score": op1_hmm_score,
    "op2_quality": op2_quality,
    "op3_decontamination": op3_decontamination,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_token_counts": op5_token_counts,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_html_extraction": op9_html_extraction,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_source_mix": op13_source_mix,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op3_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM win),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
occ AS (
  SELECT p.doc_id, p.i, s.m, array_to_string(p.w[p.i : p.i + s.m - 1], ' ') AS g
  FROM pos p, sizes s WHERE p.i + s.m - 1 <= len(p.w)),
hit AS (SELECT o.doc_id, o.i, o.m, win.item_id FROM occ o JOIN win ON o.m = win.m AND o.g = win.g),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM hit) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op4_ngram_jaccard": rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 4) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 4) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 85 * (a.n + b.n - k)),
both_ways AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
reach(x, y) AS (SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(min(y), d.doc_id)) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach ON reach.x = d.doc_id GROUP BY d.doc_id, n.n""",
    "op8_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e, row_number() OVER () AS r FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL),
p AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(x, y) AS (SELECT x, y FROM p UNION SELECT reach.x, p.y FROM reach JOIN p ON reach.y = p.x)
SELECT vec_id, coalesce((SELECT count(*) FROM p WHERE x = vec_id), 0) AS n_links,
  least(vec_id, coalesce((SELECT min(y) FROM reach WHERE x = vec_id), vec_id)) AS component_id,
  vec_id <= coalesce((SELECT min(y) FROM reach WHERE x = vec_id), vec_id) AS kept
FROM embeddings""",
    "op13_source_mix": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(concat_ws(':', '13', doc_id)), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2 * CAST(sum(size) AS BIGINT) AS cap FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
fill(step, rest, among, n) AS (
  SELECT 0, 1.5::DOUBLE * sum(source_size)::DOUBLE, sum(weight)::DOUBLE, 0::BIGINT FROM w
  UNION ALL
  SELECT step + 1, 1.5::DOUBLE * sum(source_size)::DOUBLE - coalesce(sum(cap) FILTER (weight * rest / among >= cap), 0)::DOUBLE,
    coalesce(sum(weight) FILTER (weight * rest / among < cap), 0)::DOUBLE, count(*) FILTER (weight * rest / among >= cap)
  FROM fill, w GROUP BY step, rest, among, n HAVING count(*) FILTER (weight * rest / among >= cap) > n),
goal AS (
  SELECT source, source_size, CASE WHEN among = 0 OR weight * rest / among >= cap THEN cap::DOUBLE ELSE weight * rest / among END AS target
  FROM w, (SELECT * FROM fill ORDER BY step DESC LIMIT 1) f),
o AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)
SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE
  CAST((CAST(floor(target + 0.5) AS BIGINT) // source_size) * size + greatest(0, least(size, CAST(floor(target + 0.5) AS BIGINT) % source_size - before)) AS BIGINT) END AS taken
FROM o JOIN goal ON o.source IS NOT DISTINCT FROM goal.source""",
    "op7_line_dedup": r"""
WITH l AS (
  SELECT doc_id, i, x, trim(x, ' ' || chr(9) || chr(13)) AS t
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents WHERE coalesce(text, '') <> '')),
s AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS p, CAST('0x' || substr(md5(t), 1, 15) AS BIGINT) AS h
  FROM l WHERE t <> ''),
g AS (
  SELECT doc_id, p, h, lag(h) OVER w AS before, lead(h, 2) OVER w AS after,
    CASE WHEN lead(h) OVER w IS NOT NULL THEN CAST('0x' || substr(md5(CAST(h AS VARCHAR) || ':' || CAST(lead(h) OVER w AS VARCHAR)), 1, 15) AS BIGINT) END AS g
  FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
c AS (SELECT *, lag(g) OVER w AS g0, lead(g) OVER w AS g1 FROM g WHERE g IS NOT NULL WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
f AS (SELECT * FROM c WHERE g < g1 OR g <= g0 OR (g0 IS NULL AND g1 IS NULL)),
src AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, p) AS k FROM f) WHERE k = 1),
m AS (
  SELECT f.doc_id, f.p - CASE WHEN f.before = src.before THEN 1 ELSE 0 END AS a, f.p + 1 + CASE WHEN f.after = src.after THEN 1 ELSE 0 END AS b
  FROM f JOIN src ON f.g = src.g WHERE f.doc_id > src.doc_id OR f.doc_id = src.doc_id AND f.p > src.p),
three AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY h, h1, h2 ORDER BY doc_id, p) AS k
  FROM (SELECT doc_id, p, h, lead(h) OVER w AS h1, lead(h, 2) OVER w AS h2 FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY p)) q WHERE h2 IS NOT NULL),
long AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS k FROM l WHERE t <> '' AND len(string_split_regex(t, '[ \x09-\x0D]+')) > 50),
gone AS (
  SELECT DISTINCT m.doc_id, s.i FROM m JOIN s ON s.doc_id = m.doc_id AND s.p BETWEEN a AND b
  UNION SELECT three.doc_id, s.i FROM three JOIN s ON s.doc_id = three.doc_id AND s.p BETWEEN three.p AND three.p + 2 WHERE three.k > 1
  UNION SELECT doc_id, i FROM long WHERE k > 1),
k AS (
  SELECT l.doc_id, string_agg(CASE WHEN gone.i IS NULL THEN l.x END, chr(10) ORDER BY l.i) AS t, count(*) AS n, count(gone.i) AS r
  FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.i = l.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_lines, coalesce(r, 0) AS n_removed, sha256(coalesce(t, '')) AS text_sha256
FROM documents d LEFT JOIN k USING (doc_id)""",
}
