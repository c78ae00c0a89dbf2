"""DuckDB SQL for the operators that SQL can express, as plain brute force.

Learned models (5, 7, 8, 9), Newton and eigenvector iterations (3, 12) and greedy merging (1)
are not expressed; tests hold them against brute-force versions instead.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SUBSTRINGS = f"""
WITH w AS (SELECT doc_id, coalesce({_WORDS.format(text="text")}, []) AS ws FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i,
         unnest(list_transform(range(1, len(ws) - 48), lambda i: md5(array_to_string(ws[i:i + 49], ' ')))) AS h
  FROM w WHERE len(ws) >= 50),
firsts AS (SELECT h, min(doc_id) AS low FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
  FROM windows JOIN firsts USING (h) WHERE low < doc_id),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

NEAR_DOCUMENTS = f"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce({_WORDS.format(text=_LOWER)}, []) AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * n_both >= 75 * (x.size + y.size - n_both)),
reach AS (SELECT a AS doc_id, a AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
low AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(n.size, 0) AS BIGINT) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id,
       coalesce(component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN low ON low.doc_id = w.doc_id
"""

NEAR_VECTORS = """
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT a AS vec_id, a AS other FROM links UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other),
low AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, coalesce(component_id, v.vec_id) AS component_id,
       coalesce(component_id, v.vec_id) = v.vec_id AS kept
FROM embeddings v LEFT JOIN n ON n.vec_id = v.vec_id LEFT JOIN low ON low.vec_id = v.vec_id
"""

_BLANKS = r"[\x20\x09-\x0D]+"

REPETITION = f"""
WITH w AS (SELECT doc_id, text, coalesce({_WORDS.format(text="text")}, []) AS ws FROM documents),
size AS (
  SELECT doc_id, len(ws) AS n, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS chars,
         coalesce(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')), 0) AS symbols FROM w),
words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(list_transform(ws, lambda x: length(x))) AS chars FROM w),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM w),
marked AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id, line ORDER BY place) > 1 AS again, length(regexp_replace(line, '{_BLANKS}', '', 'g')) AS chars
  FROM lines WHERE length(regexp_replace(line, '{_BLANKS}', '', 'g')) > 0),
per_line AS (
  SELECT doc_id, count(*) AS n, count_if(again) AS dup, coalesce(sum(chars) FILTER (again), 0) AS dup_chars FROM marked GROUP BY doc_id),
runs AS (
  SELECT doc_id, p AS i, word, {", ".join(f"lead(word, {k}) OVER (PARTITION BY doc_id ORDER BY p) AS w{k}" for k in range(1, 10))}
  FROM (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM w)),
grams AS (
  {" UNION ALL ".join(f"SELECT doc_id, {n} AS n, i, concat_ws(' ', word, {', '.join(f'w{k}' for k in range(1, n))}) AS g FROM runs WHERE w{n - 1} IS NOT NULL" for n in range(2, 11))}),
counted AS (
  SELECT doc_id, n, i, length(g) - n + 1 AS chars, count(*) OVER (PARTITION BY doc_id, n, g) AS times,
         row_number() OVER (PARTITION BY doc_id, n, g ORDER BY i) AS nth FROM grams),
top AS (
  SELECT doc_id, {", ".join(f"max(times * chars) FILTER (n = {n}) AS t{n}" for n in (2, 3, 4))}
  FROM counted WHERE n <= 4 AND times >= 3 GROUP BY doc_id),
spread AS (
  SELECT DISTINCT doc_id, n, unnest(range(i, i + n)) AS p FROM counted WHERE (n >= 5 AND nth > 1) OR (n = 3 AND times > 1)),
covered AS (
  SELECT doc_id, count(*) FILTER (n = 3) AS repeated, {", ".join(f"sum(chars) FILTER (n = {n}) AS d{n}" for n in range(5, 11))}
  FROM spread JOIN words USING (doc_id, p) GROUP BY doc_id),
shares AS (
  SELECT s.doc_id, s.n AS n_words, s.chars AS word_chars, CAST(symbols AS BIGINT) AS n_symbols, CAST(coalesce(l.dup, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(repeated, 0) AS BIGINT) AS n_repeat_words, coalesce(CAST(l.dup AS DOUBLE) / l.n, 0.0) AS dup_line_share,
         coalesce(CAST(l.dup_chars AS DOUBLE), 0.0) / greatest(s.chars, 1) AS dup_line_char_share,
         {", ".join(f"coalesce(CAST(t{n} AS DOUBLE), 0.0) / greatest(s.chars, 1) AS t{n}" for n in (2, 3, 4))},
         {", ".join(f"coalesce(CAST(d{n} AS DOUBLE), 0.0) / greatest(s.chars, 1) AS dup_{n}gram_share" for n in range(5, 11))}
  FROM size s LEFT JOIN per_line l ON l.doc_id = s.doc_id LEFT JOIN top ON top.doc_id = s.doc_id LEFT JOIN covered c ON c.doc_id = s.doc_id),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM shares)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND dup_line_char_share <= 0.20 AND t2 <= 0.20 AND t3 <= 0.18 AND t4 <= 0.16 AND dup_5gram_share <= 0.20
         AND dup_6gram_share <= 0.19 AND dup_7gram_share <= 0.18 AND dup_8gram_share <= 0.17 AND dup_9gram_share <= 0.16
         AND dup_10gram_share <= 0.15 AS kept,
       dup_line_share, dup_line_char_share, least(t2, 1.0) AS top_2gram_share, least(t3, 1.0) AS top_3gram_share,
       least(t4, 1.0) AS top_4gram_share, dup_5gram_share, dup_6gram_share, dup_7gram_share, dup_8gram_share, dup_9gram_share,
       dup_10gram_share
FROM judged
"""

_TERMS = rf"coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

CONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS ws FROM documents),
b AS (SELECT item_id, {_TERMS} AS ws FROM benchmark),
item_windows AS (
  SELECT item_id, least(len(ws), 10) AS k, unnest(list_transform(range(1, greatest(len(ws) - 8, 2)),
    lambda i: array_to_string(ws[i:i + 9], ' '))) AS w
  FROM b WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT k FROM item_windows),
places AS (
  SELECT doc_id, k, unnest(range(1, len(ws) - k + 2)) AS i,
         unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS w
  FROM d CROSS JOIN sizes WHERE len(ws) >= k),
found AS (SELECT doc_id, i, p.k, item_id FROM places p JOIN item_windows m ON m.w = p.w AND m.k = p.k),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""

RANKED_SEARCH = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS ws FROM documents),
long AS (SELECT doc_id, len(ws) AS n FROM d WHERE len(ws) > 0),
total AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM long),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ws) AS term FROM d) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * max(big_n) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs CROSS JOIN total GROUP BY term),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
lengths AS (SELECT doc_id, CAST(10 + (90 * n * big_n) // big_l AS BIGINT) AS m FROM long CROSS JOIN total),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
"""

SQL = {
    "op2_substring_dedup": SUBSTRINGS,
    "op4_quality_rules": REPETITION,
    "op6_embedding_near_dedup": NEAR_VECTORS,
    "op10_minhash_near_dedup": NEAR_DOCUMENTS,
    "op11_decontamination": CONTAMINATION,
    "op13_lexical_search": RANKED_SEARCH,
}
