"""SQL equivalents of the queries that SQL can express, for DuckDB over the same tables."""

WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = rf"""
WITH items AS (
  SELECT item_id, {WORDS} AS w FROM benchmark
), windows AS MATERIALIZED (
  SELECT DISTINCT item_id, list_slice(w, s, s + least(10, len(w)) - 1) AS span
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM items WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT len(span) AS n FROM windows
), docs AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS r, {WORDS} AS w FROM documents
), hits AS MATERIALIZED (
  SELECT DISTINCT r, s, n, span FROM (
    SELECT r, n, s, list_slice(w, s, s + n - 1) AS span
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM docs, sizes WHERE len(w) >= n)
  ) WHERE span IN (SELECT span FROM windows)
), words AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hits) GROUP BY r
), found AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits JOIN windows USING (span) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""

SUBSTRING = r"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS MATERIALIZED (
  SELECT doc_id, r, s, list_slice(w, s, s + 12) AS span
  FROM (SELECT doc_id, r, w, unnest(range(1, len(w) - 11)) AS s FROM docs WHERE len(w) >= 13)
), later AS MATERIALIZED (
  SELECT r, s FROM (SELECT r, s, doc_id, min(doc_id) OVER (PARTITION BY span) AS first FROM windows) WHERE doc_id > first
), gone AS (
  SELECT r, list_distinct(flatten(list(range(s, s + 13)))) AS g FROM later GROUP BY r
), kept AS (
  SELECT doc_id, w, coalesce(g, []) AS g FROM docs LEFT JOIN gone USING (r)
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(g) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(g, i)), ' ')) AS kept_sha256
FROM kept
"""

LINES = r"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS r, coalesce(doc_id, 9223372036854775807) AS rank, string_split(text, chr(10)) AS lines FROM documents
), pairs AS MATERIALIZED (
  SELECT r, rank, i, list_slice(lines, i, i + 1) AS pair
  FROM (SELECT r, rank, lines, unnest(range(1, len(lines))) AS i FROM docs WHERE len(lines) > 1)
), firsts AS MATERIALIZED (
  SELECT pair, min((rank, i)) AS first FROM pairs WHERE regexp_matches(array_to_string(pair, ''), '[^\x20\x09-\x0D]') GROUP BY pair HAVING count(*) > 1
), gone AS MATERIALIZED (
  SELECT r, i FROM pairs JOIN firsts USING (pair) WHERE rank > first[1] OR i > first[2] + 1
), chunks AS (
  SELECT r, count(*) AS n_chunks FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM gone) WHERE before IS NULL OR before < i - 1 GROUP BY r
), covered AS (
  SELECT r, list_distinct(flatten(list([i, i + 1]))) AS g FROM gone GROUP BY r
)
SELECT doc_id, coalesce(len(lines), 0) AS n_lines, coalesce(n_chunks, 0) AS n_chunks, coalesce(len(g), 0) AS n_removed_lines,
       sha256(coalesce(array_to_string(list_filter(lines, lambda x, i: NOT list_contains(coalesce(g, []), i)), chr(10)), '')) AS kept_sha256
FROM docs LEFT JOIN covered USING (r) LEFT JOIN chunks USING (r)
"""

EMBEDDINGS = """
WITH RECURSIVE vectors AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), links AS MATERIALIZED (
  SELECT a.vec_id AS u, b.vec_id AS w FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
  SELECT u, w FROM links UNION SELECT reach.u, links.w FROM reach JOIN links ON reach.w = links.u
)
SELECT vec_id, (SELECT count(*) FROM links WHERE u = vec_id) AS n_links,
       least(vec_id, coalesce((SELECT min(w) FROM reach WHERE u = vec_id), vec_id)) AS component_id,
       coalesce((SELECT min(w) FROM reach WHERE u = vec_id), vec_id) >= vec_id AS kept
FROM vectors
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS MATERIALIZED (
  SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM words GROUP BY lang
), grams AS MATERIALIZED (
  SELECT lang, w, count(*) AS f FROM (
    SELECT lang, list_slice(w, s, s + m - 1) AS w
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM words, range(1, 6) AS sizes(m) WHERE len(w) >= m)
  ) GROUP BY lang, w HAVING count(*) >= 100
), cuts AS MATERIALIZED (
  SELECT lang, w, f AS a, k, list_slice(w, 1, k) AS left_part, list_slice(w, k + 1, len(w)) AS right_part
  FROM (SELECT lang, w, f, unnest(range(1, len(w))) AS k FROM grams WHERE len(w) > 1)
), scored AS (
  SELECT c.lang, c.w, c.a, c.k, x.f AS l, y.f AS r, t.n, 1000 * CAST(c.a AS HUGEINT) * t.n // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.w = c.left_part JOIN grams y ON y.lang = c.lang AND y.w = c.right_part JOIN totals t ON t.lang = c.lang
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1
), longer AS MATERIALIZED (
  SELECT DISTINCT lang, list_slice(w, s, s + m - 1) AS w, f
  FROM (SELECT lang, w, f, m, unnest(range(1, len(w) - m + 2)) AS s FROM grams, range(2, 5) AS sizes(m) WHERE len(w) > m)
), held AS (
  SELECT lang, w, max(f) AS f FROM longer GROUP BY lang, w
), kept AS (
  SELECT o.*, array_to_string(o.w, ' ') AS phrase FROM lowest o LEFT JOIN held h ON h.lang = o.lang AND h.w = o.w
  WHERE h.f IS NULL OR 100 * h.f < 100 * o.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept QUALIFY rank <= 2000
"""

STATEMENTS = {
    "op5_line_dedup": LINES,
    "op6_embedding_near_dedup": EMBEDDINGS,
    "op8_winnowing_decontamination": DECONTAMINATION,
    "op9_substring_dedup": SUBSTRING,
    "op11_phrase_collocations": COLLOCATIONS,
}
