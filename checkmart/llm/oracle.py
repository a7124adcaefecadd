"""The results of the operators as DuckDB SQL, where SQL can express them."""

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP1 = f"""
WITH words AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (
  SELECT doc_id, k, md5(array_to_string(ws[k:k + 49], ' ')) AS h
  FROM words, unnest(range(1, len(ws) - 48)) AS t(k)),
least AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(k, k + 50)) AS p FROM win JOIN least USING (h) WHERE m < doc_id),
kept AS (
  SELECT w.doc_id, count(*) AS n, string_agg(w.ws[w.p], ' ' ORDER BY w.p) AS t
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM words) w
  ANTI JOIN gone USING (doc_id, p) GROUP BY w.doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

OP3 = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda k: array_to_string(ws[k:k + 4], ' ')) END)) AS s FROM words),
classes AS (SELECT min(doc_id) AS c, s, count(*) AS n_copies, len(s) AS n FROM sets GROUP BY s),
grams AS (SELECT c, unnest(s) AS g FROM classes),
rare AS (SELECT g FROM grams GROUP BY g HAVING count(*) > 1),
common AS (
  SELECT a.c AS a, b.c AS b, count(*) AS k FROM (grams JOIN rare USING (g)) a JOIN grams b USING (g)
  WHERE a.c <> b.c GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN classes x ON x.c = a JOIN classes y ON y.c = b WHERE k >= 0.8 * (x.n + y.n - k) - 1e-9),
reach AS (SELECT c AS a, c AS b FROM classes UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
labels AS (SELECT a AS c, min(b) AS class_id FROM reach GROUP BY a),
degree AS (SELECT a AS c, count(*) AS k FROM links GROUP BY a)
SELECT doc_id, class_id, coalesce(k, 0)::BIGINT AS n_links, n_copies
FROM sets JOIN classes USING (s) JOIN labels USING (c) LEFT JOIN degree USING (c)
"""

_TERMS = (
    r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    r" 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
)

OP8 = f"""
WITH docs AS (SELECT doc_id, {_TERMS} AS ws FROM documents),
items AS (SELECT item_id, {_TERMS} AS ws FROM benchmark),
wanted AS (
  SELECT DISTINCT item_id, w, len(w) AS n FROM (
    SELECT item_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 10 THEN [ws]
      ELSE list_transform(range(1, len(ws) - 8), lambda k: ws[k:k + 9]) END) AS w FROM items)),
lens AS (SELECT DISTINCT n FROM wanted),
win AS (
  SELECT doc_id, n, k, ws[k:k + n - 1] AS w
  FROM docs, lens, unnest(range(1, len(ws) - n + 2)) AS t(k) WHERE len(ws) >= n),
hit AS (SELECT doc_id, item_id, win.n, k FROM win JOIN wanted USING (w)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hit) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

OP11 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM words, unnest([1, 2, 3, 4]) AS s(k), unnest(range(1, len(ws) - k + 2)) AS t(i)),
f AS (SELECT lang, k, phrase, count(*) AS a, string_split(phrase, ' ') AS ws FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
  SELECT lang, k, phrase, a, j, array_to_string(ws[1:j], ' ') AS lp, array_to_string(ws[j + 1:k], ' ') AS rp
  FROM f, unnest(range(1, k)) AS t(j)),
best AS (
  SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, ((2000000::HUGEINT * c.a) // (x.a + y.a))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.lp JOIN f y ON y.lang = c.lang AND y.phrase = c.rp
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.j) = 1),
around AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS b
  FROM f, unnest(range(2, k)) AS s(m), unnest(range(1, k - m + 2)) AS t(i) GROUP BY ALL),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM best LEFT JOIN around USING (lang, phrase) WHERE b IS NULL OR 100 * b < 80 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

OP12 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

ORACLE: dict[str, str] = {
    "op1_substring_dedup": OP1,
    "op3_ngram_jaccard_join": OP3,
    "op8_benchmark_decontamination": OP8,
    "op11_phrase_collocations": OP11,
    "op12_hard_negatives": OP12,
}
