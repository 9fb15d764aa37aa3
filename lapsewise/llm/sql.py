"""SQL for the queries that it can express, in DuckDB's dialect."""

_RULES = "('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')"

_URL = rf"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULES}),
rest AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages
),
hosts AS (SELECT page_id, url, r, regexp_extract(r, '^[^/?#]*') AS h FROM rest),
parts AS (
  SELECT row_number() OVER () AS row_no, page_id,
         translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path
  FROM hosts
),
fits AS (
  SELECT row_no, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(rule_verdict, length(rule_host || rule_path)) AS verdict
  FROM parts, rules
  WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY row_no
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (row_no)
"""

_TOP_K = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q, whole c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM placed WHERE place <= 5
"""

#: Words of the lower-cased text, as the word operators take them.
_WORDS = (
    "list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
)
_SHINGLES = "list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i : i + {n} - 1], ' '))"

_LEAKS = f"""
WITH items AS (
  SELECT item_id, w, least(5, len(w)) AS wide
  FROM (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL) WHERE len(w) > 0
),
item_shingles AS (SELECT DISTINCT item_id, wide, unnest({_SHINGLES.format(n="wide")}) AS s FROM items),
sizes AS (SELECT item_id, count(*) AS n_shingles FROM item_shingles GROUP BY item_id),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
doc_shingles AS (
  SELECT DISTINCT doc_id, wide, unnest({_SHINGLES.format(n="wide")}) AS s
  FROM docs, (SELECT DISTINCT wide FROM items) WHERE len(w) >= wide
),
shared AS (
  SELECT doc_id, item_id, count(*) AS n_shared
  FROM doc_shingles JOIN item_shingles USING (wide, s) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM shared JOIN sizes USING (item_id) WHERE 10 * n_shared >= 8 * n_shingles
"""

_COMPONENTS = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE {_SHINGLES.format(n=5)} END) AS s
  FROM docs WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 80 * (x.n + y.n - common)
),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT reach.doc_id, coalesce(max(n), 0) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes ON sizes.doc_id = reach.doc_id GROUP BY reach.doc_id
"""

_SPELLINGS = r"""
WITH RECURSIVE byte_steps AS (  -- what a byte does to a crc32, bit by bit
  SELECT i, i AS c, 0 AS bits FROM range(256) t(i)
  UNION ALL
  SELECT i, xor(c >> 1, 3988292384 * (c & 1)), bits + 1 FROM byte_steps WHERE bits < 8
),
crc AS (SELECT list(c ORDER BY i) AS steps FROM byte_steps WHERE bits = 8),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
),
named AS (SELECT doc_id, run, count(*) AS n, hex(encode(doc_id || ':' || run)) AS name FROM runs GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(name), 2), lambda i: ('0x' || substr(name, i, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS h
  FROM named, crc
),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
         CAST(sum(n) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5
),
less AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM words, range(1, (SELECT max(length(word)) + 1 FROM words)) t(i) WHERE i <= length(word)
),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM words a JOIN less b ON a.word = b.rest
  UNION
  SELECT b.word, a.word, a.n FROM words a JOIN less b ON a.word = b.rest
),
placed AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place FROM pairs),
variants AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN placed p ON p.word = w.word AND place = 1
),
steps AS (
  SELECT word, word AS root, form AS next FROM variants
  UNION ALL
  SELECT s.word, s.next, v.form FROM steps s JOIN variants v ON v.word = s.next
)
SELECT v.word, v.form, s.root, v.n, v.n_near, v.form_n FROM variants v JOIN steps s ON s.word = v.word AND s.next IS NULL
"""

_MIX = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS key
  FROM documents
),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2.0 * sum(size) AS most,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
  FROM sized GROUP BY source
),
levels AS (  -- from the source that fills up first: the level if all before it are full
  SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(most) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM sources
  WINDOW w AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
goals AS (
  SELECT source, source_size,
         CAST(least(most, (SELECT level FROM levels WHERE most > level * weight ORDER BY most / weight, source NULLS LAST LIMIT 1) * weight) AS DOUBLE) AS target
  FROM levels
),
placed AS (
  SELECT doc_id, size, g.source_size, g.target, g.source,
         CASE WHEN g.source_size > 0 THEN least(floor(target / g.source_size), 2) ELSE 0 END AS epochs,
         row_number() OVER (PARTITION BY g.source ORDER BY key, doc_id NULLS FIRST, size) AS place
  FROM sized JOIN goals g ON sized.source IS NOT DISTINCT FROM g.source
),
walked AS (  -- each document in turn, if it still fits
  SELECT source, CAST(0 AS BIGINT) AS place, any_value(target - epochs * source_size) AS room, false AS part FROM placed GROUP BY source
  UNION ALL
  SELECT p.source, p.place, CASE WHEN p.size <= room THEN room - p.size ELSE room END, p.size > 0 AND p.size <= room
  FROM walked w JOIN placed p ON p.source IS NOT DISTINCT FROM w.source AND p.place = w.place + 1
)
SELECT doc_id, size, source_size, target, CAST(size * (epochs + CAST(part AS INTEGER)) AS BIGINT) AS taken
FROM placed p JOIN walked w ON p.source IS NOT DISTINCT FROM w.source AND p.place = w.place
"""

ORACLE_SQL = {"op3_ngram_jaccard": _COMPONENTS, "op2_benchmark_decontamination": _LEAKS, "op4_url_filters": _URL, "op8_exact_top_k": _TOP_K, "op11_spelling_variants": _SPELLINGS, "op12_mixing": _MIX}
