"""DuckDB SQL that the queries of this package must agree with."""

DECONTAMINATION = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, len(v) AS n, array_to_string(v, ' ') AS win
  FROM (SELECT item_id, unnest(CASE WHEN len(w) < 10 THEN [w] ELSE [w[i:i+9] for i in range(1, len(w) - 8)] END) AS v
        FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
placed AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS spot
  FROM doc_words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
found AS (
  SELECT p.doc_id, p.spot, p.n, x.item_id FROM placed p JOIN windows x
  ON x.n = p.n AND x.win = array_to_string(p.w[p.spot:p.spot + p.n - 1], ' ')),
hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(spot, spot + n)) AS place FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(n.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(n.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit h USING (doc_id) LEFT JOIN named n USING (doc_id)
"""

EXACT_TOP_K = """
WITH parts AS (
  SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings WHERE vec_id IS NOT NULL),
whole AS (
  SELECT vec_id FROM parts GROUP BY vec_id HAVING bool_and(coalesce(isfinite(x), false))),
weights AS (
  SELECT vec_id, i, floor(1024 * x)::BIGINT AS v FROM parts SEMI JOIN whole USING (vec_id)),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.v * c.v)::BIGINT AS score
  FROM weights q JOIN weights c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(v, ' ') AS s
  FROM (SELECT doc_id, unnest(CASE WHEN len(w) < 5 THEN [w] ELSE [w[i:i+4] for i in range(1, len(w) - 3)] END) AS v
        FROM split WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)),
sides AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT x, y FROM sides UNION SELECT r.x, s.y FROM reach r JOIN sides s ON r.y = s.x),
least AS (SELECT x AS doc_id, min(y) AS m FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
       doc_id <= coalesce(m, doc_id) AS kept
FROM split LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""

SUFFIX_DEDUP = """
WITH coded AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
bytes AS (
  SELECT doc_id, place, substr(x, 2 * place - 1, 2) AS b,
         CASE WHEN 2 * (place + 99) <= length(x) THEN md5_number(substr(x, 2 * place - 1, 200)) END AS code
  FROM (SELECT doc_id, x, unnest(range(1, length(x) // 2 + 1)) AS place FROM coded)),
judged AS (
  SELECT doc_id, place, b,
         code IS NOT NULL AND row_number() OVER (PARTITION BY code ORDER BY doc_id, place) > 1 AS again FROM bytes),
covered AS (
  SELECT doc_id, place, b,
         bool_or(again) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM judged),
edges AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY place), false) AS head FROM covered),
summed AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (head) AS n_spans,
         coalesce(string_agg(b, '' ORDER BY place) FILTER (NOT gone), '') AS kept
  FROM edges GROUP BY doc_id)
SELECT doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM coded LEFT JOIN summed USING (doc_id)
"""

SUBSTRING_DEDUP = r"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, spot, array_to_string(w[spot:spot + 12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS spot FROM split WHERE len(w) >= 13)),
least AS (SELECT s, min(doc_id) AS d FROM windows GROUP BY s),
gone AS (
  SELECT DISTINCT doc_id, place
  FROM (SELECT doc_id, unnest(range(spot, spot + 13)) AS place FROM windows JOIN least USING (s) WHERE doc_id > d)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM split) ANTI JOIN gone USING (doc_id, place)
  GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""

PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
split AS (SELECT lang, w FROM (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces) WHERE len(w) > 0),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
runs AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS a
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM split, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size)
  GROUP BY ALL),
frequent AS (SELECT lang, size, phrase, a, string_split(phrase, ' ') AS w FROM runs WHERE a >= 30),
cuts AS (
  SELECT lang, size, phrase, a, k, array_to_string(w[1:k], ' ') AS first_part, array_to_string(w[k + 1:size], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM frequent WHERE size > 1)),
lowest AS (
  SELECT c.lang, c.size, c.phrase, c.a, x.a AS l, y.a AS r,
         (2000000::HUGEINT * c.a) // (x.a::HUGEINT + y.a) AS score
  FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.phrase = c.first_part
  JOIN frequent y ON y.lang = c.lang AND y.phrase = c.rest
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.k) = 1),
inner_runs AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer_a
  FROM (SELECT *, unnest(range(1, size - m + 2)) AS i FROM frequent, (SELECT unnest([2, 3]) AS m) WHERE size > m)
  GROUP BY ALL),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score
  FROM lowest LEFT JOIN inner_runs USING (lang, phrase)
  WHERE longer_a IS NULL OR 100::HUGEINT * longer_a < 80::HUGEINT * a)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

IMPORTANCE_RESAMPLING = r"""
WITH table256 AS (
  SELECT list(list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda s, x: CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384::UBIGINT) ELSE s >> 1 END) ORDER BY i) AS t
  FROM range(256) q(i)),
texts AS (
  SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, NULL, text FROM benchmark),
split AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts),
features AS (
  SELECT kind, id, array_to_string(w[i:i + m - 1], ' ') AS f, count(*) AS n
  FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM split, (SELECT unnest([1, 2, 3]) AS m) WHERE len(w) >= m)
  GROUP BY ALL),
coded AS (
  SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM features)),
summed AS (
  SELECT f, xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(range(1, length(x), 2),
         lambda i: (16 * (instr('0123456789ABCDEF', x[i]) - 1) + instr('0123456789ABCDEF', x[i + 1]) - 1)::UBIGINT)),
         lambda s, b: xor(s >> 8, t[(xor(s, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT) % 10000 AS bucket
  FROM coded, table256),
counts AS (
  SELECT b AS bucket, coalesce(sum(n) FILTER (kind = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (kind = 1), 0)::DOUBLE AS t
  FROM range(10000) q(b) LEFT JOIN (SELECT bucket, kind, n FROM features JOIN summed USING (f)) ON bucket = b GROUP BY b),
sums AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM counts),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain FROM counts, sums),
weights AS (
  SELECT id, sum(n * gain) AS weight FROM features JOIN summed USING (f) JOIN gains USING (bucket) WHERE kind = 0 GROUP BY id),
drawn AS (
  SELECT id, len(w) AS n_words, list_sum([greatest(len(w) - k, 0) for k in [0, 1, 2]])::BIGINT AS n_features,
         ('0x' || substr(sha256('42:' || id), 1, 8))::BIGINT AS h
  FROM split WHERE kind = 0),
scored AS (
  SELECT id AS doc_id, n_words, n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM drawn LEFT JOIN weights USING (id)),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 5 * count(*) OVER () // 100 AS take FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= take THEN place END::BIGINT AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""
