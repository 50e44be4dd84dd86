"""DuckDB SQL of the queries that SQL can express; written from the contracts, not from the operators."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP6 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, list_slice(w, i, i + 12) AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
placed AS (
  SELECT doc_id, i, l, list_slice(w, i, i + l - 1) AS t
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i
        FROM d, (SELECT DISTINCT len(t) AS l FROM win) WHERE len(w) >= l)),
occ AS (SELECT doc_id, i, l, item_id FROM placed JOIN win USING (t)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM (SELECT DISTINCT doc_id, i, l FROM occ)) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP4 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS lo FROM win) WHERE doc_id > lo),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM later),
left_over AS (
  SELECT t.doc_id, count(*) AS n_kept, string_agg(t.word, ' ' ORDER BY t.p) AS kept
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) t
  LEFT JOIN gone g ON t.doc_id = g.doc_id AND t.p = g.p WHERE g.p IS NULL GROUP BY t.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (doc_id)
"""

OP10 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + 4) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS r FROM d UNION SELECT l.a, r.r FROM link l JOIN reach r ON r.a = l.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(reach.r) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id, n.n
"""

OP11 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
      lambda crc, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7],
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(crc, b)), 4294967295), 4294967295) AS h
  FROM documents),
a AS (SELECT doc_id, w, h, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
p AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
      CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END) ELSE w END AS w FROM a),
word AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM p),
gram AS (SELECT doc_id, n, i, list_slice(w, i + 1, i + 5) AS g FROM (SELECT doc_id, n, w, unnest(range(n - 4)) AS i FROM p WHERE n >= 6)),
pair AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM gram x JOIN gram y ON x.doc_id = y.doc_id AND x.g = y.g AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretch AS (
  SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length
  FROM (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pair) GROUP BY doc_id, q, island),
run AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretch WHERE length >= greatest(6, 4 * q) GROUP BY ALL),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines
  FROM run GROUP BY doc_id),
best AS (
  SELECT doc_id, start, length, period FROM run x WHERE NOT EXISTS (
    SELECT 1 FROM run y WHERE y.doc_id = x.doc_id AND (y.length * x.period > x.length * y.period
      OR y.length * x.period = x.length * y.period AND (y.start < x.start OR y.start = x.start AND y.period < x.period)))),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
kept AS (
  SELECT word.doc_id, string_agg(word, ' ' ORDER BY word.i) AS text
  FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.i = word.i WHERE gone.i IS NULL GROUP BY word.doc_id)
SELECT p.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.start AS BIGINT) AS start, CAST(best.length AS BIGINT) AS length,
  CAST(best.period AS BIGINT) AS period, CAST(1000 * best.length // best.period AS BIGINT) AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM p LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

TERM = r"[0-9a-z\x{80}-\x{10FFFF}]+"

OP12 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS w FROM documents),
b AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark),
corpus AS (SELECT count(*) AS n_docs, sum(len(w)) AS n_terms FROM d WHERE len(w) > 0),
wanted AS (SELECT DISTINCT term FROM b),
tf AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) SEMI JOIN wanted USING (term) GROUP BY ALL),
weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, corpus GROUP BY term, n_docs),
score AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + CAST((25 * n * n_docs) // n_terms AS BIGINT))))) AS BIGINT) AS score
  FROM b JOIN tf USING (term) JOIN weight USING (term), corpus GROUP BY item_id, doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM score WHERE score > 0)
WHERE rank <= 20
"""

OP13 = r"""
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM p)
WHERE rank <= 20
"""
