"""DuckDB SQL for the queries that SQL can express."""

SQL = {}

SQL["op1_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept, sha256(norm) AS text_sha256
FROM t WINDOW g AS (PARTITION BY norm)
"""

SQL["op2_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
r AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS least FROM p)
SELECT page_id, n AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> least THEN least END AS refers_to
FROM r
"""

SQL["op4_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
o AS (SELECT *, md5(concat_ws(':', 'mix-1', coalesce(CAST(doc_id AS VARCHAR), ''), CAST(size AS VARCHAR))) AS ord FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM s),
r AS (  -- the more often a source must repeat for its share, the earlier it is clamped
  SELECT *, row_number() OVER (ORDER BY source_size * 3.0 / weight, source) AS k FROM w),
p AS (SELECT *, coalesce(sum(source_size * 3) OVER e, 0) AS used, sum(weight) OVER f AS free FROM r
  WINDOW e AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         f AS (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
q AS (SELECT *, CAST((SELECT sum(source_size) FROM s) - used AS DOUBLE) / CAST(free AS DOUBLE) AS lvl FROM p),
lv AS (SELECT coalesce(min(k) FILTER (WHERE source_size * 3 > lvl * weight), 1000000000) AS k0 FROM q),
t AS (SELECT source, source_size,
        CASE WHEN k < (SELECT k0 FROM lv) THEN CAST(source_size * 3 AS DOUBLE)
             ELSE (SELECT lvl FROM q WHERE k = (SELECT k0 FROM lv)) * weight END AS target FROM q),
e AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS epochs FROM t),
u AS (SELECT source, ord, sum(size) AS unit FROM o GROUP BY source, ord),
b AS (SELECT *, sum(unit) OVER (PARTITION BY source ORDER BY ord) - unit AS before FROM u)
SELECT o.doc_id, o.size, e.source_size, e.target,
  CAST(o.size * (floor(e.epochs) + CASE WHEN e.epochs > floor(e.epochs)
    AND b.before + b.unit / 2.0 <= (e.epochs - floor(e.epochs)) * e.source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM o JOIN e ON o.source IS NOT DISTINCT FROM e.source
  JOIN b ON b.source IS NOT DISTINCT FROM o.source AND b.ord = o.ord
"""

SQL["op7_chat"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
a AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nth FROM c),
t AS (SELECT *, nth = 1 AND role = 'system' AS sys,
    12 + length(url_encode(role)) + 1 + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 11 AS chars,
    CASE WHEN nth = 1 AND role = 'system' THEN 0
         ELSE 4 + len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]')) END AS n FROM a),
b AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY nth) - n AS before FROM t),
x AS (SELECT *, floor(before / 768.0) AS cell,
    n > 0 AND floor((before + n - 1) / 768.0) > floor(before / 768.0) AS crosses FROM b),
y AS (SELECT *, coalesce(NOT (lag(cell) OVER w = cell AND lag(crosses) OVER w = crosses) AND NOT lag(sys) OVER w, nth = 1) AS opens
  FROM x WINDOW w AS (PARTITION BY conv_id ORDER BY nth)),
z AS (SELECT *, sum(CAST(opens AS INT)) OVER (PARTITION BY conv_id ORDER BY nth) - 1 AS win,
    coalesce(sum(CASE WHEN sys THEN 0 ELSE chars END)
      OVER (PARTITION BY conv_id ORDER BY before RANGE BETWEEN 256 PRECEDING AND 1 PRECEDING), 0) AS held,
    coalesce(max(CASE WHEN sys THEN chars END) OVER (PARTITION BY conv_id), 0) AS sys_chars FROM y)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) + coalesce(sum(held + sys_chars) FILTER (WHERE opens AND win > 0), 0) AS BIGINT) AS formatted_chars
FROM z GROUP BY conv_id
"""

SQL["op9_decontaminate"] = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
  FROM iw, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM win),
dg AS (
  SELECT doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') AS g
  FROM dw, ks, unnest(range(1, len(w) - k + 2)) AS r(i) WHERE len(w) >= k),
hit AS (SELECT DISTINCT doc_id, i, k, item_id FROM dg JOIN win USING (k, g)),
pos AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM (SELECT doc_id, i, unnest(range(0, k)) AS o FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(pos.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
  sha256(coalesce(its.ids, '')) AS items_sha256, coalesce(pos.n, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos ON pos.doc_id = dw.doc_id LEFT JOIN its ON its.doc_id = dw.doc_id
"""


def _codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Whole-number k-means of each part position, all distances written out."""
    steps = [f"""
k AS MATERIALIZED (SELECT vec_id, label, embedding, len(embedding) // {parts} AS w, row_number() OVER (ORDER BY vec_id) AS nth FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT vec_id, label, nth, (i - 1) // w AS p, (i - 1) % w AS j, CAST(floor(1024 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM k, unnest(range(1, {parts} * w + 1)) AS r(i)),
c0 AS MATERIALIZED (SELECT p, nth - 1 AS e, j, x FROM v WHERE nth <= {entries})"""]
    near = """
a{i} AS MATERIALIZED (SELECT vec_id, label, p, arg_min(e, d * 256 + e) AS e, min(d) AS d FROM (
  SELECT vec_id, label, p, e, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS d FROM v JOIN c{i} AS c USING (p, j) GROUP BY ALL) GROUP BY ALL)"""
    for i in range(rounds):
        steps += [near.format(i=i), f"""
m{i} AS (SELECT p, e, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM v JOIN a{i} USING (vec_id, p) GROUP BY ALL),
c{i + 1} AS MATERIALIZED (SELECT p, e, j, coalesce((s - (s % n + n) % n) // n, x) AS x FROM c{i} LEFT JOIN m{i} USING (p, e, j))"""]
    steps.append(near.format(i=rounds))
    return f"""WITH {",".join(steps)},
f AS (SELECT vec_id, label, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY ALL)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, j)) FROM c{rounds}) AS codebooks_sha256
FROM f
"""


SQL["op11_vector_codes"] = _codes()

# DuckDB has no CRC-32: it is worked out byte by byte, from the table of its 256 steps.
SQL["op13_spelling"] = r"""
WITH steps AS (SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
  FROM (SELECT CAST(unnest(range(0, 256)) AS BIGINT) AS i)),
runs AS (SELECT id, run, count(*) AS n FROM (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents) WHERE length(run) >= 7 GROUP BY ALL),
coded AS (SELECT run, n, list_transform(flatten(list_transform(string_split(id || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)]
  ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)), lambda b: CAST(b AS BIGINT)) AS bytes FROM runs),
crc AS (SELECT run, n, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h FROM coded, steps),
made AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, n FROM crc),
w AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM made WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
d AS MATERIALIZED (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS cut FROM w, unnest(range(1, length(word) + 1)) AS r(i)),
pairs AS (
  SELECT DISTINCT d.word, d.n, w.word AS near, w.n AS near_n FROM d JOIN w ON d.cut = w.word
  UNION ALL SELECT DISTINCT w.word, w.n, d.word, d.n FROM d JOIN w ON d.cut = w.word
  UNION ALL SELECT a.word, a.n, b.word, b.n FROM d a JOIN d b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word),
best AS MATERIALIZED (SELECT word, count(*) AS n_near, max(n) AS n, max(near_n) AS most FROM pairs GROUP BY word),
form AS MATERIALIZED (SELECT best.word, min(near) AS form, max(most) AS form_n FROM best JOIN pairs ON best.word = pairs.word AND near_n = most
  WHERE most >= 10 * best.n GROUP BY best.word),
walk AS (SELECT word, form AS here, 1 AS far FROM form UNION ALL SELECT walk.word, form.form, far + 1 FROM walk JOIN form ON walk.here = form.word),
ends AS (SELECT word, arg_max(here, far) AS root FROM walk GROUP BY word)
SELECT w.word, form.form, coalesce(ends.root, w.word) AS root, w.n, coalesce(best.n_near, 0) AS n_near, form.form_n
FROM w LEFT JOIN best USING (word) LEFT JOIN form USING (word) LEFT JOIN ends USING (word)
""".replace("WITH steps", "WITH RECURSIVE steps", 1)

SQL["op12_jaccard_join"] = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS MATERIALIZED (SELECT DISTINCT r, hash(s) AS s FROM (SELECT r, unnest(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM g GROUP BY r),
-- Linked sets share one of the first n-grams of each, in any one order of all.
p AS MATERIALIZED (SELECT r, n, s FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY s) AS i FROM g JOIN n USING (r)) WHERE i <= n - (90 * n + 99) // 100 + 1),
c AS MATERIALIZED (SELECT DISTINCT a.r AS u, b.r AS v, a.n AS nu, b.n AS nv FROM p a JOIN p b ON a.s = b.s AND a.r < b.r
  AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)),
o AS (SELECT u, v, nu, nv, count(*) AS same FROM c JOIN g x ON x.r = u JOIN g y ON y.r = v AND y.s = x.s GROUP BY ALL),
l AS MATERIALIZED (SELECT u, v FROM o WHERE 100 * same >= 90 * (nu + nv - same)),
e AS MATERIALIZED (SELECT u, v FROM l UNION SELECT v, u FROM l),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, e.v FROM reach JOIN e ON reach.b = e.u),
t AS (SELECT a AS r, min(doc_id) AS component_id FROM reach JOIN d ON d.r = reach.b GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, t.component_id FROM d LEFT JOIN n USING (r) JOIN t USING (r)
"""
