"""DuckDB SQL for the operators that SQL can express over whole tables."""

_OP1 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha256(coalesce(html, '')) AS digest,
         octet_length(encode(coalesce(html, ''))) AS n
  FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN f.first < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first < p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest AND p.n >= 100
"""

_WORDS = r"""regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"""

_OP3 = """
WITH RECURSIVE w AS (
  SELECT doc_id, """ + _WORDS.format(
    text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')") + """ AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_aggregate(words[i:i + 4], 'string_agg', ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * m >= 85 * (p.n + q.n - m)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x),
root AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, root.component_id,
       root.component_id = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN root ON root.x = d.doc_id
"""

_OP9 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT doc_id, i, md5_number(substring(h, 2 * i + 1, 400)) AS k
  FROM (SELECT doc_id, h, unnest(range(len(h) // 2 - 199)) AS i FROM d WHERE len(h) >= 400)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY k) AS c FROM w) WHERE c > 1),
o AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM r),
g AS (SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i > p + 200 THEN 1 ELSE 0 END)
        OVER (PARTITION BY doc_id ORDER BY i) AS run FROM o),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 200 AS b FROM g GROUP BY doc_id, run),
gaps AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS f FROM spans),
kept AS (
  SELECT doc_id, sum(b - a) AS removed, count(*) AS n,
         string_agg(substring(h, CAST(2 * f + 1 AS BIGINT), CAST(2 * (a - f) AS BIGINT)), '' ORDER BY a) AS k, max(b) AS last
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(k, '') || substring(h, CAST(2 * coalesce(last, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_OP10 = """
WITH d AS (SELECT doc_id, """ + _WORDS.format(text="coalesce(text, '')") + """ AS words FROM documents),
w AS (
  SELECT doc_id, i, list_aggregate(words[i:i + 19], 'string_agg', ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d WHERE len(words) >= 20)),
r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS c FROM w)
  WHERE c > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM r),
words AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM d),
kept AS (
  SELECT w.doc_id, count(g.p) AS removed, string_agg(CASE WHEN g.p IS NULL THEN word END, ' ' ORDER BY w.p) AS t
  FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.p = g.p GROUP BY w.doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

#: crc32 of a number's decimal digits; -1 stands for one of a byte's eight rounds.
_CRC = """xor(list_reduce(
  list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST({id} AS VARCHAR), ''),
    lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"""

_OP11 = """
WITH d AS (
  SELECT doc_id, """ + _WORDS.format(text="coalesce(text, '')") + """ AS words,
         """ + _CRC.format(id="doc_id") + """ AS h FROM documents),
e AS (SELECT *, len(words) AS n, h // 10 AS g,
             CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a FROM d),
f AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM e),
w AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN words ELSE list_transform(range(n),
           lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS words FROM f),
grams AS (
  SELECT doc_id, n, i, list_aggregate(words[i + 1:i + 5], 'string_agg', ' ') AS gram
  FROM (SELECT doc_id, n, words, unnest(range(n - 4)) AS i FROM w WHERE n >= 6)),
twice AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM grams) WHERE c > 1),
pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM twice x JOIN twice y
  ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
same AS (SELECT doc_id, min(i) AS start, count(*) + 4 + q AS length, q FROM islands GROUP BY doc_id, q, island),
runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM same WHERE length >= greatest(6, 4 * q)
  GROUP BY doc_id, start, length),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) AS place FROM runs),
best AS (
  SELECT doc_id, count(*) AS n_runs, min(start) FILTER (WHERE place = 1) AS start,
         min(length) FILTER (WHERE place = 1) AS length, min(period) FILTER (WHERE place = 1) AS period,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed
  FROM ranked GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS i FROM w),
kept AS (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.i) AS t FROM placed p
  LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i WHERE g.i IS NULL GROUP BY p.doc_id)
SELECT w.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start,
       CAST(length AS BIGINT) AS length, CAST(period AS BIGINT) AS period,
       CAST(1000 * length // period AS BIGINT) AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM w LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_OP12 = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS r,
         coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT conv_id, count(*) AS n, """ + _CRC.format(id="conv_id") + """ % 6 AS h FROM t GROUP BY conv_id),
path AS (
  SELECT conv_id, 0 AS d, '' AS role, '' AS text FROM c
  UNION ALL
  SELECT c.conv_id, t.r, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.r <= c.h
  UNION ALL
  SELECT c.conv_id, least(c.h, coalesce(b.n, 0)) + t.r - c.h, t.role, t.text
  FROM c JOIN t ON t.conv_id = c.conv_id AND t.r > c.h LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 100),
keyed AS (
  SELECT conv_id, d, text, max(d) OVER (PARTITION BY conv_id) AS m,
         sha256(string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY conv_id ORDER BY d)) AS k FROM path),
node AS (SELECT d, k, min(conv_id) AS rep, count(*) AS n, max(length(text)) AS chars FROM keyed GROUP BY d, k),
named AS (SELECT keyed.conv_id, d, rep, n, chars, m FROM keyed JOIN node USING (d, k)),
own AS (
  SELECT o.conv_id, o.d, o.n, o.chars, p.rep AS parent
  FROM named o LEFT JOIN named p ON p.conv_id = o.conv_id AND p.d = o.d - 1 WHERE o.rep = o.conv_id),
child AS (SELECT parent, d - 1 AS d, count(*) AS children FROM own WHERE d > 0 GROUP BY ALL),
valued AS (
  SELECT own.*, coalesce(children, 0) AS children, (n - 1) * chars AS saved
  FROM own LEFT JOIN child ON child.parent = own.conv_id AND child.d = own.d),
total AS (
  SELECT a.rep, a.d, count(*) FILTER (WHERE v.children = 0) AS leaves, sum(v.saved) AS saved
  FROM valued v JOIN named a ON a.conv_id = v.conv_id AND a.d <= v.d GROUP BY ALL),
ends AS (
  SELECT rep, d, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS sha
  FROM named WHERE d = m GROUP BY ALL)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, v.parent AS parent_conv_id, CAST(v.n AS BIGINT) AS n_convs,
       CAST(v.children AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
       CAST(t.saved AS BIGINT) AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256
FROM valued v JOIN total t ON t.rep = v.conv_id AND t.d = v.d LEFT JOIN ends e ON e.rep = v.conv_id AND e.d = v.d
"""

#: The links of op3 by four-word shingles.
_OP13 = _OP3.replace("i + 4]", "i + 3]").replace("len(words) - 4", "len(words) - 3").replace(
    "root.component_id,\n       root.component_id = d.doc_id AS kept", "root.component_id")

ORACLES = {"op1_warc": _OP1, "op3_minhash": _OP3, "op9_suffix_array": _OP9, "op10_substring": _OP10,
           "op11_periodic_runs": _OP11, "op12_prefix_trie": _OP12,
           "op13_ngram_join": _OP13}
