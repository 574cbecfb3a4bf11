"""DuckDB SQL for the operators that SQL can express."""

WS = r"[\x20\x09-\x0D]"

EXACT = rf"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS c,
                  sha256(regexp_replace(coalesce(text, ''), '{WS}', '', 'g')) AS h FROM documents),
k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY h ORDER BY c DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY h) AS n FROM d)
SELECT doc_id, keep_id, n AS group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM k
"""

QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{WS}+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '{WS}', '', 'g') <> '') AS ls,
             len(string_split(t, chr(10))) AS n_lines FROM d),
g AS (SELECT doc_id, i, list_slice(ws, i, i + 4) AS win
      FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM w WHERE len(ws) >= 5)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM g) WHERE n > 1),
p AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, (SELECT unnest(generate_series(0, 4)) AS k)
      GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words,
             length(regexp_replace(t, '{WS}', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (length(t) - length(regexp_replace(t, '[0-9]', '', 'g')))::BIGINT AS n_digits,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, n_lines::BIGINT AS n_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN p ON w.doc_id = p.doc_id),
f AS (SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END
                 + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
                 + CASE WHEN n_symbols > n_words THEN 4 ELSE 0 END
                 + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
                 + CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)
                        THEN 16 ELSE 0 END
                 + CASE WHEN 10 * n_digits > 3 * word_chars THEN 32 ELSE 0 END)::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed FROM f
"""

LINES = rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(generate_series(1, len(ls))) AS i FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^{WS}+|{WS}+$', '', 'g'),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
m AS (SELECT *, CASE WHEN length(key) >= 10 THEN min(doc_id) OVER (PARTITION BY key) END AS first FROM k)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE first <> doc_id))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE first IS NULL OR first = doc_id), ''))
         AS kept_sha256
FROM m GROUP BY doc_id
"""

SUBSTRINGS = rf"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{WS}+'), lambda x: x <> '') AS ws
           FROM documents),
g AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') AS win
      FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 12)) AS i FROM w WHERE len(ws) >= 13)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS f FROM g) WHERE f < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM r, (SELECT unnest(generate_series(0, 12)) AS k)),
o AS (SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS i FROM w),
k AS (SELECT o.doc_id, count(*) FILTER (WHERE gone.i IS NOT NULL) AS n_removed,
             string_agg(word, ' ' ORDER BY o.i) FILTER (WHERE gone.i IS NULL) AS kept
      FROM o LEFT JOIN gone ON o.doc_id = gone.doc_id AND o.i = gone.i GROUP BY o.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id
"""

JACCARD = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WS}+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (
  SELECT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM w WHERE len(ws) >= 5)
  UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 4)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id
      GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
      WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
b AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, b.y FROM r JOIN b ON r.y = b.x)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r.y) AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id JOIN r ON r.x = w.doc_id GROUP BY w.doc_id, n.n
"""

SUFFIXES = """
WITH d AS (SELECT doc_id, coalesce(hex(encode(text)), '') AS x FROM documents),
s AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, 400)) AS h
      FROM (SELECT doc_id, x, unnest(generate_series(0, length(x) // 2 - 200)) AS i FROM d WHERE length(x) >= 400)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n FROM s) WHERE n > 1),
b AS (SELECT *, CASE WHEN i <= max(i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING
                                             AND 1 PRECEDING) + 200 THEN 0 ELSE 1 END AS fresh FROM r),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM b),
p AS (SELECT doc_id, k, min(i) AS a, max(i) + 200 AS e FROM g GROUP BY doc_id, k),
q AS (SELECT doc_id, a, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM p),
k AS (SELECT d.doc_id, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a)
             || substr(any_value(x), 2 * max(e) + 1) AS kept, sum(e - a) AS n_removed, count(*) AS n_spans
      FROM d JOIN q ON d.doc_id = q.doc_id GROUP BY d.doc_id)
SELECT d.doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

#: Operator 13: CRC-32 by its byte table, prefixes as strings of digests.
TRIE = """
WITH RECURSIVE
bits(b, c, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT b, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
byte_table AS (SELECT b, c FROM bits WHERE k = 8),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id),
fold(conv_id, s, i, c) AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM sizes
  UNION ALL
  SELECT f.conv_id, f.s, f.i + 1, xor(f.c // 256, t.c)
  FROM fold f JOIN byte_table t ON t.b = xor(f.c % 256, CAST(ascii(substr(f.s, f.i + 1, 1)) AS BIGINT))
  WHERE f.i < length(f.s)),
heads AS (
  SELECT f.conv_id, f.conv_id - f.conv_id % 5 AS donor, xor(f.c, CAST(4294967295 AS BIGINT)) % 9 AS h
  FROM fold f WHERE f.i = length(f.s)),
plan AS (
  SELECT a.conv_id, a.donor, a.h, least(a.h, coalesce(s.n, 0)) AS m FROM heads a LEFT JOIN sizes s ON s.conv_id = a.donor),
rebuilt AS (
  SELECT p.conv_id, t.place, t.role, t.text FROM plan p JOIN turns t ON t.conv_id = p.donor AND t.place < p.h
  UNION ALL
  SELECT p.conv_id, t.place - p.h + p.m, t.role, t.text FROM plan p JOIN turns t ON t.conv_id = p.conv_id AND t.place >= p.h),
lengths AS (
  SELECT p.conv_id, count(r.conv_id) AS n FROM plan p LEFT JOIN rebuilt r ON r.conv_id = p.conv_id GROUP BY p.conv_id),
paths AS (
  SELECT conv_id, place + 1 AS depth, strlen(text) AS b,
    string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY conv_id ORDER BY place) AS prefix
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM plan),
nodes AS (
  SELECT p.prefix, p.depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, max(p.b) AS b,
    coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (WHERE p.depth = l.n), '') AS ends
  FROM paths p JOIN lengths l ON l.conv_id = p.conv_id GROUP BY p.prefix, p.depth),
children AS (SELECT left(prefix, 128 * (depth - 1)) AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
below AS (
  SELECT left(x.prefix, 128 * u.d) AS prefix, sum((x.n_convs - 1) * x.b) AS saved,
    sum(CASE WHEN c.n IS NULL THEN 1 ELSE 0 END) AS leaves
  FROM nodes x LEFT JOIN children c ON c.prefix = x.prefix, unnest(range(0, x.depth + 1)) AS u(d)
  GROUP BY 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, n.n_convs,
  coalesce(c.n, 0) AS n_children, CAST(w.leaves AS BIGINT) AS n_leaves, CAST(w.saved AS BIGINT) AS saved_tokens,
  sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below w ON w.prefix = n.prefix LEFT JOIN children c ON c.prefix = n.prefix
LEFT JOIN nodes q ON n.depth > 0 AND q.prefix = left(n.prefix, 128 * (n.depth - 1))
"""
