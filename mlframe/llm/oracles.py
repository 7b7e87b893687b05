"""DuckDB SQL for the queries whose rows SQL can give, each by a plain way of its own."""

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# The test pages hold their text in one article of headings and paragraphs with five kinds of references.
OP5_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's') AS h FROM pages),
b AS (
  SELECT page_id, url, list_filter(list_transform(string_split_regex(h, '</?(?:p|h1)>'), lambda x:
    trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(replace(x, '<br>', ' '), '<[^>]+>', '', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks
  FROM a)
SELECT page_id, url, array_to_string(blocks, chr(10) || chr(10)) AS text, CAST(length(array_to_string(blocks, chr(10) || chr(10))) AS BIGINT) AS n_chars
FROM b
"""

# Exact Jaccard of every two different paragraphs that share a shingle, then the least label over the links.
OP6_SQL = r"""
WITH RECURSIVE lines AS (
  SELECT doc_id, unnest(range(0, len(l))) AS para, unnest(l) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
listed AS (
  SELECT doc_id, para, list_filter(string_split_regex(""" + _LOWER.format("line") + r""", '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM lines),
words AS (
  SELECT doc_id, para, i, w, row_number() OVER (PARTITION BY doc_id ORDER BY para, i) - 1 AS pos, count(*) OVER (PARTITION BY doc_id) AS n
  FROM (SELECT doc_id, para, unnest(w) AS w, unnest(range(0, len(w))) AS i FROM listed)),
bytes AS (SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM words)),
own AS (
  SELECT w, list_sum(list_transform(range(0, len(h) // 2), lambda k: (16 * (instr('0123456789ABCDEF', h[2 * k + 1]) - 1) + instr('0123456789ABCDEF', h[2 * k + 2]) - 1)
    * (7919 * (k + 1) * (k + 1) % 65521))) % 2147483647 AS v FROM bytes),
valued AS (
  SELECT doc_id, para, i, pos, n, w,
    CASE WHEN i = 0 THEN -1 ELSE (CASE WHEN right(lag(w) OVER d, 1) IN ('.', '!', '?', '。', '！', '？') THEN 1 ELSE 2 END) * 2147483648
      + (v * 48271 + coalesce(lead(v) OVER d, 0) * 16807) % 2147483647 END AS v
  FROM words JOIN own USING (w) WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
placed AS (
  SELECT *, i = 0 OR (pos + 5 < n AND v < min(v) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
    AND v <= min(v) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING)) AS cut FROM valued),
pieced AS (SELECT *, sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS piece FROM placed),
pieces AS (SELECT doc_id, para, min(pos) AS start, list(w ORDER BY pos) AS w, count(*) OVER (PARTITION BY doc_id, para) AS of FROM pieced GROUP BY doc_id, para, piece),
para AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start, len(w) DESC) - 1 AS INTEGER) AS unit, CAST(para AS INTEGER) AS para,
    CAST(start AS BIGINT) AS start, w, whole, array_to_string(w, ' ') AS k
  FROM (SELECT doc_id, para, start, w, of = 1 AS whole FROM pieces
        UNION ALL SELECT doc_id, para, min(pos), list(w ORDER BY pos), true FROM pieced GROUP BY doc_id, para HAVING max(piece) > min(piece))),
kinds AS (
  SELECT k, any_value(w) AS w, min((doc_id, unit, para, whole)) AS place, row_number() OVER (ORDER BY min((doc_id, unit, para, whole))) AS id FROM para GROUP BY k),
shingles AS (
  SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT id, w, unnest(range(1, len(w) - 3)) AS i FROM kinds WHERE len(w) >= 5)),
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
links AS (
  SELECT a.id AS a, b.id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.id < b.id
  JOIN sizes x ON x.id = a.id JOIN sizes y ON y.id = b.id
  GROUP BY a.id, b.id, x.n, y.n HAVING count(*) >= 0.8 * (x.n + y.n - count(*)) - 1e-9),
sym AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, other) AS (SELECT a, a FROM sym UNION SELECT reach.id, sym.b FROM reach JOIN sym ON reach.other = sym.a),
class AS (SELECT id, min(other) AS c FROM reach GROUP BY id),
head AS (SELECT kinds.k, first.place FROM kinds LEFT JOIN class USING (id) JOIN kinds first ON first.id = coalesce(class.c, kinds.id)),
judged AS (
  SELECT doc_id, unit, para, start, CAST(len(w) AS BIGINT) AS n_words, place[1] AS class_id, place[2] AS class_unit,
         (doc_id, unit) <> (place[1], place[2]) AND NOT (place[4] AND doc_id = place[1] AND para = place[3]) AS removed
  FROM para JOIN head USING (k))
SELECT *, CASE WHEN removed THEN n_words ELSE CAST(0 AS BIGINT) END AS n_removed FROM judged
"""

# Every 100-byte string by its hex text; the runs of repeated ones are cut out of the hex text.
OP7_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS s
      FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS p FROM d WHERE len(h) >= 200)),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS n FROM w) WHERE n > 1),
run AS (SELECT doc_id, p, sum(CASE WHEN p > before + 100 OR before IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS r
        FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM again)),
span AS (SELECT doc_id, r, min(p) AS a, max(p) + 100 AS b FROM run GROUP BY ALL),
gap AS (
  SELECT doc_id, coalesce(lag(b) OVER o, 0) AS a, a AS b FROM span WINDOW o AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL SELECT doc_id, max(b), 1000000000000 FROM span GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * least(b, 1000000000) - 2 * a), '' ORDER BY a) AS h FROM gap JOIN d USING (doc_id) GROUP BY doc_id),
total AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS n FROM span GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN total USING (doc_id)
"""

# Every window of every item against every run of as many words of every document.
OP9_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
places AS (
  SELECT item_id, w, least(len(w), 13) AS m, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS win FROM places),
sizes AS (SELECT DISTINCT m FROM win),
docwin AS (
  SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM doc, sizes WHERE len(w) >= m)),
found AS (SELECT r, docwin.m, i, item_id FROM docwin JOIN win ON docwin.m = win.m AND docwin.win = win.win),
hit AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT r, m, i FROM found)) GROUP BY r),
ids AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN ids USING (r)
"""

# The measurements by lists and joins instead of array functions.
OP10_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
tri AS (
  SELECT r, i, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM doc WHERE len(w) >= 3)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM tri) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 3)) AS p FROM rep) GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM doc LEFT JOIN cov USING (r)),
b AS (
  SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
         + CASE WHEN n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
         + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END AS bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       bits & 3 <> 0 AS base_failed, bits = 0 AS kept, CAST(bits AS BIGINT) AS failed_bits
FROM b
"""
