"""DuckDB SQL for the results of the operators, where a few statements can say them."""

# crc32 by its rule, a byte at a time.
_CRC = r"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(0, 256))::BIGINT AS i))),
"""

# A letter is one byte, or U+00C3's lead byte and one more.
SPELLING_SQL = _CRC + r"""
runs AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  GROUP BY ALL),
hashed AS (
  SELECT run, k, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END))),
    lambda c, x: xor(t[1 + (xor(c, x) & 255)], c >> 8))) AS h
  FROM runs, crc),
words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run) + 2)::INT)
                ELSE run END AS word, k FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
places AS (SELECT word, n, unnest(range(0, length(word)))::INT AS i FROM words),
cuts AS (SELECT word, n, i, left(word, i) AS head, substr(word, i + 2) AS tail FROM places),
pairs AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS m FROM cuts a JOIN cuts b
    ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT c.word, c.n, w.word, w.n FROM cuts c JOIN words w ON w.word = c.head || c.tail
  UNION SELECT w.word, w.n, c.word, c.n FROM cuts c JOIN words w ON w.word = c.head || c.tail),
best AS (
  SELECT word, any_value(n) AS n, count(*) AS n_near, min(struct_pack(m := -m, other := other)) AS b
  FROM pairs GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near,
         CASE WHEN -b.b.m >= 5 * w.n THEN b.b.other END AS form,
         CASE WHEN -b.b.m >= 5 * w.n THEN -b.b.m END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
chain AS (
  SELECT word, word AS at FROM formed
  UNION SELECT c.word, f.form FROM chain c JOIN formed f ON c.at = f.word WHERE f.form IS NOT NULL),
roots AS (
  SELECT c.word, c.at AS root FROM chain c JOIN formed f ON c.at = f.word WHERE f.form IS NULL)
SELECT f.word, f.form, r.root, f.n::BIGINT AS n, f.n_near, f.form_n::BIGINT AS form_n
FROM formed f JOIN roots r ON f.word = r.word
"""

# All edits of all turns, one best way per state of the role grammar after each turn.
REPAIR_SQL = _CRC + r"""
hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
           string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
           lambda c: unicode(c)::BIGINT)), lambda c, x: xor(t[1 + (xor(c, x) & 255)], c >> 8))) % 20 AS code
  FROM conversations, crc),
turns AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN code = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE code <> 0),
placed AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS r,
         row_number() OVER (PARTITION BY conv_id ORDER BY o, turn, h, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY o, turn, copy) AS nth
  FROM (SELECT *, turn IS NOT NULL AS o, sha256(length(role)::VARCHAR || ':' || role || text) AS h FROM turns)),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
         lag(r) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal,
         count(*) AS n
  FROM faults GROUP BY conv_id),
-- states of the role grammar: 0 nothing, 1 after system, 2 after user, 3 after whole pairs
inserts(a, b, k, added) AS (
  VALUES (0, 0, 0, []::VARCHAR[]), (1, 1, 0, []), (2, 2, 0, []), (3, 3, 0, []),
         (0, 2, 1, ['user:']), (1, 2, 1, ['user:']), (3, 2, 1, ['user:']), (2, 3, 1, ['assistant:']),
         (0, 3, 2, ['user:', 'assistant:']), (1, 3, 2, ['user:', 'assistant:'])),
moves(b, role, r, c) AS (VALUES (0, 'system', 's', 1), (0, 'user', 'u', 2), (1, 'user', 'u', 2),
                                (2, 'assistant', 'a', 3), (3, 'user', 'u', 2)),
edits AS (
  SELECT a, c, k, added, r, role, e FROM inserts JOIN moves USING (b), (VALUES ('K'), ('R')) AS v(e)
  WHERE e = 'K' OR r <> 's'
  UNION ALL SELECT a, a, 0, [], NULL, NULL, 'D' FROM (VALUES (0), (1), (2), (3)) AS s(a)),
ways AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS st, {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]} AS w FROM facts
  UNION ALL
  SELECT w.conv_id, w.i + 1, e.c, min({
           'cost': w.w.cost + 3 * e.k + CASE e.e WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
                   + CASE WHEN e.e <> 'D' AND f.fault = 'truncated' THEN 3 ELSE 0 END,
           'audit': w.w.audit || repeat('I', e.k) || e.e,
           'lines': w.w.lines || e.added || CASE e.e WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text]
                                                     ELSE [e.role || ':' || f.text] END})
  FROM ways w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
       JOIN edits e ON e.a = w.st AND (e.e <> 'K' OR e.r = f.r)
                   AND (e.e = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
  GROUP BY w.conv_id, w.i + 1, e.c),
ends AS (
  SELECT w.conv_id, min({'cost': w.w.cost + 3 * n.k, 'audit': w.w.audit || repeat('I', n.k),
                         'lines': w.w.lines || n.added}) AS b
  FROM ways w JOIN facts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i
       JOIN inserts n ON n.a = w.st AND n.b IN (0, 3)
  GROUP BY w.conv_id)
SELECT a.conv_id, coalesce(f.gaps, 0) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate,
       coalesce(f.truncated, 0) AS truncated, coalesce(f.illegal, 0) AS illegal, coalesce(e.b.cost, 0) AS cost,
       coalesce(e.b.audit, '') AS audit, sha256(coalesce(array_to_string(e.b.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
     LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM a.conv_id
     LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM a.conv_id
"""

NGRAM_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
placed AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM worded WHERE len(w) >= 5),
runs AS (
  SELECT doc_id, x || ' ' || lead(x, 1) OVER d || ' ' || lead(x, 2) OVER d || ' ' || lead(x, 3) OVER d || ' '
                 || lead(x, 4) OVER d AS x
  FROM placed WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
shingles AS (
  SELECT DISTINCT doc_id, x FROM runs WHERE x IS NOT NULL
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM worded WHERE len(w) BETWEEN 1 AND 4),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT x FROM shingles GROUP BY x HAVING count(*) > 1),
common AS (SELECT s.doc_id, s.x FROM shingles s JOIN shared USING (x)),
links AS (
  SELECT a, b FROM (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM common a JOIN common b
                    ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * k >= 75 * (p.n + q.n - k)),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT l.b, r.other FROM reach r JOIN links l ON l.a = r.doc_id)
SELECT r.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM reach r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""

EMBEDDING_SQL = r"""
WITH RECURSIVE sound AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT l.b, r.other FROM reach r JOIN links l ON l.a = r.vec_id),
roots AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT r.vec_id, coalesce(c.n_links, 0)::BIGINT AS n_links, r.component_id, r.vec_id = r.component_id AS kept
FROM roots r LEFT JOIN counts c ON c.vec_id = r.vec_id
"""
