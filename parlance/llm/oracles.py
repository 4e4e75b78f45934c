"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

OP2 = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 WHEN 'system' THEN 17
            ELSE 16 + length(role) END AS frame,
         lag(role) OVER w IS NOT DISTINCT FROM role AND lag(turn) OVER w IS NOT NULL AS goes_on,
         length(text) + length(text) - length(replace(text, '\\', ''))
           + len(regexp_extract_all(text, '</?s>|<</?SYS>>|\\[/?INST\\]|\\[/?ROLE\\]|\\[SEP\\]')) AS escaped
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
agg AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
         sum(escaped + CASE WHEN goes_on THEN 7 ELSE frame END) AS formatted_chars
  FROM marked GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars
FROM agg
"""

_LOWER = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# windows of the items (13 words, or a shorter item whole) against every window of the
# documents of such a length
OP4 = f"""
WITH iw AS (
  SELECT DISTINCT item_id, regexp_extract_all({_LOWER.format(t='text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, w[p:p + least(13, len(w)) - 1] AS words
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM iw WHERE len(w) > 0)),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(coalesce({_LOWER.format(t='text')}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dw AS (
  SELECT r, n, p, w[p:p + n - 1] AS words
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hit AS (SELECT r, dw.n, p, item_id FROM dw JOIN windows USING (n, words)),
covered AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT r, n, p FROM hit))
  GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""

# all pairs that share a shingle, then the closure of the links
OP8 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(coalesce({_LOWER.format(t='text')}, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, words FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda p: w[p:p + 4])
                               WHEN len(w) > 0 THEN [w] ELSE [] END) AS words FROM d)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b USING (words) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sizes sx ON sx.doc_id = x JOIN sizes sy ON sy.doc_id = y
  WHERE 100 * o >= 80 * (sx.n + sy.n - o)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM d
  UNION SELECT e.y, r.root FROM reach r JOIN edges e ON e.x = r.doc_id WHERE r.root < e.y)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(root) AS component_id
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN reach ON reach.doc_id = d.doc_id
GROUP BY d.doc_id, n
"""

# crc32 of a text of ASCII characters, bit by bit
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len({t}) + 1), lambda i: ascii({t}[i])::BIGINT)),
  lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)),
    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)"""

# every prefix of every rebuilt conversation, grouped by its turns themselves
OP12 = f"""
WITH own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST,
                       md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
headed AS (SELECT *, {_CRC32.format(t='(conv_id::VARCHAR)')} % 6 AS h FROM own),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.p[1:o.h], []), o.p[o.h + 1:]) AS p
  FROM headed o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
prefixes AS (
  SELECT conv_id, len(p) AS n, d, p[1:d] AS k, CASE WHEN d > 0 THEN length(p[d].t) ELSE 0 END AS chars
  FROM (SELECT conv_id, p, unnest(range(0, len(p) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS saved,
         coalesce(string_agg(CASE WHEN n = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ends
  FROM prefixes GROUP BY k, d),
children AS (SELECT k[1:d - 1] AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
below AS (
  SELECT k[1:a] AS k, sum(leaf) AS n_leaves, sum(saved) AS saved
  FROM (SELECT nodes.k, saved, CASE WHEN c.n IS NULL THEN 1 ELSE 0 END AS leaf, unnest(range(0, d + 1)) AS a
        FROM nodes LEFT JOIN children c ON c.k = nodes.k)
  GROUP BY 1)
SELECT nodes.conv_id, d AS depth, up.conv_id AS parent_conv_id, n_convs, coalesce(children.n, 0) AS n_children,
       n_leaves::BIGINT AS n_leaves, below.saved::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM nodes LEFT JOIN children ON children.k = nodes.k JOIN below ON below.k = nodes.k
LEFT JOIN (SELECT k AS uk, d AS ud, conv_id FROM nodes) up ON d > 0 AND uk = nodes.k[1:d - 1]
"""

# periods whose multiples 0, q, 2q, ... hold one word three times in a row are looked at word by word:
# a run of four periods has three such places
OP13 = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         coalesce(doc_id::VARCHAR, '') AS name FROM documents),
g AS (SELECT r, n, h % 10 = 0 AND n > 0 AS planted, h // 10 AS g
      FROM (SELECT r, len(w) AS n, {_CRC32.format(t='name')} AS h FROM d)),
a AS (SELECT *, CASE WHEN planted THEN g % n ELSE 0 END AS a FROM g),
p AS MATERIALIZED (SELECT *, CASE WHEN planted THEN 1 + (n - a) // (3 + g % 8) ELSE 1 END AS p FROM a),
own AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM d),
word AS MATERIALIZED (
  SELECT t.r, t.i, x
  FROM (SELECT r, planted, a, p, unnest(range(0, n)) AS i FROM p) t
  JOIN own ON own.r = t.r AND own.i = CASE WHEN planted AND t.i >= a THEN a + (t.i - a) % p ELSE t.i END),
place AS (SELECT r, q, unnest(range(0, n - 2 * q, q)) AS i FROM (SELECT r, n, unnest(range(1, n // 4 + 1)) AS q FROM p)),
seen AS MATERIALIZED (
  SELECT DISTINCT place.r, q FROM place JOIN word u ON u.r = place.r AND u.i = place.i
  JOIN word v ON v.r = place.r AND v.i = place.i + q AND v.x = u.x JOIN word t ON t.r = place.r AND t.i = place.i + 2 * q AND t.x = u.x),
same AS (
  SELECT seen.r, q, u.i, u.i - row_number() OVER (PARTITION BY seen.r, q ORDER BY u.i) AS isle
  FROM seen JOIN word u ON u.r = seen.r JOIN word v ON v.r = seen.r AND v.i = u.i + q AND v.x = u.x),
run AS (
  SELECT r, start, length, min(q) AS period
  FROM (SELECT r, q, min(i) AS start, count(*) + q AS length FROM same GROUP BY r, q, isle)
  WHERE length >= greatest(6, 4 * q) GROUP BY r, start, length),
runs AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS told,
         list({{'l': -length, 's': start, 'p': period}} ORDER BY -length, start, period)[1] AS top
  FROM run GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM run),
kept AS (SELECT word.r, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone ON gone.r = word.r AND gone.i = word.i GROUP BY word.r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, top.s::BIGINT AS start, (-top.l)::BIGINT AS length, top.p::BIGINT AS period,
       (-1000 * top.l // top.p)::BIGINT AS exponent_milli, sha256(coalesce(told, '')) AS runs_sha256,
       sha256(coalesce(t, '')) AS collapsed_sha256
FROM d LEFT JOIN runs USING (r) LEFT JOIN kept USING (r)
"""

ORACLES: dict[str, str] = {"op2_chat_format": OP2, "op4_decontamination": OP4, "op8_jaccard_join": OP8,
                           "op12_prefix_trie": OP12, "op13_periodic_runs": OP13}
