"""DuckDB SQL that must give the rows of a query of this subpackage."""

SQL: dict[str, str] = {}

SQL["op13_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), holders AS (
  SELECT key, min(doc_id) AS holder FROM keyed WHERE length(key) >= 10 GROUP BY key
), told AS (
  SELECT k.doc_id, k.pos, k.line, h.holder IS NOT NULL AND k.doc_id > h.holder AS dropped
  FROM keyed k LEFT JOIN holders h ON k.key = h.key
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM told GROUP BY doc_id
"""

#: crc32 of an ASCII string, bit by bit: {text} is the string's expression.
CRC32 = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
    string_split({text}, ''), lambda c: list_transform(range(8), lambda b: CAST((ascii(c) >> b) & 1 AS BIGINT))))),
  lambda acc, bit: xor(acc >> 1, CASE WHEN (xor(acc, bit) & 1) = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"""

SQL["op12_prefix_trie"] = rf"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, {CRC32.format(text="CAST(conv_id AS VARCHAR)")} % 4 AS h, conv_id - conv_id % 20 AS base
  FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos < c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h
), seqs AS (
  SELECT c.conv_id, coalesce(list(md5(length(role) || ':' || role || text) ORDER BY part, pos) FILTER (WHERE role IS NOT NULL), []) AS s,
         coalesce(list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) ORDER BY part, pos) FILTER (WHERE role IS NOT NULL), []) AS w
  FROM convs c LEFT JOIN rebuilt r ON c.conv_id = r.conv_id GROUP BY c.conv_id
), paths AS (
  SELECT conv_id, s, w, unnest(range(len(s) + 1)) AS depth FROM seqs
), nodes AS (
  SELECT s[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(any_value(w[depth]) FILTER (WHERE depth > 0), 0) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(s) = depth), '')) AS ends_sha256
  FROM paths GROUP BY s[1:depth], depth
), kids AS (
  SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), told AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON n.path = k.path
), up AS (
  SELECT path[1:d] AS path, (n_convs - 1) * words AS saved, CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM told)
), sums AS (
  SELECT path, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM up GROUP BY path
)
SELECT t.conv_id, t.depth, p.conv_id AS parent_conv_id, t.n_convs, t.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, t.ends_sha256
FROM told t JOIN sums s ON t.path = s.path LEFT JOIN told p ON t.depth > 0 AND p.path = t.path[1:t.depth - 1]
"""

#: Extra characters that escaping the control strings inside {text} adds: one for each. Those that begin
#: with << hold a second one, so they are counted apart.
_ESCAPES = r"""(len(regexp_extract_all({text}, '[<\[]\\*(\||/?s>|/?INST\]|/?SYS>>)'))
       + len(regexp_extract_all({text}, '[<\[]\\*</?SYS>')))"""

SQL["op3_reply_trees"] = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
), told AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10))
             + {_ESCAPES.format(text="role")}
             + {_ESCAPES.format(text="text")}) AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM told
"""

SQL["op4_rule_ledger"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), split AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM texts
), windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM split)
), twice AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(3)) AS k) GROUP BY r
), m AS (
  SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         len(l) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         length(t) - length(regexp_replace(t, '\p{Lu}+', '', 'g')) AS n_upper,
         length(t) - length(replace(t, '!', '')) AS n_shouts
  FROM split s LEFT JOIN covered c ON s.r = c.r
), ledger AS (
  SELECT *, CAST(CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 4 * n_symbols > n_words THEN 4 ELSE 0 END
    + CASE WHEN n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 25 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 2 * n_upper > word_chars THEN 32 ELSE 0 END
    + CASE WHEN 4 * n_shouts > n_words THEN 64 ELSE 0 END AS BIGINT) AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM ledger
"""

SQL["op5_tensor_minhash"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), sized AS MATERIALIZED (
  SELECT s.doc_id, s.s, z.n FROM shingles s JOIN sizes z USING (doc_id)
), links AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM sized x JOIN sized y ON x.s = y.s AND x.doc_id < y.doc_id
   AND 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
  GROUP BY x.doc_id, y.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), both_ways AS MATERIALIZED (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT a AS doc_id, b AS other FROM both_ways
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON r.other = e.a
), least_of AS (
  SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id
)
SELECT w.doc_id, coalesce(z.n, 0) AS n_shingles, least(w.doc_id, coalesce(l.least, w.doc_id)) AS component_id,
       least(w.doc_id, coalesce(l.least, w.doc_id)) = w.doc_id AS kept
FROM words w LEFT JOIN sizes z ON w.doc_id = z.doc_id LEFT JOIN least_of l ON w.doc_id = l.doc_id
"""
