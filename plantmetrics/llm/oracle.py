"""DuckDB SQL for the operators that SQL can express."""

_SPACE = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"

_LINE_DEDUP = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i, ls[i] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
k AS (SELECT *, {_FOLD.format(f'trim(line, {_SPACE})')} AS key FROM l),
f AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.*, coalesce(k.doc_id > f.first_doc, false) AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_QUALITY = f"""
WITH d AS (SELECT doc_id, coalesce(source, chr(0)) AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '{_WORD}') AS ws, text FROM d),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i + 7], ' ')) AS c FROM p),
r AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (
  SELECT doc_id, unnest(range(i, i + 8)) AS j FROM g WHERE c > 1) GROUP BY doc_id),
l AS (SELECT doc_id, host, i, ls[i] AS line FROM (
  SELECT doc_id, host, ls, unnest(range(1, len(ls) + 1)) AS i FROM (
    SELECT doc_id, host, string_split(text, chr(10)) AS ls FROM d))),
n AS (SELECT *, regexp_extract_all({_FOLD.format('line')}, '{_WORD}') AS key,
  row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS nth FROM l WHERE regexp_matches(line, '{_WORD}')),
u AS (SELECT doc_id, count(*) FILTER (nth > 1) AS n_dup_lines FROM n GROUP BY doc_id),
hosts AS (SELECT host, count(DISTINCT doc_id) AS host_docs FROM d GROUP BY host),
often AS (SELECT host, key, count(DISTINCT doc_id) AS docs, min(doc_id) AS first_doc FROM n GROUP BY host, key),
gone AS (SELECT n.doc_id, sum(len(n.key)) AS gone_words FROM n JOIN often o ON n.host = o.host AND n.key = o.key
  JOIN hosts h ON h.host = n.host
  WHERE o.docs > 10 AND o.docs > 0.01 * h.host_docs AND n.doc_id > o.first_doc GROUP BY n.doc_id),
b AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
  CAST(len(ws) - coalesce(gone_words, 0) AS BIGINT) AS n_left_words
  FROM w LEFT JOIN u ON w.doc_id = u.doc_id LEFT JOIN r ON w.doc_id = r.doc_id LEFT JOIN gone ON w.doc_id = gone.doc_id),
v AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_left_words >= 20 AND n_left_words >= 0.3 * n_words AS kept, n_left_words
FROM v
"""

_CHAT = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS x(i, r)),
o AS (SELECT *, row_number() OVER w AS k, coalesce(lag(role) OVER w != role, true) AS opens FROM c
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
e AS (SELECT *, length(replace(replace(text, '\', '\\'), '<|', '<\|')) + CASE WHEN opens
  THEN length('<|im_start|>' || role || chr(10)) + length('<|im_end|>' || chr(10)) ELSE length('<|im_sep|>') END AS chars FROM o)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

_AUDIT = f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{_WORD}') AS ws, min(doc_id) OVER (PARTITION BY text) AS least FROM d),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, CAST(len(ws) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(ws)) < 50 * len(ws) AS INT)
  + 4 * CAST(100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text) AS INT)
  + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(w.doc_id > least, false) AS INT) AS mask,
  coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
x AS (SELECT * FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS v(ch)),
o AS (SELECT a.ch || b.ch || c.ch || d.ch || e.ch AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.ch, b.ch, c.ch, d.ch, e.ch])) = 5),
s AS (SELECT filter_order, CAST(step AS INT) AS step, 1 << (instr('ABCDE', filter_order[step]) - 1) AS bit,
  list_sum([0] || [1 << (instr('ABCDE', filter_order[j]) - 1) FOR j IN range(1, step)]) AS early
  FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM o)),
m AS (SELECT s.*, c.*, mask & bit != 0 AS fails, mask & CAST(early AS BIGINT) != 0 AS gone FROM s, c)
SELECT part, filter_order, step, CAST(coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS BIGINT) AS kept,
  CAST(coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS BIGINT) AS removed,
  CAST(coalesce(sum(n) FILTER (fails AND gone), 0) AS BIGINT) AS redundant,
  CAST(coalesce(sum(n) FILTER (mask = bit), 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(sum(good) FILTER (fails AND NOT gone), 0) AS BIGINT) AS good_lost,
  CAST(coalesce(sum(toxic) FILTER (fails AND NOT gone), 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(n * 120 // greatest(bit_count(mask), 1)) FILTER (fails), 0) AS BIGINT) AS shapley
FROM m GROUP BY part, filter_order, step
"""

_HARD = """
WITH u AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
p AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
  CAST(list_dot_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) AS BIGINT) AS score
  FROM u a JOIN u b ON a.vec_id % 100 = 0 AND a.vec_id != b.vec_id),
pos AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM p WHERE same) WHERE k <= 5),
n AS (SELECT pos.anchor_id, pos.id AS positive_id, pos.score AS positive_score, p.id AS negative_id, p.score AS negative_score,
  CAST(row_number() OVER (PARTITION BY pos.anchor_id, pos.id ORDER BY p.score DESC, p.id) AS INT) AS rank
  FROM pos JOIN p ON p.anchor_id = pos.anchor_id AND NOT p.same
    AND 30 * pos.score <= 100 * p.score AND 100 * p.score <= 90 * pos.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

_NEAR = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '{_WORD}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, hash(g) AS g FROM (SELECT doc_id, CASE WHEN len(ws) < 4 THEN ws ELSE ws[i:i + 3] END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY x, y),
e AS (SELECT x, y FROM i JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * shared >= 80 * (a.n + b.n - shared)),
l AS MATERIALIZED (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.y, r.root FROM r JOIN l ON l.x = r.doc_id),
c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN n ON n.doc_id = d.doc_id JOIN c ON c.doc_id = d.doc_id
"""

ORACLE_SQL: dict[str, str] = {"op12_minhash_dedup": _NEAR, "op11_hard_negatives": _HARD, "op13_filter_audit": _AUDIT, "op4_line_dedup": _LINE_DEDUP, "op5_quality_rules": _QUALITY, "op7_chat_format": _CHAT}
