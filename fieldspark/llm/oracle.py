"""DuckDB SQL for the registered queries that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP8 = f"""
WITH lines AS (
  SELECT d.doc_id, d.pos, d.line, translate(regexp_replace(regexp_replace(d.line, '^[\\x20\\x09-\\x0D]+', ''), '[\\x20\\x09-\\x0D]+$', ''), '{UPPER}', '{LOWER}') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents) d
), shared AS (
  SELECT k, max(doc_id) AS keep_id FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT l.*, s.k IS NOT NULL AND l.doc_id <> s.keep_id AS gone FROM lines l LEFT JOIN shared s ON l.k = s.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP5 = f"""
WITH w AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents)
), g AS (
  SELECT doc_id, i, w, lag(w) OVER d AS v, lag(w, 2) OVER d AS u FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), c1 AS (SELECT w, count(*) AS c FROM g GROUP BY 1), c2 AS (SELECT v, w, count(*) AS c FROM g WHERE v IS NOT NULL GROUP BY ALL),
c3 AS (SELECT u, v, w, count(*) AS c FROM g WHERE u IS NOT NULL GROUP BY ALL), n AS (SELECT count(*) AS n FROM g
), s AS (
  SELECT g.doc_id, CASE WHEN c3.c >= 2 THEN ln(c3.c / x2.c) WHEN c2.c >= 2 THEN ln(c2.c / x1.c) + CASE WHEN g.u IS NULL THEN 0 ELSE ln(0.4) END
    ELSE ln(c1.c / n.n) + CASE WHEN g.v IS NULL THEN 0 ELSE ln(0.4) END + CASE WHEN g.u IS NULL THEN 0 ELSE ln(0.4) END END AS s
  FROM g JOIN c1 ON c1.w = g.w CROSS JOIN n LEFT JOIN c2 ON c2.v = g.v AND c2.w = g.w LEFT JOIN c3 ON c3.u = g.u AND c3.v = g.v AND c3.w = g.w
  LEFT JOIN c1 x1 ON x1.w = g.v LEFT JOIN c2 x2 ON x2.v = g.u AND x2.w = g.v
), t AS (SELECT doc_id, count(*) AS n_words, sum(s) AS s FROM s GROUP BY 1)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, round(coalesce(s, 0), 4) AS log_score, round(s / n_words, 6) AS mean_log_score FROM documents d LEFT JOIN t USING (doc_id)
"""

LEDGER = r"""
WITH labelled AS (
  SELECT l.toxic, unnest(list_distinct(list_filter(regexp_split_to_array(lower(d.text), '[^\p{L}]+'), lambda x: x <> ''))) AS w FROM labels l JOIN documents d USING (doc_id) WHERE l.toxic IS NOT NULL AND d.text IS NOT NULL
), lexicon AS (
  SELECT w FROM labelled GROUP BY w HAVING count(*) FILTER (WHERE toxic = 1) >= 4 AND count(*) FILTER (WHERE toxic = 1) >= 20 * count(*) FILTER (WHERE toxic <> 1)
), bad AS (
  SELECT doc_id, count(DISTINCT w) AS n FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}]+')) AS w FROM documents) JOIN lexicon USING (w) GROUP BY doc_id
), t AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 6)) AS p, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS win FROM t WHERE len(w) >= 8
), twins AS (SELECT doc_id, win FROM windows GROUP BY ALL HAVING count(*) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p + k) AS n FROM windows JOIN twins USING (doc_id, win), range(0, 8) AS r(k) GROUP BY doc_id
), m AS (
  SELECT t.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    CASE WHEN len(w) > 1 THEN len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) ELSE 0 END AS n_same,
    length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) AS n_capitals,
    coalesce(x.n, 0)::BIGINT AS n_toxic
  FROM t LEFT JOIN covered c ON c.doc_id = t.doc_id LEFT JOIN bad x ON x.doc_id = t.doc_id
), b AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END) + (CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END)
    + (CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END) + (CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN 100 * n_same > 20 * n_words THEN 32 ELSE 0 END) + (CASE WHEN 100 * n_capitals > 40 * word_chars THEN 64 ELSE 0 END) + (CASE WHEN n_toxic >= 2 AND 1000 * n_toxic >= n_words THEN 128 ELSE 0 END) AS fail_bits FROM m
)
"""

OP6 = LEDGER + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, n_toxic, fail_bits::BIGINT AS fail_bits,
  (CASE WHEN bit_count(fail_bits) = 1 THEN fail_bits ELSE 0 END)::BIGINT AS lone_bit FROM b
"""

ABLATIONS = LEDGER + """
, p AS (SELECT * FROM (VALUES ('base', 3), ('v1', 127), ('v2', 255)) v(policy, mask)), r AS (
  SELECT * FROM (VALUES ('few_words', 1), ('repeated_windows', 2), ('symbols', 4), ('duplicate_lines', 8), ('word_length', 16), ('repeated_words', 32), ('capitals', 64), ('toxic_words', 128)) v(rule, bit)
)
SELECT policy, rule, count(*) FILTER (WHERE (fail_bits & mask) <> 0) AS rejected, count(*) FILTER (WHERE (fail_bits & mask) = bit) AS only_rule
FROM p JOIN r ON (mask & bit) <> 0 LEFT JOIN b ON TRUE GROUP BY policy, rule
"""

OP9 = """
WITH both_tables AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), split_words AS (
  SELECT kind, id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{M}\\p{N}]+'), lambda x: x <> '') AS w FROM both_tables
), shingled AS (
  SELECT DISTINCT kind, id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM split_words
), sizes AS (SELECT id, count(*) AS n FROM shingled WHERE kind = 'b' GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, any_value(z.n) AS n_shingles, count(*) AS n_found, count(*) / any_value(z.n) AS containment
FROM shingled d JOIN shingled b ON d.kind = 'd' AND b.kind = 'b' AND d.s = b.s JOIN sizes z ON z.id = b.id
GROUP BY d.id, b.id HAVING count(*) / any_value(z.n) >= 0.8
"""

OP10 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(replace(replace(replace(replace(replace(text, '\', '\\'), '<|', '<\|'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'))
    + length(replace(replace(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]')) AS n FROM c
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(n + length('<|turn|>') + length('<|end|>') + 2)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

OP11 = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents) WINDOW same AS (PARTITION BY t)
"""

def crc32(text: str) -> str:
    """DuckDB expression of the unsigned CRC-32 of a text's UTF-8 bytes."""
    data = f"list_transform(range(1, 2 * strlen({text}), 2), lambda i: CAST('0x' || substr(hex(encode({text})), i, 2) AS BIGINT))"
    step = "list_reduce(list_concat([xor(acc, b)], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)"
    return f"xor(list_reduce(list_concat([4294967295], {data}), lambda acc, b: {step}), 4294967295)"


def leaf_sql(n_chars: str) -> str:
    parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(parts)})"


def path_sql(name: str, base: str, nodes: str) -> str:
    """Recursive table: each row of ``base`` (doc_id, grp, n, idx, acc, proof) folded up through ``nodes`` to its top."""
    return f"""{name} AS (
  {base}
  UNION ALL
  SELECT p.doc_id, p.grp, p.lvl + 1, (p.n + 1) // 2, p.idx // 2,
    sha256(CASE WHEN p.idx % 2 = 0 THEN p.acc || coalesce(s.h, '') ELSE s.h || p.acc END), p.proof || coalesce(s.h, '')
  FROM {name} p LEFT JOIN {nodes} s ON s.grp = p.grp AND s.lvl = p.lvl AND s.idx = xor(p.idx, 1) WHERE p.n > 1
)"""


def nodes_sql(name: str, base: str) -> str:
    return f"""{name} AS (
  {base}
  UNION ALL
  SELECT grp, lvl + 1, (n + 1) // 2, idx // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM {name} WHERE n > 1 GROUP BY grp, lvl, n, idx // 2
)"""


OP13 = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS grp, {leaf_sql("n_chars")} AS leaf, CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {leaf_sql("(n_chars + 1)")} ELSE {leaf_sql("n_chars")} END AS tampered,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM documents
), {nodes_sql("nodes", "SELECT grp, 0 AS lvl, n, idx, leaf AS h FROM leaves")}, heads AS (
  SELECT '' AS grp, grp AS g, h, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1
), {nodes_sql("uppers", "SELECT grp, 0 AS lvl, n, idx, h FROM heads")},
{path_sql("low", "SELECT doc_id, grp, 0 AS lvl, n, idx, tampered AS acc, '' AS proof FROM leaves", "nodes")},
{path_sql("high", "SELECT l.doc_id, '' AS grp, 0 AS lvl, h.n, h.idx, l.acc, l.proof FROM low l JOIN heads h ON h.g = l.grp WHERE l.n = 1", "uppers")}
SELECT l.doc_id, l.leaf, h.h AS subroot, r.h AS root, sha256(p.proof) AS proof_sha256, p.acc AS folded_root, p.acc = r.h AS verified
FROM leaves l JOIN heads h ON h.g = l.grp JOIN high p ON p.doc_id = l.doc_id AND p.n = 1 JOIN uppers r ON r.n = 1
"""

OP12 = f"""
WITH RECURSIVE r AS (
  SELECT CAST(doc_id AS VARCHAR) || ':' || run AS k, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents WHERE text IS NOT NULL
  ) GROUP BY ALL
), h AS (SELECT run, n, {crc32("k")} AS h FROM r), w AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h
), words AS (SELECT word, sum(n)::BIGINT AS n FROM w WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), less AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words
), cut AS (SELECT DISTINCT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS c FROM less
), near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.c = b.c AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.c = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.c = b.word
), best AS (SELECT word, count(*) AS n_near, max(m) AS m, min(other) FILTER (WHERE m = top) AS other FROM (SELECT *, max(m) OVER (PARTITION BY word) AS top FROM near) GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * w.n THEN other END AS form, CASE WHEN m >= 5 * w.n THEN m END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word
), follow AS (
  SELECT word, word AS root, form AS next FROM forms UNION ALL SELECT f.word, g.word, g.form FROM follow f JOIN forms g ON g.word = f.next
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM forms f JOIN follow r ON r.word = f.word AND r.next IS NULL
"""

ORACLE = {"op5_lm_scoring": OP5, "op6_quality_rules": OP6, "quality_ablations": ABLATIONS, "op8_line_dedup": OP8, "op9_decontamination": OP9, "op10_chat_formatting": OP10, "op11_exact_dedup": OP11, "op12_spelling_variants": OP12, "op13_merkle_manifest": OP13}
