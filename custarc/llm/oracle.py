"""SQL that the queries must agree with, where SQL can express the contract.

It can't for packing, the classifier, HTML and approximate search; the extra kinds of personal data
need look-behind, which the checking engine's patterns lack. Those queries are tested against plain
versions in tests/llm.
"""

from __future__ import annotations

from custarc.llm.common import LOWER, UPPER

_LOW = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORD13 = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

LINE_DEDUP = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS p FROM d),
k AS (SELECT *, translate(trim(line, {_BLANKS}), '{UPPER}', '{LOWER}') AS key FROM l),
f AS (SELECT key AS hit FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(hit) AS n_dropped,
 sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE hit IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON key = hit GROUP BY r, doc_id"""

NGRAM_JACCARD = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOW}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[k + 1:k + 5], ' ') AS g FROM (SELECT r, w, unnest(range(greatest(1, len(w) - 4))) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
links AS (SELECT x.r AS a, y.r AS b FROM s x JOIN s y ON x.g = y.g AND x.r <> y.r
 JOIN n p ON p.r = x.r JOIN n q ON q.r = y.r GROUP BY x.r, y.r, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
keyed AS (SELECT r, sha256(string_agg(g, chr(10) ORDER BY g)) AS v FROM s GROUP BY r),
classes AS (SELECT v, min(doc_id) AS class_id FROM keyed JOIN d USING (r) GROUP BY v),
others AS (SELECT x.v, count(DISTINCT y.v) AS n_links FROM links JOIN keyed x ON x.r = a JOIN keyed y ON y.r = b WHERE x.v <> y.v GROUP BY x.v),
found AS (SELECT d.r, d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id
 FROM d LEFT JOIN n USING (r) JOIN reach ON reach.a = d.r JOIN d o ON o.r = reach.b GROUP BY d.r, d.doc_id)
SELECT doc_id, n_shingles, component_id, CASE WHEN v IS NULL THEN doc_id ELSE class_id END AS class_id, coalesce(n_links, 0) AS n_links
FROM found LEFT JOIN keyed USING (r) LEFT JOIN classes USING (v) LEFT JOIN others USING (v)"""

SHARDING = """
WITH crc AS (SELECT list(list_reduce(range(9), lambda c, i: CASE WHEN i = 0 THEN c WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
 FROM range(256) x(b)),
d AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 8 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, size, xor(list_reduce(list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT),
  lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS text_crc32 FROM d, crc),
p AS (SELECT *, sum(size) OVER (ORDER BY doc_id) - size AS start, sum(size) OVER () AS total FROM c),
q AS (SELECT *, CAST((start * 24) // total AS INTEGER) AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot,
 CAST(NULL AS INTEGER) AS grown_shard FROM q"""

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOW}, '{_WORD13}') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOW}, '{_WORD13}') AS w FROM benchmark),
iw AS (SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[k + 1:k + 13], ' ') AS g
 FROM (SELECT *, unnest(range(greatest(1, len(w) - 12))) AS k FROM i WHERE len(w) > 0)),
dw AS (SELECT r, n, k, array_to_string(w[k + 1:k + n], ' ') AS g
 FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS k FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
m AS (SELECT r, k, n, item FROM dw JOIN iw USING (n, g)),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM m) GROUP BY r),
found AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM m GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
 coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN found USING (r)"""

CHAT_FORMATTING = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT -1, x, CASE x WHEN 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok' FROM range(2) y(x)),
e AS (SELECT *, regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g') AS safe FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
 coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
 sum(length('<|im_start|>' || role || chr(10) || safe || '<|im_end|>' || chr(10)))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""

_CRC = """crc AS (SELECT list(list_reduce(range(9), lambda c, i: CASE WHEN i = 0 THEN c WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
 FROM range(256) x(b))"""


def _crc32(hexed: str) -> str:
    """crc32 of a text given as hex; needs the table of _CRC."""
    return f"""xor(list_reduce(list_transform(regexp_extract_all({hexed}, '..'), lambda x: ('0x' || x)::BIGINT),
  lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295)"""


# Dynamic programming, a row of every conversation at a time: per state the cheapest (cost, audit) so far.
# Inserts happen before a row; from state and number of inserts a row is kept, renamed or deleted.
CONVERSATION_REPAIR = rf"""
WITH RECURSIVE {_CRC},
o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
 {_crc32("hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')))")} % 20 AS h FROM conversations, crc),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
 CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
 unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM o),
v AS (SELECT *, right(rtrim(text, {_BLANKS}), 1) AS e, left(role, 1) AS x,
 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM d),
f AS (SELECT *, CASE WHEN e = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
 WHEN e NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, lag(x) OVER (PARTITION BY conv_id ORDER BY i) AS px FROM v),
moves(s, ins, u) AS (VALUES (0, '', 0), (0, 'I', 2), (0, 'II', 3), (1, '', 1), (1, 'I', 2), (1, 'II', 3), (2, '', 2), (2, 'I', 3), (3, '', 3), (3, 'I', 2)),
edits AS (SELECT u, e, x, t, CASE e WHEN 'K' THEN 0 WHEN 'R' THEN 3 ELSE 4 END AS paid FROM (VALUES
 (0, 'K', 's', 1), (0, 'K', 'u', 2), (1, 'K', 'u', 2), (2, 'K', 'a', 3), (3, 'K', 'u', 2),
 (0, 'R', NULL, 2), (1, 'R', NULL, 2), (2, 'R', NULL, 3), (3, 'R', NULL, 2), (0, 'D', NULL, 0), (1, 'D', NULL, 1), (2, 'D', NULL, 2), (3, 'D', NULL, 3)) y(u, e, x, t)),
steps AS (SELECT s, t, ins, e, edits.x, 3 * length(ins) + paid AS paid, ins || e AS done, moves.u FROM moves JOIN edits USING (u)),
ways(conv_id, i, s, best) AS (SELECT DISTINCT conv_id, 0::BIGINT, 0, {{'cost': 0, 'audit': '', 'said': ''}} FROM f
 UNION ALL
 SELECT ways.conv_id, ways.i + 1, steps.t, min({{'cost': best.cost + steps.paid + CASE WHEN fault = 'truncated' AND steps.e <> 'D' THEN 3 ELSE 0 END, 'audit': best.audit || steps.done,
  'said': best.said || CASE WHEN steps.ins = '' THEN '' WHEN steps.ins = 'II' THEN chr(10) || 'user:' || chr(10) || 'assistant:' WHEN steps.s = 2 THEN chr(10) || 'assistant:' ELSE chr(10) || 'user:' END
   || CASE steps.e WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text ELSE chr(10) || CASE WHEN steps.u = 2 THEN 'assistant:' ELSE 'user:' END || f.text END}})
 FROM ways JOIN f ON f.conv_id IS NOT DISTINCT FROM ways.conv_id AND f.i = ways.i + 1 JOIN steps ON steps.s = ways.s
 WHERE (steps.x IS NULL OR steps.x = f.x) AND (steps.e = 'D' OR fault NOT IN ('blank', 'duplicate')) GROUP BY ways.conv_id, ways.i, steps.t),
n AS (SELECT conv_id, count(*) AS n, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
 count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE px || x NOT IN ('su', 'ua', 'au')) AS illegal,
 coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM f GROUP BY conv_id),
e AS (SELECT n.conv_id, min({{'cost': best.cost + CASE s WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END, 'audit': best.audit || CASE s WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
  'said': best.said || CASE s WHEN 1 THEN chr(10) || 'user:' || chr(10) || 'assistant:' WHEN 2 THEN chr(10) || 'assistant:' ELSE '' END}}) AS best
 FROM n JOIN ways ON ways.conv_id IS NOT DISTINCT FROM n.conv_id AND ways.i = n.n GROUP BY n.conv_id),
c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
 coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(best.said[2:], '')) AS repaired_sha256
FROM c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM c.conv_id"""

# Near words share a variant with one code point left out: at the same place, or one is the variant.
SPELLING_VARIANTS = rf"""
WITH RECURSIVE {_CRC},
r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{LOWER}') AS run FROM documents),
o AS (SELECT d, run, count(*) AS n, any_value({{'h': {_crc32("hex(encode(d || ':' || run))")}}}).h AS h FROM r, crc WHERE length(run) >= 7 GROUP BY d, run),
w AS (SELECT CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, sum(n)::BIGINT AS n FROM o GROUP BY 1
 HAVING length(word) >= 7 AND sum(n) >= 2),
x AS (SELECT word, p, word[:p] || word[p + 2:] AS v FROM (SELECT word, unnest(range(length(word))) AS p FROM w)),
one AS (SELECT x.word AS a, y.word AS b FROM x JOIN x y ON x.v = y.v AND x.p = y.p AND x.word <> y.word UNION SELECT word, v FROM x SEMI JOIN w y ON y.word = x.v),
near AS (SELECT a, b FROM one UNION SELECT b, a FROM one),
best AS (SELECT a, count(*) AS n_near, min({{'less': -n, 'word': b}}) AS best FROM near JOIN w ON w.word = b GROUP BY a),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 10 * n THEN best.word END AS form, CASE WHEN -best.less >= 10 * n THEN -best.less END AS form_n
 FROM w LEFT JOIN best ON a = word),
ways AS (SELECT word, word AS root, 0 AS k FROM f UNION ALL SELECT ways.word, f.form, k + 1 FROM ways JOIN f ON f.word = ways.root WHERE f.form IS NOT NULL)
SELECT f.*, root FROM f JOIN (SELECT word, max_by(root, k) AS root FROM ways GROUP BY word) USING (word)"""

WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, row_number() OVER () AS r FROM pages),
d AS (SELECT *, octet_length(b) AS n, sha1(b) AS h FROM p),
g AS (SELECT *, first_value(r) OVER w AS first, max(page_id) OVER (PARTITION BY h) AS top FROM d WINDOW w AS (PARTITION BY h ORDER BY page_id DESC NULLS LAST, r))
SELECT page_id, n AS payload_bytes, h AS payload_digest, CASE WHEN n < 1000 OR r = first THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN n >= 1000 AND r <> first THEN top END AS refers_to FROM g"""

ORACLE = {
    "op13_warc": WARC,
    "op12_spelling_variants": SPELLING_VARIANTS,
    "op11_conversation_repair": CONVERSATION_REPAIR,
    "op1_line_dedup": LINE_DEDUP,
    "op4_ngram_jaccard": NGRAM_JACCARD,
    "op5_sharding": SHARDING,
    "op6_decontamination": DECONTAMINATION,
    "op9_chat_formatting": CHAT_FORMATTING,
}
