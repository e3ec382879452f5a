"""What the queries of this subpackage must return, as SQL for another engine, where SQL can say it.

Fingerprints by chunks, learned scores, XXH64, byte pair merges and boundaries found by search are
tested against brute force instead.
"""

from __future__ import annotations

from fragloom.llm.line_rules import PHRASES, SENTENCE_END, SEPARATOR, SHOUT, SYMBOL

_SENTENCE_END = SENTENCE_END.replace("'", "''")

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower_words(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


_LEAKS = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, {_lower_words("text")} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_lower_words("text")} AS w FROM benchmark),
starts AS (SELECT item, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, least(10, len(w)) AS k, array_to_string(w[i : i + 9], ' ') AS p FROM starts),
sizes AS (SELECT DISTINCT k FROM windows),
places AS (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k),
found AS (
  SELECT rid, i, p.k, item
  FROM (SELECT rid, i, k, array_to_string(w[i : i + k - 1], ' ') AS p FROM places) AS p
  JOIN windows ON p.p = windows.p AND p.k = windows.k
),
hits AS (SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, unnest(range(i, i + k)) AS j FROM found) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS joined
  FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hits.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(joined, '')) AS items_sha256,
       coalesce(hits.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (rid) LEFT JOIN items USING (rid)
"""

_REPEATS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20),
ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY p ORDER BY doc_id, i) AS nth
  FROM (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS p FROM places)
),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM ranked WHERE nth > 1),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d),
summed AS (
  SELECT words.doc_id, count(*) AS n, count(gone.j) AS removed,
         string_agg(word, ' ' ORDER BY words.j) FILTER (WHERE gone.j IS NULL) AS kept
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.j = gone.j GROUP BY words.doc_id
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_words, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN summed USING (doc_id)
"""

# Strings are compared by their MD5; what is kept is put together in hexadecimal.
_STRINGS = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, strlen(coalesce(text, '')) AS n FROM documents),
places AS (SELECT doc_id, b, unnest(range(1, n - 398)) AS i FROM d WHERE n >= 400),
counted AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY p) AS times
  FROM (SELECT doc_id, i, md5_number(b[i : i + 399]) AS p FROM places)
),
marked AS (
  SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 400 THEN 0 ELSE 1 END AS new
  FROM counted WHERE times > 1
),
grouped AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
spans AS (SELECT doc_id, min(i) AS s, max(i) + 400 AS e FROM grouped GROUP BY doc_id, span),
cut AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 1) AS before FROM spans),
summed AS (
  SELECT doc_id, count(*) AS n_spans, sum(e - s) AS removed, max(e) AS last,
         string_agg(hex(b[before : s - 1]), '' ORDER BY s) AS kept
  FROM cut JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept || hex(b[last : n]), hex(b)))) AS kept_sha256
FROM d LEFT JOIN summed USING (doc_id)
"""

# Characters of the marks around a text of each role, `<s>` and `</s>` included.
_CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
written AS (
  SELECT *, CASE role WHEN 'user' THEN 22 WHEN 'system' THEN 24 WHEN 'assistant' THEN 7 ELSE 23 + length(role) END
         + length(regexp_replace(text, '(\\|</?s>|\[/?INST\]|<</?SYS>>|\[ROLE |\[/ROLE\])', '\\\1', 'g')) AS chars
  FROM c
),
placed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn) AS so_far,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS from_end
  FROM written
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(so_far) FILTER (WHERE role = 'assistant' OR from_end = 1) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""

# Base32 takes five bits a character, so five hexadecimal digits give four of them.
_ARCHIVES = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages
),
digests AS (SELECT *, sha1(html) AS hex FROM p),
fives AS (
  SELECT page_id, html, first,
         [CAST('0x' || substr(hex, 5 * q + 1, 5) AS BIGINT) FOR q IN range(8)] AS fives
  FROM digests
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((fives[k // 4 + 1] // [32768, 1024, 32, 1][k % 4 + 1]) % 32 + 1 AS BIGINT), 1) FOR k IN range(32)], '')
         AS payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM fives
"""

# Line rules in the words of fragloom.llm.line_rules; the patterns are those of that module.
_LINES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
windows AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, p) AS times
  FROM (SELECT rid, i, array_to_string(w[i : i + 7], ' ') AS p
        FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8))
),
repeated AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS j FROM windows WHERE times > 1) GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
judged AS (
  SELECT rid, line, len(lw) >= 3 AND regexp_matches(line, '{_SENTENCE_END}')
         AND 2 * len(regexp_extract_all(line, '{SYMBOL}')) < len(lw)
         AND 3 * len(regexp_extract_all(line, '{SHOUT}')) <= len(lw)
         AND 5 * len(regexp_extract_all(line, '{SEPARATOR}')) < len(lw)
         AND NOT regexp_matches(lower(line), '{"|".join(PHRASES)}') AS passes,
         length(array_to_string(lw, '')) AS chars
  FROM (SELECT rid, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw FROM lines) WHERE len(lw) > 0
),
summed AS (
  SELECT rid, count(*) - count(DISTINCT line) AS dups, count(*) FILTER (WHERE NOT passes) AS gone,
         sum(chars) AS chars, coalesce(sum(chars) FILTER (WHERE passes), 0) AS left_chars
  FROM judged GROUP BY rid
),
figures AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(chars, 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '{SYMBOL}')) AS BIGINT) AS n_symbols, CAST(coalesce(dups, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(gone, 0) AS BIGINT) AS n_lines_removed,
         CAST(coalesce(left_chars, 0) AS BIGINT) AS kept_chars
  FROM d LEFT JOIN summed USING (rid) LEFT JOIN repeated USING (rid)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * (word_chars - kept_chars) <= 30 * word_chars AS kept
FROM figures
"""


def _crc32(text: str) -> str:
    """The CRC of an ASCII text, unsigned."""
    turn = "list_reduce(range(8), lambda c, i: xor(c >> 1, (c & 1) * 3988292384), xor(crc, byte))"
    of = f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ord(substr({text}, i, 1)) AS BIGINT))"
    return f"xor(list_reduce({of}, lambda crc, byte: {turn}, CAST(4294967295 AS BIGINT)), 4294967295)"


def _leaf(text: str) -> str:
    fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


_TREE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_leaf("text")} AS leaf, {_leaf(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} AS lowered,
         {_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 AS chosen, dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree
  FROM documents
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY tree) AS n, row_number() OVER () AS rid
  FROM d
),
low AS (
  SELECT 0 AS lvl, tree, place, n, leaf AS node FROM leaves
  UNION ALL
  SELECT lvl + 1, tree, place // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY place))
  FROM low WHERE n > 1 GROUP BY lvl, tree, place // 16, n
),
tops AS (SELECT tree, node, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS lvl, place, n, node FROM tops
  UNION ALL
  SELECT lvl + 1, place // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY place))
  FROM high WHERE n > 1 GROUP BY lvl, place // 16, n
),
nodes AS (
  SELECT 0 AS part, lvl, tree, place, node FROM low UNION ALL SELECT 1, lvl, 0, place, node FROM high
),
sides AS (
  SELECT part, lvl, tree, place,
         coalesce(string_agg(node, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(node, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM nodes WINDOW run AS (PARTITION BY part, lvl, tree, place // 16 ORDER BY place)
),
walk AS (
  SELECT rid, 0 AS lvl, tree, place, n, CASE WHEN chosen THEN lowered ELSE leaf END AS node, '' AS proof FROM leaves
  UNION ALL
  SELECT rid, walk.lvl + 1, walk.tree, walk.place // 16, (n + 15) // 16, sha256(before || node || after),
         proof || before || after
  FROM walk JOIN sides ON part = 0 AND sides.lvl = walk.lvl AND sides.tree = walk.tree AND sides.place = walk.place
  WHERE n > 1
),
climb AS (
  SELECT rid, 0 AS lvl, tops.place, tops.n, walk.node, proof FROM walk JOIN tops USING (tree) WHERE walk.n = 1
  UNION ALL
  SELECT rid, climb.lvl + 1, climb.place // 16, (n + 15) // 16, sha256(before || node || after), proof || before || after
  FROM climb JOIN sides ON part = 1 AND sides.lvl = climb.lvl AND sides.place = climb.place
  WHERE n > 1
)
SELECT doc_id, leaf, tops.node AS subroot, high.node AS root, sha256(proof) AS proof_sha256, climb.node AS folded_root,
       climb.node = high.node AS verified
FROM leaves JOIN tops USING (tree) JOIN climb USING (rid) JOIN high ON high.n = 1 WHERE climb.n = 1
"""

# A node is known by the SHA-256 of its turns, each with its lengths.
_PREFIXES = rf"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i,
         {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS turn
  FROM conversations WHERE conv_id IS NOT NULL
),
own AS (SELECT c, list(turn ORDER BY i) AS turns, c - c % 20 AS family, {_crc32("CAST(c AS VARCHAR)")} % 4 AS h FROM t GROUP BY c),
built AS (
  SELECT own.c, list_concat(coalesce(head.turns, [])[1 : own.h], own.turns[own.h + 1 :]) AS turns
  FROM own LEFT JOIN own AS head ON head.c = own.family
),
depths AS (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM built),
prefixes AS (
  SELECT c, d, len(turns) AS length, turns[d].text AS last,
         sha256(array_to_string(list_transform(turns[1 : d], lambda x: length(x.role) || ':' || length(x.text) || ':' || x.role || x.text), '')) AS node
  FROM depths
),
paths AS (SELECT c, list(node ORDER BY d) AS path FROM prefixes GROUP BY c),
nodes AS (
  SELECT node, min(c) AS conv_id, any_value(d) AS depth, count(*) AS n_convs, count(*) FILTER (WHERE length > d) AS more,
         (count(*) - 1) * len(regexp_extract_all(coalesce(any_value(last), ''), '[^\x20\x09-\x0D]+')) AS saved,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE length = d), '')) AS ends
  FROM prefixes GROUP BY node
),
lines AS (SELECT nodes.*, path, unnest(range(1, depth + 2)) AS k FROM nodes JOIN paths ON paths.c = nodes.conv_id),
sums AS (
  SELECT path[k] AS node, sum(saved) AS saved, count(*) FILTER (WHERE more = 0) AS leaves, count(*) FILTER (WHERE k = depth) AS children
  FROM lines GROUP BY path[k]
)
SELECT nodes.conv_id, CAST(nodes.depth AS BIGINT) AS depth, parent.conv_id AS parent_conv_id,
       CAST(nodes.n_convs AS BIGINT) AS n_convs, CAST(children AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
       CAST(sums.saved AS BIGINT) AS saved_tokens, nodes.ends AS ends_sha256
FROM nodes JOIN sums USING (node) JOIN paths ON paths.c = nodes.conv_id
LEFT JOIN nodes AS parent ON nodes.depth > 0 AND parent.node = path[nodes.depth]
"""

ORACLES: dict[str, str] = {
    "op2_wu_manber_decontamination": _LEAKS,
    "op4_de_bruijn_dedup": _REPEATS,
    "op6_prefix_target_chat": _CHAT,
    "op8_suffix_array_dedup": _STRINGS,
    "op9_salvaged_warc": _ARCHIVES,
    "op11_line_first_rules": _LINES,
    "op12_slot_pivot_manifest": _TREE,
    "op13_prefix_trie": _PREFIXES,
}
