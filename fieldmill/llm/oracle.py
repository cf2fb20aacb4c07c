"""DuckDB SQL for the queries of this package that SQL can express on whole tables.

Trained scores, alignments, fingerprints, page texts, repeated spans, the mix, token ids and eigenvectors
are beyond SQL; the tests hold them against brute force.
"""

from __future__ import annotations

from fieldmill.llm.licenses import BASE, NOTICES

LLM_ORACLE: dict[str, str] = {}

LLM_ORACLE["op1_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(octet_length(encode(html)), 0) AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest FROM pages
), q AS (
  SELECT *, CASE WHEN payload_bytes >= 1000
    THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes >= 1000) END AS first FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM q"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LLM_ORACLE["op3_near_duplicates"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(list_slice(w, i, i + 4), ' ')
      FOR i IN range(1, len(w) - 3)]) END AS grams FROM w
), g AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s
), link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM s
  UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, component_id,
  doc_id = component_id AS kept FROM s JOIN c USING (doc_id)"""

_CONTROL = r"[<\[]\\*(?:\|\w*\|>|/?s>|</?SYS>>|(?:start|end)_of_turn>|/?INST\])"
LLM_ORACLE["op4_chat"] = f"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), c AS (
  SELECT conv_id, count(*) AS n_turns, list(role ORDER BY turn, role, text) AS roles,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')
      AS learned,
    sum(12 + length(role) + 1 + length(text) + 11
      + len(regexp_extract_all(text, '{_CONTROL}'))) AS formatted_chars
  FROM t GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned) AS loss_chars,
  sha256(learned) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars,
  CASE roles WHEN ['user', 'assistant'] THEN 'prompt'
    WHEN ['system', 'user', 'assistant'] THEN 'instruction' ELSE 'conversations' END AS layout
FROM c"""


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_BASES = ", ".join(f"('{t.label}', {_list(t.words)})" for t in BASE)
_NOTICES = ", ".join(f"('{t.label}', {_list(t.distinct)}, {t.need}, {t.stretch})" for t in NOTICES)
LLM_ORACLE["op8_licenses"] = f"""
WITH w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')
    IF x <> ''] AS w FROM documents
), bases(label, phrase) AS (VALUES {_BASES}
), notices(label, words, need, stretch) AS (VALUES {_NOTICES}
), places AS (
  SELECT doc_id, label, pos FROM (
    SELECT doc_id, label, phrase, w, unnest(range(1, len(w) - len(phrase) + 2)) AS pos
    FROM w JOIN bases ON list_has_all(w, phrase))
  WHERE list_slice(w, pos, pos + len(phrase) - 1) = phrase
), found AS (
  SELECT doc_id, label, max(k) / max(n) AS share FROM (
    SELECT doc_id, label, need, len(words) AS n,
      len(list_intersect(list_slice(w, pos, pos + stretch - 1), words)) AS k
    FROM (SELECT doc_id, label, words, need, stretch, w, unnest(range(1, len(w) + 1)) AS pos
      FROM w JOIN notices ON len(list_intersect(w, words)) >= need))
  WHERE k >= need GROUP BY doc_id, label
), b AS (
  SELECT doc_id, count(*) AS n_base, min(pos) - 1 AS first_word, max(pos) - 1 AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY doc_id
), l AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM (SELECT doc_id, label, 1.0::DOUBLE AS share FROM places UNION ALL SELECT * FROM found)
  GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word,
  last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0.0)::DOUBLE AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id)"""

# CRC-32 of a decimal number: a step for each byte and eight for its bits
_BITS = ", ".join(["-1"] * 8)
_CRC = f"""xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
  string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [ascii(x)::BIGINT, {_BITS}]))), lambda a, b:
  CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END))"""
LLM_ORACLE["op11_prefix_trie"] = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), h AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth FROM (
    SELECT h.conv_id, 0 AS own, pos, role, text FROM h JOIN t ON t.conv_id = base WHERE pos <= h
    UNION ALL SELECT h.conv_id, 1, pos, role, text FROM h JOIN t ON t.conv_id = h.conv_id WHERE pos > h)
), p AS (
  SELECT conv_id, depth, octet_length(encode(text)) AS bytes, sha256(string_agg(
    sha256(length(role) || ' ' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM h
), n AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM p GROUP BY ALL
), up AS (
  SELECT n.*, p.node AS parent FROM n LEFT JOIN p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
), kids AS (SELECT parent AS node, count(*) AS n_children FROM up WHERE parent IS NOT NULL GROUP BY parent
), sub AS (
  SELECT p.node, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum((n_convs - 1) * up.bytes) AS saved
  FROM up LEFT JOIN kids ON kids.node = up.node JOIN p ON p.conv_id = up.conv_id AND p.depth <= up.depth
  GROUP BY p.node
), e AS (
  SELECT node, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM p WHERE (conv_id, depth) IN (SELECT conv_id, max(depth) FROM p GROUP BY conv_id) GROUP BY node
)
SELECT up.conv_id, up.depth, parents.conv_id AS parent_conv_id, up.n_convs,
  coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  sha256(coalesce(ids, '')) AS ends_sha256
FROM up LEFT JOIN n AS parents ON parents.node = up.parent LEFT JOIN kids ON kids.node = up.node
JOIN sub ON sub.node = up.node LEFT JOIN e ON e.node = up.node"""
