"""The results of text queries in plain SQL (DuckDB), where SQL can express them."""

_FRAMED = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"


def _leaf(*columns: str) -> str:
    return "sha256(" + " || ".join(_FRAMED.format(c) for c in columns) + ")"


# CRC-32 of ASCII text: eight shifts for each byte.
_CRC32 = """xor(4294967295, list_reduce(list_transform(string_split({0}, ''), lambda ch: CAST(ascii(ch) AS UBIGINT)),
    lambda crc, b: list_reduce(range(8)::UBIGINT[], lambda a, k: xor(a >> 1, 3988292384 * (a & 1)), xor(crc, b)), 4294967295::UBIGINT))"""

MERKLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {_leaf("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
    CASE WHEN {_CRC32.format("CAST(doc_id AS VARCHAR)")} % 2 = 0
         THEN {_leaf("doc_id", "source", "lang", "n_chars", "replace(text, chr(10), '')")}
         ELSE {_leaf("doc_id", "source", "lang", "n_chars", "text")} END AS changed
  FROM documents),
p AS (SELECT *, row_number() OVER () AS rid, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY source) AS n FROM d),
low AS (
  SELECT source, 0 AS lvl, pos, n, leaf AS digest FROM p
  UNION ALL
  SELECT source, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM low WHERE n > 1
  GROUP BY source, lvl, pos // 3, n),
sub AS (SELECT source, digest, lvl AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM low WHERE n = 1),
high AS (
  SELECT 0 AS lvl, pos, n, digest FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY lvl, pos // 3, n),
nodes AS (
  SELECT coalesce('=' || source, '') AS grp, lvl, pos, digest FROM low WHERE n > 1
  UNION ALL SELECT 'top', lvl, pos, digest FROM high WHERE n > 1),
sib AS (
  SELECT a.grp, a.lvl, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM nodes a JOIN nodes b ON a.grp = b.grp AND a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 GROUP BY a.grp, a.lvl, a.pos),
fold AS (
  SELECT rid, coalesce('=' || source, '') AS grp, pos, 0 AS lvl, changed AS digest, '' AS proof FROM p
  UNION ALL
  SELECT f.rid, f.grp, f.pos // 3, f.lvl + 1, sha256(s.l || f.digest || s.r), f.proof || s.l || s.r
  FROM fold f JOIN sib s ON s.grp = f.grp AND s.lvl = f.lvl AND s.pos = f.pos),
rise AS (
  SELECT f.rid, s.pos, 0 AS lvl, f.digest, f.proof FROM fold f JOIN sub s ON f.grp = coalesce('=' || s.source, '') AND f.lvl = s.height
  UNION ALL
  SELECT f.rid, f.pos // 3, f.lvl + 1, sha256(s.l || f.digest || s.r), f.proof || s.l || s.r
  FROM rise f JOIN sib s ON s.grp = 'top' AND s.lvl = f.lvl AND s.pos = f.pos),
root AS (SELECT digest, lvl FROM high WHERE n = 1)
SELECT p.doc_id, p.leaf, sub.digest AS subroot, root.digest AS root, sha256(rise.proof) AS proof_sha256, rise.digest AS folded_root,
  rise.digest = root.digest AS verified
FROM p JOIN sub ON p.source IS NOT DISTINCT FROM sub.source CROSS JOIN root JOIN rise ON rise.rid = p.rid AND rise.lvl = root.lvl
"""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM t),
e AS (SELECT *, lag(role) OVER w IS DISTINCT FROM role AS opens, lead(role) OVER w IS DISTINCT FROM role AS closes FROM o
      WINDOW w AS (PARTITION BY conv_id ORDER BY k))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g'))
    + CASE WHEN opens THEN length('<|im_start|>') + length(url_encode(role)) + 1 ELSE length('<|im_sep|>') END
    + CASE WHEN closes THEN length('<|im_end|>') + 1 ELSE 0 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

_TERMS = (r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))")

SEARCH = f"""
WITH dt AS (SELECT row, doc_id, term, count(*) AS tf FROM (
    SELECT row, doc_id, {_TERMS} AS term FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)) GROUP BY ALL),
it AS (SELECT row, item_id, term, count(*) AS q FROM (
    SELECT row, item_id, {_TERMS} AS term FROM (SELECT row_number() OVER () AS row, item_id, text FROM benchmark)) GROUP BY ALL),
c AS (SELECT count(DISTINCT row) AS n_docs, CAST(sum(tf) AS BIGINT) AS n_terms FROM dt),
m AS (SELECT row, 25 + (75 * CAST(sum(tf) AS BIGINT) * any_value(n_docs)) // any_value(n_terms) AS m FROM dt, c GROUP BY row),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM dt, c GROUP BY term),
s AS (SELECT it.row AS item, any_value(item_id) AS item_id, dt.row, any_value(doc_id) AS doc_id,
        CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM it JOIN w USING (term) JOIN dt USING (term) JOIN m ON m.row = dt.row GROUP BY it.row, dt.row),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""

REPEATS = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d),
r AS (SELECT rid, i, count(*) OVER (PARTITION BY sha256(array_to_string(w[i:i + 34], ' '))) AS n FROM s),
c AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS k FROM r WHERE n > 1),
t AS (SELECT rid, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS word FROM d)
SELECT any_value(d.doc_id) AS doc_id, count(t.k) AS n_words, count(c.k) AS n_removed,
  sha256(coalesce(string_agg(t.word, ' ' ORDER BY t.k) FILTER (WHERE c.k IS NULL), '')) AS kept_sha256
FROM d LEFT JOIN t ON t.rid = d.rid LEFT JOIN c ON c.rid = t.rid AND c.k = t.k GROUP BY d.rid
"""

ORACLES: dict[str, str] = {
    "op3_substring_dedup": REPEATS,
    "op11_merkle_midstates": MERKLE,
    "op12_relational_chat": CHAT,
    "op13_dense_search": SEARCH,
}
