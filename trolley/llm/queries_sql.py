"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a string's UTF-8 bytes, bit by bit."""
    byte = f"('0x' || substr(hex({text}), 2 * i + 1, 2))::BIGINT"
    bits = (
        "list_reduce(range(9), lambda a, j: CASE WHEN j = 0 THEN a "
        "WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, xor(c, b))"
    )
    steps = f"list_reduce(list_transform(range(strlen({text})), lambda i: {byte}), lambda c, b: {bits}, 4294967295)"
    return f"xor({steps}, 4294967295)"


def _leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return f"sha256({' || '.join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields)})"


_OTHERS = "array_to_string(members[1:pos % 16], ''), array_to_string(members[pos % 16 + 2:], '')"

MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS rid, doc_id, source, {_leaf('text')} AS leaf,
    CASE WHEN {_crc32('doc_id::VARCHAR')} % 5 = 0 THEN {_leaf(f'translate(text, {_AZ})')}
         ELSE {_leaf('text')} END AS presented
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n
  FROM leaves
), tree AS (
  SELECT source, 0 AS level, pos, n, leaf AS digest FROM placed
  UNION ALL
  SELECT source, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
  FROM tree WHERE n > 1 GROUP BY source, level, n, pos // 16
), runs AS (
  SELECT source, level, pos // 16 AS run, list(digest ORDER BY pos) AS members
  FROM tree WHERE n > 1 GROUP BY source, level, pos // 16
), subroots AS (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM tree WHERE n = 1
), top AS (
  SELECT 0 AS level, pos, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
  FROM top WHERE n > 1 GROUP BY level, n, pos // 16
), top_runs AS (
  SELECT level, pos // 16 AS run, list(digest ORDER BY pos) AS members
  FROM top WHERE n > 1 GROUP BY level, pos // 16
), walk AS (
  SELECT rid, source, 0 AS level, pos, '' AS proof, presented AS node, true AS more FROM placed
  UNION ALL
  SELECT w.rid, w.source, w.level + 1, w.pos // 16, concat(w.proof, {_OTHERS.replace('pos', 'w.pos')}),
    CASE WHEN members IS NULL THEN node
         ELSE sha256(concat({_OTHERS.replace('pos', 'w.pos').replace(', array', ', node, array')})) END,
    members IS NOT NULL
  FROM walk w LEFT JOIN runs r ON w.source IS NOT DISTINCT FROM r.source AND w.level = r.level AND w.pos // 16 = r.run
  WHERE w.more
), climb AS (
  SELECT w.rid, 0 AS level, s.pos, w.proof, w.node, true AS more
  FROM walk w JOIN subroots s ON w.source IS NOT DISTINCT FROM s.source WHERE NOT w.more
  UNION ALL
  SELECT w.rid, w.level + 1, w.pos // 16, concat(w.proof, {_OTHERS.replace('pos', 'w.pos')}),
    CASE WHEN members IS NULL THEN node
         ELSE sha256(concat({_OTHERS.replace('pos', 'w.pos').replace(', array', ', node, array')})) END,
    members IS NOT NULL
  FROM climb w LEFT JOIN top_runs r ON w.level = r.level AND w.pos // 16 = r.run
  WHERE w.more
), heights AS (SELECT rid, count(*) FILTER (more) - 1 AS steps FROM walk GROUP BY rid),
climbs AS (SELECT rid, count(*) FILTER (more) - 1 AS steps FROM climb GROUP BY rid)
SELECT p.doc_id, p.leaf, s.subroot, t.digest AS root, sha256(c.proof) AS proof_sha256,
  c.node AS folded_root, (h.steps + k.steps)::BIGINT AS height, c.node = t.digest AS verified
FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
JOIN climb c ON c.rid = p.rid AND NOT c.more JOIN heights h ON h.rid = p.rid JOIN climbs k ON k.rid = p.rid
CROSS JOIN (SELECT digest FROM top WHERE n = 1) t
"""

SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc,
    translate(unnest(regexp_extract_all(text, '[A-Za-z\u00c0-\u00ff]+')), {_AZ}) AS run
  FROM documents
), hashed AS (
  SELECT run, {_crc32("concat(doc, ':', run)")} AS h, n
  FROM (SELECT doc, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY doc, run)
), words AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
    sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING sum(n) >= 2 AND length(word) >= 7
), shorter AS (
  SELECT word, i AS at, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM words, LATERAL (SELECT unnest(range(length(word))) AS i)
), near AS (
  SELECT a.word, b.word AS other FROM shorter a JOIN shorter b ON a.at = b.at AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT s.word, w.word FROM shorter s JOIN words w ON w.word = s.rest
  UNION SELECT w.word, s.word FROM shorter s JOIN words w ON w.word = s.rest
), best AS (
  SELECT near.word, count(*) AS n_near, max(o.n) AS most, arg_min(other, (-o.n, other)) AS other
  FROM near JOIN words o ON o.word = near.other GROUP BY near.word
), forms AS (
  SELECT word, CASE WHEN most >= 10 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN most >= 10 * n THEN most END AS form_n
  FROM words LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c USING (word) JOIN forms e ON e.word = c.root AND e.form IS NULL
"""

MINHASH = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, {_AZ}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS members
  FROM words
), shingles AS (SELECT doc_id, len(members) AS n, unnest(members) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sets
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), least_of AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(members)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least_of USING (doc_id)
"""

SQL: dict[str, str] = {"op11_spelling": SPELLING, "op12_minhash": MINHASH, "op13_merkle": MERKLE}
