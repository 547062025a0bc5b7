"""SQL of the queries that SQL can express, over the same whole tables."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

#: Sets of shingles, all pairs of equal shingles, links, and the smallest document that each one reaches.
_NEAR_DUP = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
grams AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS g
  FROM words),
sizes AS (SELECT doc_id, len(g) AS n FROM grams),
flat AS (SELECT doc_id, unnest(g) AS gram FROM grams),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM flat x JOIN flat y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 100 * k >= 80 * (s.n + t.n - k)),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, b AS other FROM ways UNION SELECT r.doc_id, t.b FROM reach r JOIN ways t ON t.a = r.other),
least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY 1)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(l.other, s.doc_id)) AS component_id,
  s.doc_id = least(s.doc_id, coalesce(l.other, s.doc_id)) AS kept
FROM sizes s LEFT JOIN least l ON l.doc_id = s.doc_id
"""

#: All products of whole-number components, over pairs of equal length.
_TOP_PRODUCTS = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
flat AS (SELECT vec_id, len(v) AS dim, unnest(v) AS x, unnest(range(len(v))) AS at FROM usable),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score FROM flat q
  JOIN flat c ON q.at = c.at AND q.dim = c.dim AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY 1, 2),
ordered AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ordered WHERE rank <= 5
"""

#: CRC-32 bit by bit: a byte is laid over the register, which is then shifted eight times (-1 stands for a shift).
_CRC32 = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split({0}, ''),
    lambda d: list_concat([ord(d)], [-1, -1, -1, -1, -1, -1, -1, -1])))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)"""

#: Prefixes as lists of turns; a subtree is all nodes whose list begins with the node's own.
_PREFIX_TRIE = f"""
WITH turns AS (
  SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS w
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
ids AS (SELECT *, CAST({_CRC32.format("CAST(conv_id AS VARCHAR)")} % 9 AS BIGINT) AS h FROM turns),
made AS (
  SELECT c.conv_id, list_concat(coalesce(b.w, [])[1:c.h], c.w[c.h + 1:]) AS w
  FROM ids c LEFT JOIN ids b ON b.conv_id = c.conv_id - c.conv_id % 5),
members AS (SELECT conv_id, w[1:d] AS path, d AS depth, d = len(w) AS at_end FROM (SELECT *, unnest(range(len(w) + 1)) AS d FROM made)),
nodes AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (at_end), '')) AS ends_sha256
  FROM members GROUP BY 1, 2),
children AS (SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
whole AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children, p.conv_id AS parent_conv_id,
    CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * octet_length(encode(n.path[n.depth].t)) END AS saved
  FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.path = n.path
  LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]),
below AS (
  SELECT a.depth, a.path, sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END) AS leaves, sum(b.saved) AS saved
  FROM whole b, unnest(range(b.depth + 1)) AS u(d) JOIN whole a ON a.depth = u.d AND a.path = b.path[1:u.d] GROUP BY 1, 2)
SELECT w.conv_id, w.depth, w.parent_conv_id, w.n_convs, CAST(w.n_children AS BIGINT) AS n_children,
  CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, w.ends_sha256
FROM whole w JOIN below b ON b.depth = w.depth AND b.path = w.path
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_RANKED = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS place, {_TERMS} AS w FROM documents),
sizes AS (SELECT place, len(w) AS n FROM docs WHERE len(w) > 0),
totals AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM sizes),
tf AS (SELECT place, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT place, unnest(w) AS term FROM docs) GROUP BY 1, 2),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY 1), totals),
items AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE item_id IS NOT NULL),
scored AS (
  SELECT i.item_id, d.doc_id, d.place, CAST(sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 20 * (50 + (50 * s.n * big_n) // big_l)))) AS BIGINT) AS score
  FROM items i JOIN weights w USING (term) JOIN tf t USING (term) JOIN sizes s USING (place) JOIN docs d USING (place), totals
  WHERE d.doc_id IS NOT NULL GROUP BY 1, 2, 3),
ordered AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ordered WHERE rank <= 50
"""

ORACLES = {"op7_near_dup": _NEAR_DUP, "op11_threshold": _TOP_PRODUCTS, "op12_prefix_trie": _PREFIX_TRIE, "op13_ranked": _RANKED}
