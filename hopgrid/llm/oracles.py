"""Comparison SQL of the longer queries of this folder."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """crc32 of a non-empty ASCII text, bit by bit."""
    step = "CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END"
    byte = f"list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda x, k: {step})"
    codes = f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::UBIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda c, b: {byte}), 4294967295::UBIGINT)"


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR)::VARCHAR || ':' || ({value})::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def _levels(name: str, base: str) -> str:
    """All nodes over the leaves of ``base`` (tree, place, digest), and for each its neighbours in the run."""
    return f"""
{name}(tree, level, place, digest, n) AS (
  SELECT tree, 0, place, digest, count(*) OVER (PARTITION BY tree) FROM {base}
  UNION ALL
  SELECT tree, level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 2) // 3
  FROM {name} WHERE n > 1 GROUP BY tree, level, place // 3),
{name}_steps AS (
  SELECT a.tree, a.level, a.place,
    coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS r
  FROM {name} a JOIN {name} b ON a.tree = b.tree AND a.level = b.level AND a.place // 3 = b.place // 3
  WHERE a.n > 1 GROUP BY a.tree, a.level, a.place)"""


OP12_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, {_leaf('text')} AS leaf,
    CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS presented,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS place
  FROM documents),
own AS (SELECT tree, place, leaf AS digest FROM docs),
{_levels('nodes', 'own')},
tops AS (SELECT 0 AS tree, tree AS place, digest FROM nodes WHERE n = 1),
{_levels('over', 'tops')},
walk(row_id, tree, level, place, digest, others) AS (
  SELECT row_id, tree, 0, place, presented, '' FROM docs
  UNION ALL
  SELECT w.row_id, w.tree, w.level + 1, w.place // 3, sha256(s.l || w.digest || s.r), w.others || s.l || s.r
  FROM walk w JOIN nodes_steps s ON w.tree = s.tree AND w.level = s.level AND w.place = s.place),
climb(row_id, tree, level, place, digest, others) AS (
  SELECT row_id, 0, 0, tree, arg_max(digest, level), arg_max(others, level) FROM walk GROUP BY row_id, tree
  UNION ALL
  SELECT w.row_id, w.tree, w.level + 1, w.place // 3, sha256(s.l || w.digest || s.r), w.others || s.l || s.r
  FROM climb w JOIN over_steps s ON w.tree = s.tree AND w.level = s.level AND w.place = s.place),
folded AS (SELECT row_id, arg_max(digest, level) AS folded_root, sha256(arg_max(others, level)) AS proof_sha256 FROM climb GROUP BY row_id)
SELECT d.doc_id, d.leaf, t.digest AS subroot, r.digest AS root, f.proof_sha256, f.folded_root, f.folded_root = r.digest AS verified
FROM docs d JOIN folded f USING (row_id) JOIN tops t ON d.tree = t.place CROSS JOIN (SELECT digest FROM over WHERE n = 1) r
"""


OP11_SQL = f"""
WITH turns AS (
  SELECT conv_id AS c, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS k FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list(t ORDER BY k) AS ts, {crc32_sql("c::VARCHAR")} % 6 AS h FROM turns GROUP BY c),
built AS (
  SELECT a.c, list_concat(coalesce(b.ts[1:a.h], []), a.ts[a.h + 1:]) AS ts FROM own a LEFT JOIN own b ON b.c = a.c - a.c % 100),
paths AS (SELECT c, len(ts) AS n, unnest(range(0, len(ts) + 1)) AS d, ts FROM built),
nodes AS (
  SELECT d, md5(ts[1:d]::VARCHAR || '#' || to_json(ts[1:d])::VARCHAR) AS node, min(c) AS conv_id, count(*) AS n_convs,
    CASE WHEN d = 0 THEN 0 ELSE any_value(length(ts[d].text)) END AS last_tokens, any_value(ts[1:d]) AS prefix,
    CASE WHEN d = 0 THEN NULL ELSE any_value(md5(ts[1:d - 1]::VARCHAR || '#' || to_json(ts[1:d - 1])::VARCHAR)) END AS parent,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256
  FROM paths GROUP BY d, node),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (node)),
below AS (
  SELECT a.node, count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.last_tokens) AS saved_tokens
  FROM full_nodes a JOIN full_nodes b ON b.d >= a.d AND b.prefix[1:a.d] = a.prefix GROUP BY a.node)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves::BIGINT AS n_leaves,
  b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN below b USING (node) LEFT JOIN full_nodes p ON n.parent = p.node
"""
