"""DuckDB SQL for the queries of this subpackage that SQL can express in full."""

from __future__ import annotations

#: Unicode whitespace as the inside of a character class; the regular expressions of DuckDB know only the ASCII part.
_WS = r"\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def _fold(c: str) -> str:
    return f"lower(trim(regexp_replace({c}, '[{_WS}]+', ' ', 'g')))"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^[{_WS}]+|[{_WS}]+$', '', 'g')"


_ABSENT = "('', 'unknown', 'n/a', 'none', 'null')"

P1_FOUND = rf"""
WITH c AS (SELECT content_id, content, len(regexp_extract_all(content, '[^{_WS}]+')) AS n FROM article_content),
big AS (SELECT * FROM c WHERE n > 2500),
par AS (SELECT content_id, list_filter(regexp_split_to_array(content, '\n[{_WS}]*\n'), lambda p: regexp_matches(p, '[^{_WS}]')) AS ps FROM big),
one AS (SELECT content_id, ps, unnest(range(1, len(ps) + 1)) AS k FROM par)
SELECT content_id, CAST(0 AS INTEGER) AS paragraph_no FROM big
UNION ALL
SELECT content_id, CAST(k AS INTEGER) FROM one WHERE len(regexp_extract_all(ps[k], '[^{_WS}]+')) > 2500
"""

_P2 = f"""
WITH RECURSIVE named AS (
  SELECT DISTINCT node_id, {_fold('n')} AS k
  FROM (SELECT node_id, unnest(list_concat([standard_name], coalesce(aliases, []))) AS n FROM global_network_nodes)
), usable AS (
  SELECT * FROM named WHERE k IS NOT NULL AND k NOT IN {_ABSENT}
    AND k NOT IN (SELECT {_fold('name')} FROM generic_names WHERE name IS NOT NULL)
), star AS (
  SELECT node_id AS a, min(node_id) OVER (PARTITION BY k) AS b FROM usable
), link AS (
  SELECT a, b FROM star WHERE a <> b
  UNION SELECT left_id, right_id FROM name_matches WHERE verdict = 'same'
    AND left_id IN (SELECT node_id FROM global_network_nodes) AND right_id IN (SELECT node_id FROM global_network_nodes)
), both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (
  SELECT node_id, node_id AS r FROM (SELECT DISTINCT node_id FROM global_network_nodes)
  UNION
  SELECT e.b, r.r FROM reach r JOIN both_ways e ON e.a = r.node_id
), grp AS (SELECT node_id, min(r) AS group_id FROM reach GROUP BY node_id)
"""
P2_GROUPS = _P2 + "SELECT node_id, group_id FROM grp"
P2_FOUND = _P2 + "SELECT node_id, group_id FROM grp WHERE group_id IN (SELECT group_id FROM grp GROUP BY group_id HAVING count(*) > 1)"

_P4 = f"""
WITH e AS (
  SELECT *, {_fold('source')} AS s, {_fold('target')} AS t, {_strip('context')} AS ctx, lower({_strip('relationship')}) AS rel,
    {_strip('time_period')} AS tp,
    list_max(list_concat(
      list_transform(regexp_extract_all(regexp_replace(time_period, '[0-9]{{5,}}', ' ', 'g'), '((1[0-9]{{3}}|20[0-9]{{2}})s?)', 1), lambda y: CASE WHEN y LIKE '%0s' THEN CAST(left(y, 4) AS INT) + 9 ELSE CAST(left(y, 4) AS INT) END),
      list_transform(regexp_extract_all(time_period, '((?:1[0-9]|20)[0-9]{{2}}\\s*[-–—]\\s*(?:1[3-9]|[2-9][0-9]))(?:$|[^0-9-])', 1), lambda m: CAST(left(m, 2) || right(m, 2) AS INT)))) AS stated
  FROM global_network_edges
), p AS (
  SELECT *, least(s, t) AS name_a, greatest(s, t) AS name_b,
    CASE WHEN stated IS NOT NULL AND regexp_matches(tp, '(?i)\\b(since|present|ongoing|onwards?|now|today|currently?|active|still|date)\\b|[0-9]s?\\s*[-–—]\\s*\\??$|\\bfrom\\s+\\S*[0-9]{{4}}s?$')
      AND NOT regexp_matches(tp, '(?i)\\b(inactive|defunct|dissolved|disbanded|ended|ceased|extinct|former|formerly)\\b')
      AND NOT (regexp_matches(tp, '(?i)\\b(until|till|through)\\b') AND NOT regexp_matches(tp, '(?i)\\b(until|till|through)\\W+(the\\W+)?(present|now|today|current)')) THEN 9999 ELSE stated END AS y,
    CASE lower(trim(evidence)) WHEN 'own_source' THEN 3 WHEN 'mentioned_in' THEN 2 WHEN 'name_only' THEN 1 ELSE 0 END AS st
  FROM e WHERE s <> '' AND t <> '' AND s <> t
), r AS (
  SELECT *,
    row_number() OVER (PARTITION BY name_a, name_b ORDER BY y DESC NULLS LAST, edge_id) AS ry,
    row_number() OVER (PARTITION BY name_a, name_b ORDER BY (ctx IS NOT NULL AND lower(ctx) NOT IN {_ABSENT}) DESC, length(ctx) DESC NULLS LAST, edge_id) AS rc,
    row_number() OVER (PARTITION BY name_a, name_b ORDER BY coalesce(rel IN ('alliance', 'rivalry', 'other'), false) DESC, st DESC, merged_at DESC NULLS LAST, edge_id) AS rr
  FROM p
), g AS (
  SELECT name_a, name_b, min(edge_id) AS group_id, count(*) AS n_rows,
    max(CASE WHEN ry = 1 AND y IS NOT NULL THEN time_period END) AS time_period, coalesce(max(CASE WHEN ry = 1 AND y IS NOT NULL THEN edge_id END), 0) AS time_period_id,
    max(CASE WHEN rc = 1 AND ctx IS NOT NULL AND lower(ctx) NOT IN {_ABSENT} THEN ctx END) AS context,
    coalesce(max(CASE WHEN rc = 1 AND ctx IS NOT NULL AND lower(ctx) NOT IN {_ABSENT} THEN edge_id END), 0) AS context_id,
    max(CASE WHEN rr = 1 AND rel IN ('alliance', 'rivalry', 'other') THEN rel END) AS relationship,
    coalesce(max(CASE WHEN rr = 1 AND rel IN ('alliance', 'rivalry', 'other') THEN edge_id END), 0) AS relationship_id
  FROM r GROUP BY name_a, name_b
)
""".replace("\\\\", "\\")
P4_RECORDS = _P4 + "SELECT name_a, name_b, group_id, n_rows, time_period, time_period_id, context, context_id, relationship, relationship_id FROM g"
P4_FOUND = _P4 + "SELECT group_id, time_period_id AS time_period_edge_id, context_id AS context_edge_id, relationship_id AS relationship_edge_id FROM g WHERE n_rows > 1"

SQL = {"p1_found": P1_FOUND, "p2_groups": P2_GROUPS, "p2_found": P2_FOUND, "p4_records": P4_RECORDS, "p4_found": P4_FOUND}

_P8 = """
WITH d AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE length(text) >= 400),
w AS (SELECT doc_id, s, md5(substr(text, s, 400)) AS h FROM (SELECT doc_id, text, unnest(range(1, n - 400 + 2)) AS s FROM d)),
r AS (SELECT h FROM w GROUP BY h HAVING min(doc_id) < max(doc_id)),
m AS (SELECT doc_id, s, h FROM w WHERE h IN (SELECT h FROM r))
"""
SQL["p8_found"] = _P8 + "SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM m a JOIN m b ON a.h = b.h AND a.doc_id < b.doc_id"
SQL["p8_shares"] = _P8 + """,
g AS (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS p FROM m),
o AS (SELECT doc_id, sum(CASE WHEN p IS NULL OR s > p + 400 THEN 1 ELSE 0 END) AS n_stretches,
  sum(CASE WHEN p IS NULL OR s > p + 400 THEN 400 ELSE s - p END) AS shared_chars FROM g GROUP BY doc_id)
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, CAST(coalesce(n_stretches, 0) AS BIGINT) AS n_stretches,
  CAST(coalesce(shared_chars, 0) AS BIGINT) AS shared_chars,
  CASE WHEN length(text) > 0 THEN round(coalesce(shared_chars, 0) / length(text), 6) ELSE 0.0 END AS share
FROM documents LEFT JOIN o USING (doc_id) WHERE text IS NOT NULL
"""

# tokens are out of SQL's reach; the margins of the table hold for characters as well
SQL["p7_found"] = """
WITH s AS (SELECT source, sum(length(text)) AS n FROM documents GROUP BY source), t AS (SELECT sum(length(text)) AS n FROM documents),
g AS (SELECT source, sum(target_share) AS target_share, max(max_repeats) AS max_repeats FROM source_targets GROUP BY source)
SELECT g.source FROM g LEFT JOIN s USING (source), t WHERE g.target_share * t.n > g.max_repeats * coalesce(s.n, 0)
"""

SQL["p6_found"] = """
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(nfc_normalize(text)), '[\\p{L}\\p{N}]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(lower(nfc_normalize(text)), '[\\p{L}\\p{N}]+') AS w FROM eval_items),
dg AS (SELECT doc_id, hash(array_to_string(w[s : s + 11], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS s FROM dw)),
ig AS (SELECT item_id, hash(array_to_string(w[s : s + 11], ' ')) AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS s FROM iw))
SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)
"""
