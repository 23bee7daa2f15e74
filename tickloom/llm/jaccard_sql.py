"""Groups of documents by the similarity of their shingle sets, in plain SQL: all pairs that share a shingle."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def components_sql(size: int, num: int, den: int) -> str:
    """doc_id, n_shingles, component_id of every row of `documents`."""
    shifted = ", ".join(["w", *(f"w[{i + 1} :]" for i in range(1, size))])
    joined = " || ' ' || ".join(f"z[{i + 1}]" for i in range(size))
    return f"""WITH RECURSIVE worded AS (SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
      docs AS MATERIALIZED (SELECT r, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN []
          WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
          ELSE list_transform(list_zip({shifted}, true), lambda z: {joined}) END)) AS s FROM worded),
      named AS MATERIALIZED (SELECT r, doc_id, len(s) AS n, CASE WHEN len(s) > 0 THEN min(r) OVER (PARTITION BY s) END AS node, s FROM docs),
      items AS MATERIALIZED (SELECT node, n, unnest(s) AS x FROM named WHERE node = r),
      edges AS MATERIALIZED (SELECT a.node AS a, b.node AS b FROM items a JOIN items b ON a.x = b.x AND a.node < b.node
        AND {den} * least(a.n, b.n) >= {num} * greatest(a.n, b.n)
        GROUP BY a.node, b.node, a.n, b.n HAVING {den} * count(*) >= {num} * (a.n + b.n - count(*))),
      both_ways AS (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges),
      reach AS (SELECT DISTINCT a AS node, a AS label FROM both_ways UNION SELECT e.b, r.label FROM reach r JOIN both_ways e ON e.a = r.node),
      labels AS (SELECT node, min(label) AS label FROM reach GROUP BY node),
      grouped AS (SELECT doc_id, n, node, coalesce(label, node) AS label FROM named LEFT JOIN labels USING (node))
      SELECT doc_id, n AS n_shingles, CASE WHEN node IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY label) END AS component_id FROM grouped"""


OP8_SQL = components_sql(3, 90, 100)
OP12_SQL = f"SELECT *, doc_id IS NOT DISTINCT FROM component_id AS kept FROM ({components_sql(2, 80, 100)})"
