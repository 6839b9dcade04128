"""The same queries as plain SQL, written directly from their definitions."""

from __future__ import annotations

FOLLOWS = """
follows AS (
  SELECT CAST(l_partkey AS BIGINT) AS src, CAST(l_suppkey AS BIGINT) AS dst
  FROM lineitem WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL)"""

HOPS = """
hops AS (
  SELECT src, dst FROM (
    SELECT lag(user_id) OVER (ORDER BY ts, event_id) AS src, user_id AS dst
    FROM events)
  WHERE src IS NOT NULL)"""

SUPPLY = """
supply AS (
  SELECT o_orderkey * 6 + 5 AS src, o_custkey * 6 + 3 AS dst FROM orders
  UNION ALL
  SELECT c_custkey * 6 + 3, CAST(c_nationkey AS BIGINT) * 6 + 1 FROM customer
  UNION ALL
  SELECT DISTINCT l_partkey * 6 + 4, CAST(l_suppkey AS BIGINT) * 6 + 2 FROM lineitem
  UNION ALL
  SELECT CAST(s_suppkey AS BIGINT) * 6 + 2, CAST(s_nationkey AS BIGINT) * 6 + 1 FROM supplier
  UNION ALL
  SELECT CAST(n_nationkey AS BIGINT) * 6 + 1, CAST(n_regionkey AS BIGINT) * 6 FROM nation)"""

CHAIN = """
chain AS (
  SELECT o_orderkey + 1 AS src,
         CASE WHEN (o_orderkey + 1) % 100 = 0
                OR o_orderkey + 1 = (SELECT max(o_orderkey) + 1 FROM orders)
              THEN CAST(0 AS BIGINT) ELSE o_orderkey + 2 END AS dst
  FROM orders)"""

OPEN_CHAIN = CHAIN + ",\nopen_chain AS (SELECT * FROM chain WHERE dst <> 0)"

LINES = """
lines AS (
  SELECT CASE l_linenumber
           WHEN 2 THEN l_partkey || ',' || l_suppkey || ','
           WHEN 3 THEN l_partkey || ',' || l_suppkey || ',7'
           WHEN 4 THEN l_partkey || ','
           WHEN 5 THEN 'x' || l_partkey || ',' || l_suppkey
           WHEN 6 THEN ''
           ELSE l_partkey || ',' || l_suppkey END AS line
  FROM lineitem),
parsed AS (
  SELECT len(f) AS fields, TRY_CAST(f[1] AS BIGINT) AS src, TRY_CAST(f[2] AS BIGINT) AS dst
  FROM (SELECT string_split(regexp_replace(line, ',+$', ''), ',') AS f FROM lines))"""


def over(graph: str, query: str) -> str:
    return f"WITH {graph.strip()}\n{query.strip()}"


def _rank_rounds(name: str, rounds: int = 10) -> str:
    """PageRank unrolled; each round refers to the one before twice."""
    steps = f""",
links AS (SELECT DISTINCT src, dst FROM {name}),
deg AS MATERIALIZED (SELECT src, CAST(count(*) AS DOUBLE) AS d FROM links GROUP BY src),
nodes AS MATERIALIZED (SELECT src AS node FROM links UNION SELECT dst FROM links),
n AS MATERIALIZED (SELECT CAST(count(*) AS DOUBLE) AS n FROM nodes),
r0 AS MATERIALIZED (SELECT node, 1.0 / (SELECT n FROM n) AS rank FROM nodes)"""
    for i in range(1, rounds + 1):
        p = f"r{i - 1}"
        steps += f""",
d{i} AS MATERIALIZED (
  SELECT coalesce(sum(rank), 0.0) AS held FROM {p}
  WHERE node NOT IN (SELECT src FROM deg)),
r{i} AS MATERIALIZED (
  SELECT nodes.node,
         CAST(0.15 AS DOUBLE) / (SELECT n FROM n) + CAST(0.85 AS DOUBLE) *
           (coalesce(c.s, 0.0) + (SELECT held FROM d{i}) / (SELECT n FROM n)) AS rank
  FROM nodes LEFT JOIN (
    SELECT links.dst, sum({p}.rank / deg.d) AS s
    FROM links JOIN {p} ON links.src = {p}.node JOIN deg ON deg.src = links.src
    GROUP BY links.dst) c ON c.dst = nodes.node)"""
    return steps


def ranks(graph: str, name: str, where: str = "") -> str:
    return over(
        graph + _rank_rounds(name),
        f"SELECT node, round(rank, 10) AS rank FROM r10 {where}",
    )


def trace(graph: str, name: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS iteration, round(held, 12) AS dangling FROM d{i}"
        for i in range(1, 11)
    )
    return over(graph + _rank_rounds(name), rows)


def path2_pairs(where: str) -> str:
    return over(
        HOPS,
        f"""
SELECT a.src AS x, b.dst AS z, count(*) AS paths
FROM hops a JOIN hops b ON a.dst = b.src {where}
GROUP BY a.src, b.dst""",
    )


def path2_cardinality(graph: str, name: str, where: str = "") -> str:
    return over(
        graph,
        f"""
SELECT CAST(coalesce(sum(i.n * o.n), 0) AS BIGINT) AS path2_count
FROM (SELECT dst, count(*) AS n FROM {name} {where} GROUP BY dst) i
JOIN (SELECT src, count(*) AS n FROM {name} {where} GROUP BY src) o ON i.dst = o.src""",
    )


def rounds(graph: str, name: str, last: int) -> str:
    rows = " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS iteration, node, round(CAST(rank AS DOUBLE), 10) AS rank FROM r{i}"
        for i in range(last + 1)
    )
    return over(graph + _rank_rounds(name, last), rows)


def triangles(graph: str, name: str, where: str = "") -> str:
    return over(
        graph
        + f",\ne AS (SELECT DISTINCT src, dst FROM {name} WHERE src <> dst {where})",
        """
SELECT count(*) // 3 AS triangles
FROM e a JOIN e b ON a.dst = b.src JOIN e c ON b.dst = c.src AND c.dst = a.src""",
    )


LOW = "a.src <= 100 AND a.dst <= 100 AND b.src <= 100 AND b.dst <= 100"

PARSED = """
SELECT src, dst FROM parsed
WHERE fields = 2 AND src IS NOT NULL AND dst IS NOT NULL"""

ADJACENCY_SET = """
SELECT src, part, string_agg(CAST(dst AS VARCHAR), ',' ORDER BY dst) AS neighbours, count(*) AS n
FROM parts GROUP BY src, part"""


def _parts(edges: str, n: int) -> str:
    """Edges numbered within their source and cut into parts of ``n``."""
    return f""",
parts AS (
  SELECT *, (row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // {n} AS part
  FROM ({edges}))"""


CLOSED_SEMI = over(
    HOPS,
    """
SELECT count(*) AS hits FROM hops a JOIN hops b ON a.dst = b.src
WHERE a.src <> b.dst
  AND EXISTS (SELECT 1 FROM hops c WHERE c.src = b.dst AND c.dst = a.src)""",
)

CLOSED_SET = over(
    HOPS + ",\ne AS (SELECT DISTINCT src, dst FROM hops)",
    """
SELECT count(*) AS hits
FROM hops a JOIN e b ON a.dst = b.src JOIN e c ON b.dst = c.src AND c.dst = a.src""",
)

ORACLE = {
    "edge_scan": over(FOLLOWS, "SELECT src, dst FROM follows"),
    "edge_scan_hops": over(HOPS, "SELECT src, dst FROM hops"),
    "edge_scan_supply": over(SUPPLY, "SELECT src, dst FROM supply"),
    "edge_parse_lines": over(LINES, PARSED),
    "edge_file_lines": over(LINES, PARSED),
    "edge_rejects": over(
        LINES,
        """
SELECT CASE WHEN fields <> 2 THEN 'field_count' ELSE 'not_a_number' END AS reason,
       count(*) AS n
FROM parsed WHERE fields <> 2 OR src IS NULL OR dst IS NULL GROUP BY reason""",
    ),
    "multi_input_tagged": over(
        FOLLOWS,
        """
SELECT src, dst, 'Original' AS tag FROM follows
UNION ALL SELECT dst, src, 'New' FROM follows""",
    ),
    "max_filter": over(
        FOLLOWS, "SELECT src, dst FROM follows WHERE src <= 100 AND dst <= 100"
    ),
    "max_filter_hops": over(
        HOPS, "SELECT src, dst FROM hops WHERE src <= 100 AND dst <= 100"
    ),
    "reverse_edges": over(FOLLOWS, "SELECT dst AS src, src AS dst FROM follows"),
    "follower_count": over(
        FOLLOWS, "SELECT dst AS node, count(*) AS followers FROM follows GROUP BY dst"
    ),
    "follower_count_hops": over(
        HOPS, "SELECT dst AS node, count(*) AS followers FROM hops GROUP BY dst"
    ),
    "out_degree": over(
        FOLLOWS, "SELECT src AS node, count(*) AS out_deg FROM follows GROUP BY src"
    ),
    "degree_in_out": over(
        FOLLOWS,
        """
SELECT node, CAST(sum(i) AS BIGINT) AS in_deg, CAST(sum(o) AS BIGINT) AS out_deg
FROM (SELECT dst AS node, 1 AS i, 0 AS o FROM follows
      UNION ALL SELECT src, 0, 1 FROM follows)
GROUP BY node""",
    ),
    "distinct_edges": over(HOPS, "SELECT DISTINCT src, dst FROM hops"),
    "path2_cardinality": path2_cardinality(FOLLOWS, "follows"),
    "path2_cardinality_hops": path2_cardinality(HOPS, "hops"),
    "path2_cardinality_max": path2_cardinality(
        FOLLOWS, "follows", "WHERE src <= 100 AND dst <= 100"
    ),
    "path2_pairs_max": path2_pairs(f"AND a.src <> b.dst AND {LOW}"),
    "path2_pairs": path2_pairs("AND a.src <> b.dst"),
    "path2_pairs_all": path2_pairs(""),
    "path2_pairs_broadcast": path2_pairs(""),
    "path2_pairs_slabs": path2_pairs("AND a.src <> b.dst"),
    "path2_pairs_blocks": path2_pairs("AND a.src <> b.dst"),
    "max_filter_layout": over(FOLLOWS, "SELECT src, dst FROM follows WHERE src <= 100 AND dst <= 100"),
    "closed_walks_hops": over(
        HOPS,
        """
SELECT count(*) AS hits
FROM hops a JOIN hops b ON a.dst = b.src JOIN hops c ON b.dst = c.src AND c.dst = a.src""",
    ),
    "closed_walks_semi_hops": CLOSED_SEMI,
    "closed_walks_semi_intersect": CLOSED_SEMI,
    "closed_walks_set_hops": CLOSED_SET,
    "closed_walks_set_intersect": CLOSED_SET,
    "triangle_count": triangles(FOLLOWS, "follows"),
    "triangle_count_hops": triangles(HOPS, "hops"),
    "triangle_count_broadcast": triangles(HOPS, "hops"),
    "triangle_count_partition": triangles(HOPS, "hops"),
    "triangle_count_intersect": triangles(HOPS, "hops"),
    "triangle_count_max": triangles(HOPS, "hops", "AND src <= 100 AND dst <= 100"),
    "adjacency_list": over(
        HOPS + _parts("SELECT src, dst, count(*) AS m FROM hops GROUP BY src, dst", 1_000_000),
        """
SELECT src, part, string_agg(CAST(dst AS VARCHAR), ',' ORDER BY dst) AS neighbours,
       string_agg(CAST(m AS VARCHAR), ',' ORDER BY dst) AS copies, CAST(sum(m) AS BIGINT) AS n
FROM parts GROUP BY src, part""",
    ),
    "adjacency_set": over(
        HOPS + _parts("SELECT DISTINCT src, dst FROM hops", 1_000_000), ADJACENCY_SET
    ),
    "adjacency_set_split": over(
        HOPS + _parts("SELECT DISTINCT src, dst FROM hops", 50), ADJACENCY_SET
    ),
    "dangling_nodes": over(
        SUPPLY,
        """SELECT DISTINCT dst AS node FROM supply
WHERE dst NOT IN (SELECT src FROM supply)""",
    ),
    "pagerank": ranks(SUPPLY, "supply"),
    "pagerank_hops": ranks(HOPS, "hops"),
    "pagerank_dangling_trace": trace(SUPPLY, "supply"),
    "pagerank_rounds": rounds(SUPPLY, "supply", 3),
    "pagerank_low_ids": ranks(SUPPLY, "supply", "WHERE node <= 100"),
    "chain_graph": over(CHAIN, "SELECT src, dst FROM chain"),
    "pagerank_chain": ranks(OPEN_CHAIN, "open_chain"),
    "path2_csv_roundtrip": path2_pairs("AND a.src <> b.dst"),
    "path2_max_csv_roundtrip": path2_pairs(f"AND a.src <> b.dst AND {LOW}"),
    "edges_split_by_rows": over(
        FOLLOWS, "SELECT CAST(ceil(count(*) / 1000) AS BIGINT) AS parts, count(*) AS n FROM follows"
    ),
    "edge_rows_without_id": """
SELECT count(*) AS n,
       count(*) FILTER (l_partkey IS NULL OR l_suppkey IS NULL) AS without_id FROM lineitem""",
    "edge_read_lines": over(LINES, PARSED),
    "edge_read_counts": over(
        LINES,
        """
SELECT count(*) AS lines, count(*) FILTER (fields <> 2) AS field_count,
       count(*) FILTER (fields = 2 AND (src IS NULL OR dst IS NULL)) AS not_a_number,
       count(*) FILTER (fields = 2 AND greatest(src, dst) > 100 AND src IS NOT NULL AND dst IS NOT NULL)
         AS above_max,
       count(*) FILTER (fields = 2 AND src <= 100 AND dst <= 100) AS edges
FROM parsed""",
    ),
    "edge_line_parts": over(
        FOLLOWS,
        """
SELECT (pos - 1) // 1000 AS part, min(pos) AS first, max(pos) AS last, count(*) AS n
FROM (SELECT row_number() OVER () AS pos FROM follows) GROUP BY part""",
    ),
    "followers_text_order": over(
        FOLLOWS,
        """
SELECT row_number() OVER (ORDER BY CAST(dst AS VARCHAR)) AS pos, dst AS node, count(*) AS followers
FROM follows GROUP BY dst""",
    ),
    "edges_tsv_roundtrip": over(HOPS, "SELECT src, dst FROM hops"),
    "edges_space_roundtrip": over(FOLLOWS, "SELECT src, dst FROM follows"),
    "followers_csv_roundtrip": over(
        FOLLOWS, "SELECT dst AS node, count(*) AS followers FROM follows GROUP BY dst"
    ),
    "ranks_text_roundtrip": ranks(SUPPLY, "supply"),
}
