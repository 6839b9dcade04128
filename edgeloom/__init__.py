"""Analytics on directed edge lists, written as Spark DataFrame jobs.

An edge list is a DataFrame with two BIGINT columns ``src`` and ``dst``;
``(a, b)`` means that *a follows b*.
"""

from edgeloom.operators.adjacency import adjacency_list, adjacency_set
from edgeloom.operators.degrees import (
    dangling_nodes,
    degree_in_out,
    follower_count,
    out_degree,
)
from edgeloom.operators.edges import (
    distinct_edges,
    max_filter,
    read_up_to,
    reverse_edges,
    rows_without_id,
    tag_inputs,
    weighted_edges,
    write_by_greatest,
)
from edgeloom.operators.pagerank import dangling_trace, pagerank, pagerank_rounds, rank_rounds
from edgeloom.operators.paths import path2_blocks, path2_cardinality, path2_pairs
from edgeloom.operators.triangles import closed_walks, triangle_count, triangle_work
from edgeloom.sources.chains import chain_edges, chain_graph
from edgeloom.sources.text import (
    counted_lines,
    number_lines,
    parse_edges,
    parse_lines,
    parse_rejects,
    read_edge_lines,
    read_edges,
    read_tuples,
    split_by_rows,
    split_lines,
)
from edgeloom.sinks.text import write_delimited, write_tuples

__all__ = [
    "adjacency_list",
    "adjacency_set",
    "chain_edges",
    "chain_graph",
    "closed_walks",
    "counted_lines",
    "dangling_nodes",
    "dangling_trace",
    "degree_in_out",
    "distinct_edges",
    "follower_count",
    "max_filter",
    "number_lines",
    "out_degree",
    "pagerank",
    "pagerank_rounds",
    "parse_edges",
    "parse_lines",
    "parse_rejects",
    "path2_blocks",
    "path2_cardinality",
    "path2_pairs",
    "rank_rounds",
    "read_edge_lines",
    "read_edges",
    "read_tuples",
    "read_up_to",
    "reverse_edges",
    "rows_without_id",
    "split_by_rows",
    "split_lines",
    "tag_inputs",
    "triangle_count",
    "triangle_work",
    "weighted_edges",
    "write_by_greatest",
    "write_delimited",
    "write_tuples",
]
