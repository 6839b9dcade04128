"""The registered queries. Each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import edgeloom as el
from edgeloom.plans import graphs as g
from edgeloom.storage import keep, new_path

MAX_ID = 100
CHAIN_LENGTH = 100
SPLIT_LENGTH = 50
SPLIT_ROWS = 1000
EDGES_PER_TRIPLE = 20_000
SLAB_ROWS = 50_000
PAIRS_PER_BLOCK = 2**20
ROWS_PER_FILE = 100_000
ROUNDS = 3


def edge_scan(spark, sf_dir):
    return g.follows(spark, sf_dir)


def edge_scan_hops(spark, sf_dir):
    return g.hops(spark, sf_dir)


def edge_scan_supply(spark, sf_dir):
    return g.supply(spark, sf_dir)


def edge_parse_lines(spark, sf_dir):
    return el.parse_edges(g.edge_lines(spark, sf_dir))


def edge_file_lines(spark, sf_dir):
    path = new_path(spark, "edge_lines")
    g.edge_lines(spark, sf_dir).write.text(path)
    edges, _ = el.read_edge_lines(spark, path)
    return edges


def edge_rejects(spark, sf_dir):
    rejects = el.parse_rejects(g.edge_lines(spark, sf_dir))
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def multi_input_tagged(spark, sf_dir):
    edges = g.follows(spark, sf_dir)
    return el.tag_inputs(Original=edges, New=el.reverse_edges(edges))


def max_filter(spark, sf_dir):
    return el.max_filter(g.follows(spark, sf_dir), MAX_ID)


def max_filter_hops(spark, sf_dir):
    return el.max_filter(g.hops(spark, sf_dir), MAX_ID)


def max_filter_layout(spark, sf_dir):
    """The filter over a table in the order of the greater id, which is read in part."""
    path = new_path(spark, "by_greatest")
    el.write_by_greatest(g.follows(spark, sf_dir), path, ROWS_PER_FILE)
    return el.read_up_to(spark, path, MAX_ID)


def reverse_edges(spark, sf_dir):
    return el.reverse_edges(g.follows(spark, sf_dir))


def follower_count(spark, sf_dir):
    return el.follower_count(g.follows(spark, sf_dir))


def follower_count_hops(spark, sf_dir):
    return el.follower_count(g.hops(spark, sf_dir))


def out_degree(spark, sf_dir):
    return el.out_degree(g.follows(spark, sf_dir))


def degree_in_out(spark, sf_dir):
    return el.degree_in_out(g.follows(spark, sf_dir))


def distinct_edges(spark, sf_dir):
    return el.distinct_edges(g.hops(spark, sf_dir))


def _bigint(df: DataFrame) -> DataFrame:
    """Exact decimal totals as BIGINT, the type of the SQL."""
    return df.select(*(F.col(c).cast("bigint").alias(c) for c in df.columns))


def path2_cardinality(spark, sf_dir):
    return _bigint(el.path2_cardinality(g.follows(spark, sf_dir)))


def path2_cardinality_hops(spark, sf_dir):
    return _bigint(el.path2_cardinality(g.hops(spark, sf_dir)))


def path2_cardinality_max(spark, sf_dir):
    return _bigint(el.path2_cardinality(g.follows(spark, sf_dir), max_id=MAX_ID))


def path2_pairs_max(spark, sf_dir):
    """The listing behind the filter of ids, which bounds the pairs at any size."""
    return el.path2_pairs(g.hops(spark, sf_dir), max_id=MAX_ID)


def path2_pairs(spark, sf_dir):
    return el.path2_pairs(g.hops(spark, sf_dir))


def path2_pairs_all(spark, sf_dir):
    return el.path2_pairs(g.hops(spark, sf_dir), keep_returns=True)


def path2_pairs_broadcast(spark, sf_dir):
    return el.path2_pairs(g.hops(spark, sf_dir), keep_returns=True, strategy="broadcast")


def path2_pairs_slabs(spark, sf_dir):
    return el.path2_pairs(g.hops(spark, sf_dir), strategy="slabs", max_broadcast_rows=SLAB_ROWS)


def path2_pairs_blocks(spark, sf_dir):
    """The listing in blocks of a bounded number of pairs, each written on its own."""
    blocks = el.path2_blocks(g.hops(spark, sf_dir), pairs_per_block=PAIRS_PER_BLOCK)
    return blocks.drop("block")


def closed_walks_hops(spark, sf_dir):
    return _bigint(el.closed_walks(g.hops(spark, sf_dir), "all"))


def closed_walks_semi_hops(spark, sf_dir):
    return _bigint(el.closed_walks(g.hops(spark, sf_dir), "semi"))


def closed_walks_set_hops(spark, sf_dir):
    return _bigint(el.closed_walks(g.hops(spark, sf_dir), "set"))


def triangle_count(spark, sf_dir):
    return el.triangle_count(g.follows(spark, sf_dir))


def triangle_count_hops(spark, sf_dir):
    return el.triangle_count(g.hops(spark, sf_dir))


def triangle_count_broadcast(spark, sf_dir):
    return el.triangle_count(g.hops(spark, sf_dir), strategy="broadcast")


def triangle_count_partition(spark, sf_dir):
    """By triples of node classes; small subgraphs, so that there are several classes at any size."""
    return el.triangle_count(
        g.hops(spark, sf_dir), strategy="partition", edges_per_task=EDGES_PER_TRIPLE
    )


def triangle_count_intersect(spark, sf_dir):
    return el.triangle_count(g.hops(spark, sf_dir), strategy="intersect")


def closed_walks_set_intersect(spark, sf_dir):
    """By neighbour sets in parts of ``SPLIT_LENGTH``."""
    edges = g.hops(spark, sf_dir)
    return _bigint(el.closed_walks(edges, "set", strategy="intersect", max_len=SPLIT_LENGTH))


def closed_walks_semi_intersect(spark, sf_dir):
    return _bigint(el.closed_walks(g.hops(spark, sf_dir), "semi", strategy="intersect"))


def triangle_count_max(spark, sf_dir):
    return el.triangle_count(g.hops(spark, sf_dir), max_id=MAX_ID)


def _arrays_as_text(df: DataFrame) -> DataFrame:
    """Arrays as comma-separated text, which every engine compares alike."""
    return df.select(
        *(
            F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
            if t.startswith("array")
            else F.col(c)
            for c, t in df.dtypes
        )
    )


def adjacency_list(spark, sf_dir):
    return _arrays_as_text(el.adjacency_list(g.hops(spark, sf_dir)))


def adjacency_set(spark, sf_dir):
    return _arrays_as_text(el.adjacency_set(g.hops(spark, sf_dir)))


def adjacency_set_split(spark, sf_dir):
    return _arrays_as_text(el.adjacency_set(g.hops(spark, sf_dir), SPLIT_LENGTH))


def dangling_nodes(spark, sf_dir):
    return el.dangling_nodes(g.supply(spark, sf_dir))


def _rounded(ranks: DataFrame) -> DataFrame:
    return ranks.select("node", F.round("rank", 10).alias("rank"))


def pagerank(spark, sf_dir):
    return _rounded(el.pagerank(g.supply(spark, sf_dir)))


def pagerank_hops(spark, sf_dir):
    return _rounded(el.pagerank(g.hops(spark, sf_dir)))


def pagerank_dangling_trace(spark, sf_dir):
    return el.dangling_trace(g.supply(spark, sf_dir)).select(
        "iteration", F.round("dangling", 12).alias("dangling")
    )


def pagerank_rounds(spark, sf_dir):
    """Start ranks and the table of each round."""
    tables = el.pagerank_rounds(g.supply(spark, sf_dir), ROUNDS)
    numbered = [
        _rounded(ranks).withColumn("iteration", F.lit(i).cast("bigint"))
        for i, ranks in enumerate(tables)
    ]
    return functools.reduce(DataFrame.unionByName, numbered)


def pagerank_low_ids(spark, sf_dir):
    return pagerank(spark, sf_dir).where(F.col("node") <= MAX_ID)


def chain_graph(spark, sf_dir):
    return el.chain_edges(g.order_chain(spark, sf_dir), CHAIN_LENGTH)


def pagerank_chain(spark, sf_dir):
    nodes = g.order_chain(spark, sf_dir)
    return _rounded(el.pagerank(el.chain_edges(nodes, CHAIN_LENGTH, sentinel=False)))


def path2_csv_roundtrip(spark, sf_dir):
    path = new_path(spark, "path2_csv")
    el.write_delimited(path2_pairs(spark, sf_dir), path)
    return spark.read.schema("x BIGINT, z BIGINT, paths BIGINT").csv(path)


def path2_max_csv_roundtrip(spark, sf_dir):
    path = new_path(spark, "path2_csv")
    el.write_delimited(path2_pairs_max(spark, sf_dir), path)
    return spark.read.schema("x BIGINT, z BIGINT, paths BIGINT").csv(path)


def edge_read_lines(spark, sf_dir):
    """Well-formed and malformed lines in a file, through the plain reader."""
    path = new_path(spark, "edge_lines")
    g.edge_lines(spark, sf_dir).write.text(path)
    return el.read_edges(spark, path)


def edge_read_counts(spark, sf_dir):
    """What reading counted on its way: the numbers come with the job that writes the edges."""
    path = new_path(spark, "edge_lines")
    g.edge_lines(spark, sf_dir).write.text(path)
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    counted, seen = el.counted_lines(el.parse_lines(lines), MAX_ID)
    keep(el.max_filter(counted.where("reason IS NULL").select("src", "dst"), MAX_ID), "edges")
    names = ("lines", "field_count", "not_a_number", "above_max", "edges")
    return spark.createDataFrame([[seen.get[n] for n in names]], ", ".join(f"{n} BIGINT" for n in names))


def edge_line_parts(spark, sf_dir):
    """Parts of an exact number of lines: first and last line and number of each."""
    path = new_path(spark, "edges_text")
    el.write_delimited(g.follows(spark, sf_dir), path)
    parts = el.split_lines(spark, path, SPLIT_ROWS)
    return parts.groupBy("part").agg(
        F.min("pos").alias("first"), F.max("pos").alias("last"), F.countDistinct("pos").alias("n")
    )


def edge_rows_without_id(spark, sf_dir):
    return el.rows_without_id(g.table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


def edges_split_by_rows(spark, sf_dir):
    """Number of parts with rows, and rows in all."""
    parts = el.split_by_rows(g.follows(spark, sf_dir), SPLIT_ROWS)
    sizes = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"))


def followers_text_order(spark, sf_dir):
    """Follower counts written in text order, with the number of each line."""
    path = new_path(spark, "followers_ordered")
    el.write_delimited(follower_count(spark, sf_dir), path, text_order=True)
    return el.number_lines(spark.read.schema("node BIGINT, followers BIGINT").csv(path))


def _edges_roundtrip(spark: SparkSession, edges: DataFrame, sep: str) -> DataFrame:
    path = new_path(spark, "edges_text")
    el.write_delimited(edges, path, sep, text_order=True)
    return el.read_edges(spark, path, sep)


def edges_tsv_roundtrip(spark, sf_dir):
    return _edges_roundtrip(spark, g.hops(spark, sf_dir), "\t")


def edges_space_roundtrip(spark, sf_dir):
    return _edges_roundtrip(spark, g.follows(spark, sf_dir), " ")


def followers_csv_roundtrip(spark, sf_dir):
    path = new_path(spark, "followers_csv")
    el.write_delimited(follower_count(spark, sf_dir), path)
    return spark.read.schema("node BIGINT, followers BIGINT").csv(path)


def ranks_text_roundtrip(spark, sf_dir):
    path = new_path(spark, "ranks_text")
    el.write_tuples(pagerank(spark, sf_dir), path)
    return el.read_tuples(spark, path, "node BIGINT, rank DOUBLE")


QUERIES = {
    f.__name__: f
    for f in (
        edge_scan,
        edge_scan_hops,
        edge_scan_supply,
        edge_parse_lines,
        edge_file_lines,
        edge_rejects,
        multi_input_tagged,
        max_filter,
        max_filter_hops,
        reverse_edges,
        follower_count,
        follower_count_hops,
        out_degree,
        degree_in_out,
        distinct_edges,
        path2_cardinality,
        path2_cardinality_hops,
        path2_cardinality_max,
        path2_pairs_max,
        path2_pairs,
        path2_pairs_all,
        path2_pairs_broadcast,
        path2_pairs_slabs,
        path2_pairs_blocks,
        max_filter_layout,
        closed_walks_hops,
        closed_walks_semi_hops,
        closed_walks_set_hops,
        triangle_count,
        triangle_count_hops,
        triangle_count_broadcast,
        triangle_count_max,
        triangle_count_partition,
        triangle_count_intersect,
        closed_walks_set_intersect,
        closed_walks_semi_intersect,
        adjacency_list,
        adjacency_set,
        adjacency_set_split,
        dangling_nodes,
        pagerank,
        pagerank_hops,
        pagerank_dangling_trace,
        pagerank_rounds,
        pagerank_low_ids,
        chain_graph,
        pagerank_chain,
        path2_csv_roundtrip,
        path2_max_csv_roundtrip,
        edge_read_lines,
        edge_read_counts,
        edge_line_parts,
        edge_rows_without_id,
        edges_split_by_rows,
        followers_text_order,
        edges_tsv_roundtrip,
        edges_space_roundtrip,
        followers_csv_roundtrip,
        ranks_text_roundtrip,
    )
}
