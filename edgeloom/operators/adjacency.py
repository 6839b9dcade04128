"""Neighbours of each node as sorted arrays of bounded length.

One rule for every node: its neighbours are numbered in id order from 0, and a row holds
``max_len`` of them, ``part = position div max_len``. No array is longer, whatever
the node's size; the rows of a node in ``part`` order are its whole sorted list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgeloom.operators.edges import distinct_edges, weighted_edges
from edgeloom.operators.skew import task_count
from edgeloom.storage import keep

MAX_LEN = 1_000_000
ROWS_PER_RANGE = 2**21


def _parted(edges: DataFrame, max_len: int) -> DataFrame:
    """Add ``part`` to a written table of distinct edges.

    The edges are cut into ranges by source and target and numbered inside each range.
    Only a node whose rows go on from an earlier range needs an offset, so the
    table of offsets has at most one row for each range.
    """
    if max_len < 1:
        raise ValueError("max_len must be at least 1")
    spark = edges.sparkSession
    tasks = task_count(spark, edges.count(), ROWS_PER_RANGE // 16, ROWS_PER_RANGE)
    placed = keep(
        edges.repartitionByRange(tasks, "src", "dst").withColumn("range_no", F.spark_partition_id()),
        "ranges",
    )
    sizes = placed.groupBy("src", "range_no").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("src").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("earlier", F.sum("size").over(before)).where("earlier > 0")
    inside = Window.partitionBy("range_no", "src").orderBy("dst")
    at = F.row_number().over(inside) - 1 + F.coalesce("earlier", F.lit(0))
    return (
        placed.join(F.broadcast(offsets.drop("size")), ["src", "range_no"], "left")
        .withColumn("at", at)
        .withColumn("part", F.expr(f"at div {max_len}"))
        .drop("range_no", "earlier", "at")
    )


def adjacency_list(edges: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """``(src, part, neighbours, copies, n)``.

    A neighbour that is followed several times is listed once, with the
    number of its edges at the same position of ``copies``; ``n`` is their
    sum, the number of edges in the row.
    """
    return weighted_sets(keep(weighted_edges(edges), "weighted"), max_len)


def weighted_sets(weighted: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """The rows of :func:`adjacency_list` from a written table ``(src, dst, m)`` of distinct edges."""
    pairs = F.array_sort(F.collect_list(F.struct("dst", "m")))
    return (
        _parted(weighted, max_len)
        .groupBy("src", "part")
        .agg(pairs.alias("pairs"), F.sum("m").alias("n"))
        .select(
            "src",
            "part",
            F.col("pairs.dst").alias("neighbours"),
            F.col("pairs.m").alias("copies"),
            "n",
        )
    )


def adjacency_set(edges: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """``(src, part, neighbours, n)`` with each neighbour once."""
    return (
        _parted(keep(distinct_edges(edges), "distinct"), max_len)
        .groupBy("src", "part")
        .agg(F.array_sort(F.collect_list("dst")).alias("neighbours"))
        .withColumn("n", F.size("neighbours").cast("bigint"))
    )
