"""Per-node counts. All of them combine on the map side before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def follower_count(edges: DataFrame) -> DataFrame:
    """``(node, followers)`` for every node that is followed."""
    return edges.groupBy(F.col("dst").alias("node")).agg(
        F.count(F.lit(1)).alias("followers")
    )


def out_degree(edges: DataFrame) -> DataFrame:
    """``(node, out_deg)`` for every node that follows someone."""
    return edges.groupBy(F.col("src").alias("node")).agg(
        F.count(F.lit(1)).alias("out_deg")
    )


def degree_in_out(edges: DataFrame) -> DataFrame:
    """``(node, in_deg, out_deg)`` for every node, in one pass over the edges."""
    ends = F.array(
        F.struct(
            F.col("dst").alias("node"),
            F.lit(1).cast("bigint").alias("i"),
            F.lit(0).cast("bigint").alias("o"),
        ),
        F.struct(
            F.col("src").alias("node"),
            F.lit(0).cast("bigint").alias("i"),
            F.lit(1).cast("bigint").alias("o"),
        ),
    )
    return (
        edges.select(F.inline(ends))
        .groupBy("node")
        .agg(F.sum("i").alias("in_deg"), F.sum("o").alias("out_deg"))
    )


def dangling_nodes(edges: DataFrame) -> DataFrame:
    """Nodes without out-edges, read off the degrees instead of an anti join."""
    return degree_in_out(edges).where("out_deg = 0").select("node")
