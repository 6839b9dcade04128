"""Chain graphs: the synthetic input of the PageRank jobs.

Nodes 1..n form chains of k nodes, ``i -> i + 1``. The last node of each
chain has no out-edge, or an edge to the sentinel node 0 where that is asked
for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def chain_edges(nodes: DataFrame, k: int, sentinel: bool = True) -> DataFrame:
    """Chains over a ``node`` column that holds 1..n, each value once."""
    last = (F.col("node") % k == 0) | (
        F.col("node") == nodes.agg(F.max("node")).scalar()
    )
    edges = nodes.select(
        F.col("node").alias("src"),
        F.when(last, F.lit(0).cast("bigint")).otherwise(F.col("node") + 1).alias("dst"),
    )
    return edges if sentinel else edges.where("dst <> 0")


def chain_graph(spark: SparkSession, k: int, sentinel: bool = True) -> DataFrame:
    """k chains of k nodes, generated on the executors."""
    ids = spark.range(1, k * k + 1).select(F.col("id").alias("node"))
    return chain_edges(ids, k, sentinel)
