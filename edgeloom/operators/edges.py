"""Row-level operators on edge lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_FILE = 2**24


def as_edges(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Two columns of any table as an edge list; rows without an id are left out.

    :func:`rows_without_id` counts what is left out.
    """
    return df.select(
        F.col(src).cast("bigint").alias("src"), F.col(dst).cast("bigint").alias("dst")
    ).where("src IS NOT NULL AND dst IS NOT NULL")


def rows_without_id(df: DataFrame, src: str, dst: str) -> DataFrame:
    """One row ``(n, without_id)``: all rows, and those :func:`as_edges` leaves out."""
    missing = F.col(src).cast("bigint").isNull() | F.col(dst).cast("bigint").isNull()
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(missing).alias("without_id"))


def max_filter(edges: DataFrame, max_id: int | None) -> DataFrame:
    """Edges with both ids up to and including ``max_id``; all edges if None."""
    if max_id is None:
        return edges
    return edges.where((F.col("src") <= max_id) & (F.col("dst") <= max_id))


def write_by_greatest(edges: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write edges in the order of their greater id, so that a filter by ``max_id`` reads a part only.

    Files and the row groups in them hold ranges of ``greatest``, a column of the table; parquet keeps the
    least and greatest value of each. Edges of one greater id may fill several files.
    """
    columns = edges.select("src", "dst", F.greatest("src", "dst").alias("greatest"))
    tasks = max(1, -(-columns.count() // rows_per_file))
    placed = columns.repartitionByRange(tasks, "greatest", "src", "dst")
    placed.sortWithinPartitions("greatest", "src", "dst").write.parquet(path)


def read_up_to(spark: SparkSession, path: str, max_id: int | None) -> DataFrame:
    """:func:`max_filter` of a table that :func:`write_by_greatest` wrote; the filter is pushed down."""
    edges = spark.read.schema("src BIGINT, dst BIGINT, greatest BIGINT").parquet(path)
    if max_id is not None:
        edges = edges.where(F.col("greatest") <= max_id)
    return edges.select("src", "dst")


def reverse_edges(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def distinct_edges(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").distinct()


def weighted_edges(edges: DataFrame) -> DataFrame:
    """Distinct edges with the number of copies ``m`` of each."""
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("m"))


def tag_inputs(**inputs: DataFrame) -> DataFrame:
    """Union of edge lists with the name of the input each row came from."""
    tagged = [
        edges.select("src", "dst", F.lit(tag).alias("tag"))
        for tag, edges in inputs.items()
    ]
    union = tagged[0]
    for part in tagged[1:]:
        union = union.unionByName(part)
    return union
