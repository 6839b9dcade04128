"""Edge relations built from the given tables, each over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edgeloom.operators.edges import as_edges, distinct_edges
from edgeloom.storage import keep

ROWS_PER_RANGE = 2**20

# Kinds of nodes of the supply graph; a node id is key * 6 + kind.
REGION, NATION, SUPPLIER, CUSTOMER, PART, ORDER = range(6)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def follows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multigraph: parts follow their suppliers, an edge per lineitem row, in one id space."""
    return as_edges(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


def hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multigraph with self-loops: from each event's user to the next event's."""
    events = table(spark, sf_dir, "events").select("ts", "event_id", "user_id")
    return successive(events, ["ts", "event_id"], "user_id")


def successive(
    rows: DataFrame, order: list[str], value: str, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Edges between the values of neighbouring rows of the whole ordered table.

    A window over the whole table would run in one task. The rows are range
    partitioned instead, numbered by range, and linked inside each range; the
    first row of a range takes its predecessor from the last row of the range
    before, a table with one row per range. Ranges have about ``rows_per_range``
    rows each and are read back one to a task.
    """
    n = max(1, -(-rows.count() // rows_per_range))
    ranges = keep(
        rows.repartitionByRange(n, *order).withColumn("range_no", F.spark_partition_id()),
        "ranges",
    )
    ranges = ranges.repartitionByRange(n, "range_no")
    inside = Window.partitionBy("range_no").orderBy(*order)
    linked = ranges.select(
        "range_no",
        F.lag(value).over(inside).alias("before"),
        F.row_number().over(inside).alias("pos"),
        F.col(value).alias("dst"),
    )
    last = ranges.groupBy("range_no").agg(F.max_by(value, F.struct(*order)).alias("end"))
    ends = last.select(
        "range_no", F.lag("end").over(Window.orderBy("range_no")).alias("prior_end")
    )
    joined = linked.join(F.broadcast(ends), "range_no").withColumn(
        "src", F.when(F.col("pos") == 1, F.col("prior_end")).otherwise(F.col("before"))
    )
    return as_edges(joined, "src", "dst")


def supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simple graph with dangling nodes: each row points at what it refers to.

    order -> customer -> nation -> region and part -> supplier -> nation;
    regions refer to nothing.
    """

    def refs(name: str, key: str, kind: int, ref: str, ref_kind: int) -> DataFrame:
        keys = as_edges(table(spark, sf_dir, name), key, ref)
        return keys.select(
            (F.col("src") * 6 + kind).alias("src"),
            (F.col("dst") * 6 + ref_kind).alias("dst"),
        )

    return (
        refs("orders", "o_orderkey", ORDER, "o_custkey", CUSTOMER)
        .unionByName(refs("customer", "c_custkey", CUSTOMER, "c_nationkey", NATION))
        .unionByName(
            distinct_edges(refs("lineitem", "l_partkey", PART, "l_suppkey", SUPPLIER))
        )
        .unionByName(refs("supplier", "s_suppkey", SUPPLIER, "s_nationkey", NATION))
        .unionByName(refs("nation", "n_nationkey", NATION, "n_regionkey", REGION))
    )


def order_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node ids 1..n for the chain generator, one per order."""
    return table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("node"))


def edge_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ``line`` per lineitem row, well-formed or not by line number."""
    part, supp = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    number = F.col("l_linenumber")
    line = (
        F.when(number == 2, F.concat(part, F.lit(","), supp, F.lit(",")))
        .when(number == 3, F.concat(part, F.lit(","), supp, F.lit(",7")))
        .when(number == 4, F.concat(part, F.lit(",")))
        .when(number == 5, F.concat(F.lit("x"), part, F.lit(","), supp))
        .when(number == 6, F.lit(""))
        .otherwise(F.concat(part, F.lit(","), supp))
    )
    return table(spark, sf_dir, "lineitem").select(line.alias("line"))
