"""Readers for edge lists in delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from edgeloom.functions.columns import field_count, number_at, two_numbers
from edgeloom.storage import keep

MOST_PARTITIONS = 2**11


def read_edges(spark: SparkSession, path: str | list[str], sep: str = ",") -> DataFrame:
    """The edges of raw text files; other lines are left out by the rule of :func:`parse_edges`."""
    return read_edge_lines(spark, path, sep)[0]


def read_edge_lines(
    spark: SparkSession, path: str | list[str], sep: str = ","
) -> tuple[DataFrame, DataFrame]:
    """Raw text files as ``(edges, rejects)``; no line makes the job fail."""
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    return parse_edges(lines, sep), parse_rejects(lines, sep)


def parse_edges(lines: DataFrame, sep: str = ",") -> DataFrame:
    """Edges from a ``line`` column: exactly two fields, both whole numbers.

    One pattern test decides; the ids are then cut out literally, which is
    several times faster than splitting by pattern.
    """
    line = F.col("line")
    return (
        lines.where(two_numbers(line, sep))
        .select(number_at(line, sep, 1).alias("src"), number_at(line, sep, 2).alias("dst"))
        .where("src IS NOT NULL AND dst IS NOT NULL")
    )


def parse_rejects(lines: DataFrame, sep: str = ",") -> DataFrame:
    """Lines that :func:`parse_edges` leaves out, each with a reason."""
    line = F.col("line")
    fits = number_at(line, sep, 1).isNotNull() & number_at(line, sep, 2).isNotNull()
    reason = F.when(field_count(line, sep) != 2, "field_count").otherwise("not_a_number")
    return lines.where(~(two_numbers(line, sep) & fits)).select(
        "line", reason.alias("reason")
    )


def parse_lines(lines: DataFrame, sep: str = ",") -> DataFrame:
    """``(line, src, dst, reason)`` of every line; ``reason`` is null for an edge."""
    line = F.col("line")
    edge = two_numbers(line, sep)
    return (
        lines.select(
            "line",
            F.when(edge, number_at(line, sep, 1)).alias("src"),
            F.when(edge, number_at(line, sep, 2)).alias("dst"),
        )
        .withColumn(
            "reason",
            F.when(F.col("src").isNotNull() & F.col("dst").isNotNull(), F.lit(None))
            .when(field_count(line, sep) != 2, "field_count")
            .otherwise("not_a_number"),
        )
    )


def counted_lines(parsed: DataFrame, max_id: int | None = None) -> tuple[DataFrame, Observation]:
    """``parsed`` lines, and what the first job over them counts on its way.

    The observation's ``get`` has ``lines``, ``field_count`` and ``not_a_number`` (the rejects), ``above_max``
    (edges with an id over ``max_id``) and ``edges``, those that stay. No job of its own is run.
    """
    edge = F.col("reason").isNull()
    above = F.greatest("src", "dst") > max_id if max_id is not None else F.lit(False)
    seen = Observation("lines")
    counted = parsed.observe(
        seen,
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("reason") == "field_count").alias("field_count"),
        F.count_if(F.col("reason") == "not_a_number").alias("not_a_number"),
        F.count_if(edge & above).alias("above_max"),
        F.count_if(edge & ~above).alias("edges"),
    )
    return counted, seen


def read_tuples(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines such as ``(12,0.5)`` as the columns named in ``schema``."""
    inner = F.regexp_extract("value", r"^\((.*)\)$", 1)
    row = F.from_csv(inner, schema, {"mode": "FAILFAST"})
    return spark.read.text(path).select(row.alias("r")).select("r.*")


def split_by_rows(df: DataFrame, rows: int) -> DataFrame:
    """Spread ``df`` evenly over parts of about ``rows`` rows each, numbered by a column ``part``.

    A part is a partition, or, from ``MOST_PARTITIONS`` parts on, several parts share one: a task
    for each would send more reports to the driver than it can hold.
    """
    n = max(1, -(-df.count() // rows))
    # Each task deals its rows out in turn, from a part of its own on.
    turn = F.monotonically_increasing_id().bitwiseAND(2**33 - 1) + F.pmod(F.xxhash64(F.spark_partition_id()), F.lit(n))
    tasks = min(n, MOST_PARTITIONS)
    return df.withColumn("part", turn % n).repartitionById(tasks, (F.col("part") % tasks).cast("int"))


def number_lines(files: DataFrame) -> DataFrame:
    """``files``, a DataFrame read from files, with ``pos``: the number of each row over all files.

    Files count in the order of their paths, from 1. One pass counts the rows of each block that a task
    reads; only that index, a row for each block, is gathered and broadcast. The rows are not shuffled:
    Spark numbers them in the order in which a task reads them. A row whose block
    was read otherwise in the second pass is an error.
    """
    place = ["_file", "_start"]
    rows = files.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    )
    index = keep(
        rows.groupBy(*place).agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first")), "line_index"
    )
    before = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    starts = index.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    inside = F.col("_id") - F.col("_first")
    pos = F.when((inside >= 0) & (inside < F.col("_n")), F.col("_before") + inside + 1).otherwise(
        F.raise_error(F.lit("the files were cut into other blocks")).cast("bigint")
    )
    return rows.join(F.broadcast(starts), place).select(pos.alias("pos"), *files.columns)


def split_lines(spark: SparkSession, path: str | list[str], rows: int) -> DataFrame:
    """``(part, pos, line)``: the lines of text files in parts of exactly ``rows``, but the last.

    No row is moved: write the result with ``partitionBy("part")`` to have the parts as folders.
    """
    if rows < 1:
        raise ValueError("a part needs at least one row")
    numbered = number_lines(spark.read.text(path))
    part = F.expr(f"(pos - 1) div {rows}")
    return numbered.select(part.alias("part"), "pos", F.col("value").alias("line"))
