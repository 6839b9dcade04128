"""Writers for delimited and tuple text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.functions.columns import tuple_text

COPIES_PER_PIECE = 1_000_000


def in_text_order(df: DataFrame, copies: int = COPIES_PER_PIECE) -> DataFrame:
    """All rows in the order of the first column's text, then of the others.

    A range sort can only separate rows that differ. Equal rows are therefore
    counted, handed out in pieces of at most ``copies``, and numbered, so that
    many copies of one row are unfolded and sorted by several tasks.
    """
    columns = df.columns
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_m"))
    pieces = counted.withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.expr(f"(_m - 1) div {copies}")))
    )
    size = F.least(F.lit(copies), F.col("_m") - F.col("_piece") * copies)
    numbered = (
        pieces.withColumn("_m", size)
        .repartition(partitions, *columns, "_piece")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_m"))))
    )
    first = F.col(columns[0]).cast("string")
    return numbered.orderBy(first, *columns, "_piece", "_copy").select(*columns)


def write_delimited(df: DataFrame, path: str, sep: str = ",", text_order: bool = False) -> None:
    """Headerless delimited text, optionally ordered by the first column's text."""
    (in_text_order(df) if text_order else df).write.csv(path, sep=sep)


def write_tuples(df: DataFrame, path: str) -> None:
    """One ``(a,b)`` line per row."""
    df.select(tuple_text(*(F.col(c).cast("string") for c in df.columns))).write.text(path)
