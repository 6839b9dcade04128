"""Broadcasts that are only used for tables of a counted size."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.operators.skew import task_count
from edgeloom.storage import keep, new_path, parts_apart

BROADCAST_ROWS = 2_000_000
SLABS_PER_PASS = 40


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True if ``df``, a table of a few BIGINT columns, is small enough."""
    return df.count() <= max_rows


def join_broadcast(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: str,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    at_a_time: int = 1,
) -> DataFrame:
    """Inner join of two tables that :func:`fits_broadcast` has accepted.

    Each left row may meet many right rows, so the left rows are dealt out. ``shape`` is
    what the right side is made into before it is shipped; ``at_a_time`` such joins run in one job.
    """
    tasks = task_count(left.sparkSession, BROADCAST_ROWS, 2**14, BROADCAST_ROWS)
    dealt = left.repartition(-(-tasks // at_a_time), key, spread)
    return dealt.join(F.broadcast(shape(right) if shape else right), key)


def slab_count(right: DataFrame, key: str, max_rows: int) -> int | None:
    """Slabs by hash of ``key`` so that each has at most ``max_rows`` rows; None if a key has more."""
    counts = right.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total, most = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    if most > max_rows:
        return None
    slabs = max(1, -(-total // max_rows))
    while True:
        sizes = counts.groupBy(_slab(key, slabs).alias("slab")).agg(F.sum("n").alias("n"))
        if (sizes.agg(F.max("n")).first()[0] or 0) <= max_rows:
            return slabs
        slabs += -(-slabs // 4)


def _slab(key: str, slabs: int):
    return F.pmod(F.xxhash64(key), F.lit(slabs))


def join_slabs(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: str,
    slabs: int,
    max_rows: int,
    shape: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Inner join of a large left side with the slabs of ``right``, each joined on the map side.

    Both sides are written by slab first, so a pass reads only its own rows. Its joined rows are written
    before the next one; a pass ships as many slabs of ``max_rows`` as ``BROADCAST_ROWS`` allows, one at least.
    """
    lefts, rights = _by_slab(left, key, spread, slabs, "left"), _by_slab(right, key, None, slabs, "right")
    many = min(SLABS_PER_PASS, max(1, BROADCAST_ROWS // max_rows))
    passes = []
    for start in range(0, slabs, many):
        now = range(start, min(slabs, start + many))
        joined = [
            join_broadcast(
                lefts.where(F.col("slab") == i).drop("slab"),
                rights.where(F.col("slab") == i).drop("slab"),
                key,
                spread,
                shape,
                len(now),
            ).drop(key)
            for i in now
        ]
        with parts_apart(left.sparkSession):
            passes.append(keep(reduce(DataFrame.unionByName, joined), f"slabs-{start}"))
    return reduce(DataFrame.unionByName, passes)


def _by_slab(df: DataFrame, key: str, spread: str | None, slabs: int, name: str) -> DataFrame:
    """``df`` written with a folder for each slab; by ``spread`` too, a slab fills several files."""
    placed = df.withColumn("slab", _slab(key, slabs).cast("int"))
    tasks = task_count(df.sparkSession, df.count(), 2**16, 2**20)
    also = [F.pmod(F.xxhash64(spread), F.lit(8))] if spread and slabs < tasks else []
    path = new_path(df.sparkSession, name)
    placed.repartition(tasks, "slab", *also).write.partitionBy("slab").parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path)
