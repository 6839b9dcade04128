"""Pairs x -> y -> z that cross a shuffle as lists.

A join by y gives one row for each pair of an edge x -> y and an edge y -> z, and rows with both ends
are what is costly to move. Here the edges that leave y are put into lists of about ``LIST_LEN``
first, an edge x -> y meets whole lists, and these go to the task of x, which unfolds them. All pairs of x are
there, so sums by (x, z) need no further shuffle. A start node with too many pairs for
one task has its pairs summed where they are built, and the sums are dealt out by both ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.operators.skew import (
    hot_limit,
    hot_pairs,
    hot_rows,
    split_join,
    stripe_of,
    stripes,
    task_count,
)
from edgeloom.storage import keep

LIST_LEN = 2**12
LISTS_PER_TASK = 2**9
# Pairs that a task unfolds.
PAIRS_PER_DEAL = 2**21


def listed(outs: DataFrame, max_len: int = LIST_LEN) -> DataFrame:
    """``(y, part, ids, copies)`` from ``outs(y, z, m_out)``; only a key of over ``max_len`` rows has several parts."""
    counts = outs.groupBy("y").agg(F.count(F.lit(1)).alias("n"))
    long = counts.where(F.col("n") > max_len).select("y", stripes(F.col("n"), max_len).alias("n_parts"))
    parted = outs.join(F.broadcast(long), "y", "left").withColumn("part", stripe_of(F.col("z"), F.col("n_parts")))
    return as_lists(parted)


def as_lists(parted: DataFrame) -> DataFrame:
    items = F.collect_list(F.struct("z", "m_out")).alias("items")
    return (
        parted.groupBy("y", "part")
        .agg(items)
        .select("y", "part", F.col("items.z").alias("ids"), F.col("items.m_out").alias("copies"))
    )


def pair_counts(ins: DataFrame, outs: DataFrame) -> DataFrame:
    """``(y, n_left, n_right)``: rows of each side, a written table."""
    nothing = F.lit(0).cast("bigint")
    both = (
        ins.groupBy("y").agg(F.count(F.lit(1)).alias("n_left")).withColumn("n_right", nothing)
    ).unionByName(
        outs.groupBy("y").agg(F.count(F.lit(1)).alias("n_right")).withColumn("n_left", nothing)
    )
    return keep(
        both.groupBy("y").agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right")), "counts"
    )


def pairs_of_starts(ins: DataFrame, counts: DataFrame) -> DataFrame:
    """``(x, pairs)``: joined rows that begin at each node; a node without any has no row."""
    outs = counts.where("n_right > 0").select("y", F.col("n_right").alias("pairs"))
    rows = counts.agg(F.coalesce(F.sum("n_left"), F.lit(0))).first()[0]
    single = counts.select("y", "n_left", F.lit(1).alias("n_right"))
    met = split_join(ins.select("y", "x"), outs, "y", ("x", "y"), hot_rows(single, "y", hot_limit(rows)))
    return met.groupBy("x").agg(F.sum("pairs").alias("pairs"))


def join_lists(ins: DataFrame, outs: DataFrame, counts: DataFrame, pairs_per_task: int) -> DataFrame:
    """``(x, m_in, ids, copies)``: each row of ``ins(y, x, m_in)`` with the lists of its y."""
    rows = counts.agg(F.coalesce(F.sum(F.col("n_left") + F.col("n_right")), F.lit(0))).first()[0]
    parts = F.when(F.col("n_right") > 0, stripes(F.col("n_right"), LIST_LEN)).otherwise(0).cast("bigint")
    hot, tasks = hot_pairs(
        counts.withColumn("n_right", parts), "y", hot_limit(rows), max(1, pairs_per_task // LISTS_PER_TASK)
    )
    return split_join(ins, listed(outs), "y", ("x", "part"), hot, tasks).select("x", "m_in", "ids", "copies")


def heavy_starts(starts: DataFrame, pairs_per_task: int) -> tuple[DataFrame | None, int]:
    """Nodes of a written table ``(x, pairs)`` with too many pairs for a task, None without any; all pairs."""
    total, most = starts.agg(F.coalesce(F.sum("pairs"), F.lit(0)), F.coalesce(F.max("pairs"), F.lit(0))).first()
    limit = hot_limit(total, pairs_per_task)
    return (starts.where(F.col("pairs") > limit).select("x") if most > limit else None), total


def deal_tasks(df: DataFrame, pairs: int) -> int:
    return task_count(df.sparkSession, pairs, PAIRS_PER_DEAL // 16, PAIRS_PER_DEAL)


def unfolded(lists: DataFrame) -> DataFrame:
    """A row ``(x, z, m_out, ...)`` for each item, with the other columns of its list."""
    others = [c for c in lists.columns if c not in ("x", "ids", "copies")]
    items = lists.select("x", *others, "copies", F.posexplode("ids").alias("at", "z"))
    return items.select("x", "z", *others, F.get("copies", "at").alias("m_out"))


def sums_by_pair(
    lists: DataFrame, heavy: DataFrame | None, tasks: int, keep_returns: bool, *measures: Column
) -> DataFrame:
    """``measures`` of the unfolded ``lists`` by (x, z)."""

    def summed(part: DataFrame) -> DataFrame:
        pairs = unfolded(part)
        return (pairs if keep_returns else pairs.where("x <> z")).groupBy("x", "z").agg(*measures)

    light = lists if heavy is None else lists.join(F.broadcast(heavy), "x", "left_anti")
    dealt = summed(light.coalesce(1) if tasks == 1 else light.repartition(tasks, "x"))
    if heavy is None:
        return dealt
    return dealt.unionByName(summed(lists.join(F.broadcast(heavy), "x", "left_semi")))
