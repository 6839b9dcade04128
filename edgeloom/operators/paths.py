"""Paths of two edges, x -> y -> z."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgeloom.operators.broadcasts import (
    BROADCAST_ROWS,
    fits_broadcast,
    join_broadcast,
    join_slabs,
    slab_count,
)
from edgeloom.operators.degrees import degree_in_out
from edgeloom.operators.edges import max_filter, weighted_edges
from edgeloom.operators.lists import (
    LIST_LEN,
    PAIRS_PER_DEAL,
    as_lists,
    deal_tasks,
    heavy_starts,
    join_lists,
    pair_counts,
    pairs_of_starts,
    sums_by_pair,
)
from edgeloom.operators.skew import PAIRS_PER_TASK, task_count
from edgeloom.storage import RunFolder, keep, parts_apart

PAIRS_PER_BLOCK = 2**32
# Small blocks are written so many pairs, and so many blocks, at a time.
PAIRS_PER_WAVE = 2**26
BLOCKS_PER_WAVE = 64
LISTS = "x BIGINT, m_in BIGINT, ids ARRAY<BIGINT>, copies ARRAY<BIGINT>"


def path2_cardinality(edges: DataFrame, max_id: int | None = None) -> DataFrame:
    """Number of 2-paths: sum over nodes of in-degree times out-degree.

    No path is built. The sum is exact, DECIMAL(38,0), as a hub's product
    can exceed BIGINT.
    """
    degrees = degree_in_out(max_filter(edges, max_id))
    paths = F.col("in_deg").cast("decimal(19,0)") * F.col("out_deg").cast("decimal(18,0)")
    total = F.sum(paths.cast("decimal(38,0)")).cast("decimal(38,0)")
    return degrees.agg(F.coalesce(total, F.lit(0).cast("decimal(38,0)")).alias("path2_count"))


def path2_pairs(
    edges: DataFrame,
    keep_returns: bool = False,
    strategy: str = "shuffle",
    max_broadcast_rows: int = BROADCAST_ROWS,
    pairs_per_task: int = PAIRS_PER_TASK,
    max_id: int | None = None,
) -> DataFrame:
    """``(x, z, paths)``: ordered end points and the number of 2-paths between them.

    Copies of an edge are merged into a weight first, so they cost nothing in
    the join. ``keep_returns`` keeps paths that end where they start.
    ``strategy="broadcast"`` ships one side whole to every task if it has at
    most ``max_broadcast_rows`` edges and shuffles otherwise; ``"slabs"`` ships a larger one by
    slabs of at most so many, one after the other. The number of pairs
    grows with the sum of in-degree times out-degree; ``max_id`` bounds it by
    leaving out edges with a greater id before anything is joined, and :func:`path2_blocks` lists
    the pairs in blocks.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    weighted = keep(weighted_edges(max_filter(edges, max_id)), "weighted")
    ins, outs = _ins(weighted), _outs(weighted)
    if strategy == "broadcast" and fits_broadcast(weighted, max_broadcast_rows):
        return _summed(join_broadcast(ins, outs, "y", "x"), keep_returns)
    counts = pair_counts(ins, outs)
    heavy, total = heavy_starts(keep(pairs_of_starts(ins, counts), "starts"), pairs_per_task)
    if strategy == "slabs" and (slabs := slab_count(outs, "y", max_broadcast_rows)):
        lists = join_slabs(ins, outs, "y", "x", slabs, max_broadcast_rows, _slab_lists)
    else:
        lists = join_lists(ins, outs, counts, pairs_per_task)
    return _shuffled(lists, heavy, deal_tasks(weighted, total), keep_returns)


STRATEGIES = ("shuffle", "broadcast", "slabs")


def _ins(weighted: DataFrame) -> DataFrame:
    return weighted.select(
        F.col("dst").alias("y"), F.col("src").alias("x"), F.col("m").alias("m_in")
    )


def _outs(weighted: DataFrame) -> DataFrame:
    return weighted.select(
        F.col("src").alias("y"), F.col("dst").alias("z"), F.col("m").alias("m_out")
    )


def _summed(paths: DataFrame, keep_returns: bool) -> DataFrame:
    if not keep_returns:
        paths = paths.where("x <> z")
    return paths.groupBy("x", "z").agg(
        F.sum(F.col("m_in") * F.col("m_out")).alias("paths")
    )


def _shuffled(lists: DataFrame, heavy: DataFrame | None, tasks: int, keep_returns: bool) -> DataFrame:
    """``(x, z, paths)`` from the lists that start nodes met."""
    paths = F.sum(F.col("m_in") * F.col("m_out")).alias("paths")
    return sums_by_pair(lists, heavy, tasks, keep_returns, paths)


def _slab_lists(outs: DataFrame) -> DataFrame:
    """The lists of a slab, put together by one task."""
    at = F.row_number().over(Window.partitionBy("y").orderBy("z")) - 1
    parted = outs.coalesce(1).withColumn("part", F.floor(at / LIST_LEN))
    return as_lists(parted).drop("part")


def plan_blocks(weighted: DataFrame, pairs_per_block: int) -> list[tuple[int, int, int]]:
    """``(first x, last x, pairs)`` of ranges of start nodes, in order.

    A range ends where the running sum of pairs passes the next multiple of
    ``pairs_per_block``, so it has less than that and its last node's pairs. Running sums are taken
    inside ranges of the node table, which one row each puts together; one row for each
    block comes to the driver, which runs a job for each.
    """
    spark = weighted.sparkSession
    ins = _ins(weighted)
    starts = keep(pairs_of_starts(ins, pair_counts(ins, _outs(weighted))), "starts")
    tasks = task_count(spark, starts.count(), 2**17, 2**21)
    placed = keep(
        starts.repartitionByRange(tasks, "x").withColumn("range_no", F.spark_partition_id()), "ranges"
    )
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("range_no").agg(F.sum("pairs").alias("s"))
    offsets = sums.select("range_no", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy("range_no").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    running = F.coalesce(F.sum("pairs").over(inside), F.lit(0)) + F.col("earlier")
    cut = (
        placed.join(F.broadcast(offsets), "range_no")
        .withColumn("running", running)
        .withColumn("block", F.expr(f"running div {pairs_per_block}"))
    )
    blocks = cut.groupBy("block").agg(F.min("x"), F.max("x"), F.sum("pairs")).orderBy("block")
    return [tuple(row)[1:] for row in blocks.collect()]


def path2_blocks(
    edges: DataFrame,
    pairs_per_block: int = PAIRS_PER_BLOCK,
    keep_returns: bool = False,
    max_id: int | None = None,
    folder: str | None = None,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """``(x, z, paths, block)`` as :func:`path2_pairs` gives it, written block by block.

    Blocks are ranges of x planned from degree products. The join writes lists, which are short, by
    block; of the pairs that they unfold to, a block's are made at a time, or those of several small blocks up
    to ``PAIRS_PER_WAVE``. Each block is marked when it is written; a listing that is started again with its
    ``folder`` goes on with the blocks that are not.
    """
    spark = edges.sparkSession
    run = RunFolder(spark, folder, "path2")
    if facts := run.facts("plan"):
        weighted = spark.read.parquet(run.path("weighted"))
    else:
        weighted = run.write("weighted", weighted_edges(max_filter(edges, max_id)))
        facts = run.mark("plan", blocks=plan_blocks(weighted, pairs_per_block))
    blocks = facts["blocks"]
    schema = "x BIGINT, z BIGINT, paths BIGINT, block BIGINT"
    if not blocks:
        return spark.createDataFrame([], schema)
    waiting = [i for i in range(len(blocks)) if run.facts(f"pairs/block={i}") is None]
    if waiting:
        _write_lists(run, weighted, blocks, waiting, pairs_per_task)
        for wave in _waves(blocks, waiting):
            parts = []
            for i in wave:
                run.drop(f"pairs/block={i}")
                lists, pairs, heavy = spark.read.schema(LISTS).parquet(run.path(f"lists/block={i}")), blocks[i][2], None
                if pairs > pairs_per_task:
                    sizes = lists.groupBy("x").agg(F.sum(F.size("ids")).alias("pairs"))
                    heavy, _ = heavy_starts(keep(sizes, "starts"), pairs_per_task)
                tasks = -(-pairs // PAIRS_PER_DEAL) if pairs > PAIRS_PER_DEAL else 1
                paths = _shuffled(lists, heavy, tasks, keep_returns)
                parts.append(paths.withColumn("block", F.lit(i).cast("bigint")))
            whole = reduce(DataFrame.unionByName, parts)
            with parts_apart(spark):
                whole.write.mode("append").partitionBy("block").parquet(run.path("pairs"))
            for i in wave:
                run.mark(f"pairs/block={i}")
        run.drop("lists")
    return spark.read.schema(schema).parquet(run.path("pairs"))


def _write_lists(run: RunFolder, weighted: DataFrame, blocks: list, waiting: list, pairs_per_task: int) -> None:
    """The lists of the ``waiting`` blocks, each block in a folder of its own; one join for all."""
    known = run.facts("lists")
    if known and set(waiting) <= set(known["blocks"]):
        return
    firsts = np.array([first for first, _, _ in blocks])
    todo = np.isin(np.arange(len(blocks)), waiting)

    @F.pandas_udf("bigint")
    def block_of(x: pd.Series) -> pd.Series:
        at = np.searchsorted(firsts, x.to_numpy(), "right") - 1
        return pd.Series(at).where((at >= 0) & todo[at])

    ins = _ins(weighted)
    counts = pair_counts(ins, _outs(weighted))
    lists = join_lists(ins, _outs(weighted), counts, pairs_per_task).withColumn("block", block_of("x"))
    total, most = sum(blocks[i][2] for i in waiting), max(blocks[i][2] for i in waiting)
    # A large block is spread over several tasks.
    stripe = F.pmod(F.xxhash64("x"), F.lit(-(-most // (8 * PAIRS_PER_DEAL))))
    tasks = deal_tasks(weighted, total)
    placed = lists.where("block IS NOT NULL").repartition(tasks, "block", stripe)
    placed.write.mode("overwrite").partitionBy("block").parquet(run.path("lists"))
    run.mark("lists", blocks=waiting)


def _waves(blocks: list, waiting: list) -> list[list[int]]:
    """Blocks to write in one job: one, or small ones in a row."""
    waves, pairs = [], 0
    for i in waiting:
        if waves and len(waves[-1]) < BLOCKS_PER_WAVE and pairs + blocks[i][2] <= PAIRS_PER_WAVE:
            waves[-1].append(i)
            pairs += blocks[i][2]
        else:
            waves.append([i])
            pairs = blocks[i][2]
    return waves
