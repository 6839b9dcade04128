"""PageRank with redistribution of the rank held by dangling nodes.

With N nodes, d(u) distinct out-edges of u and D the rank held by nodes
without out-edges, one round is

    rank'(v) = (1 - damping) / N + damping * (sum over u -> v of rank(u) / d(u) + D / N)

The edges are written once, before the first round, to a table bucketed by source; a hub's
edges are spread over several stripes. A round moves the node table
(one row per node and stripe) to the buckets, where a hash table of it is built, and the
partly summed contributions to their targets; the edges stay where they are, unsorted, and a lost
executor costs a re-read of its buckets.

Nodes without in-edges all have the same rank in a round, (1 - damping) / N + damping * D / N. They and their edges
take no part in the rounds: what they give a node is that rank times a sum that is taken once. Rounds hold
the other nodes, and the tables that are handed out hold all.

All tables of a run lie in one folder. Each round is marked when it is whole, so a job that is
started again with the same folder goes on from the last whole round.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.functions.columns import damped
from edgeloom.operators.degrees import degree_in_out
from edgeloom.operators.edges import distinct_edges
from edgeloom.operators.skew import (
    ROWS_PER_STRIPE,
    all_stripes,
    hot_limit,
    split_join,
    stripe_of,
    stripes,
    task_count,
)
from edgeloom.storage import BucketedTable, RunFolder

RANKS = "node BIGINT, rank DOUBLE, out_deg BIGINT"
PLACED = "src BIGINT, stripe INT, dst BIGINT"
EDGES, LINKS, STILL = "edges", "links", "still"


def _begin(run: RunFolder, edges: DataFrame, rows_per_stripe: int) -> dict:
    """Write the bucketed edges and the start ranks, unless the run has them; facts about both."""
    if known := run.facts(EDGES):
        return known
    spark = run.spark
    links = run.write(LINKS, distinct_edges(edges))
    degrees = degree_in_out(links).select("node", "in_deg", "out_deg")
    nodes = run.write("nodes", degrees)
    n, total = max(nodes.count(), 1), links.count()
    limit = hot_limit(total, rows_per_stripe)
    hubs = nodes.where(F.col("out_deg") > limit).select(
        F.col("node").alias("src"), stripes(F.col("out_deg"), limit).alias("n_stripes")
    )
    hot = hubs.select("src", F.col("n_stripes").alias("n_rows"), F.lit(1).alias("n_cols"))

    def leaving(which: str) -> DataFrame:
        starts = nodes.where(which).select(F.col("node").alias("src"), "out_deg")
        return split_join(links, starts, "src", ("dst", "src"), hot)

    still = run.write(STILL, nodes.where("in_deg = 0").select("node", "out_deg"))
    fed = leaving("in_deg = 0").groupBy(F.col("dst").alias("node")).agg(F.sum(1 / F.col("out_deg")).alias("fed"))
    start = nodes.where("in_deg > 0").join(fed, "node", "left")
    rank = F.lit(1.0 / n).alias("rank")
    run.write(run.round(0), start.select("node", rank, "out_deg", F.coalesce("fed", F.lit(0.0)).alias("fed")), still=1.0 / n)
    moving = links if not still.count() else leaving("in_deg > 0").select("src", "dst")
    placed = moving.join(F.broadcast(hubs), "src", "left").select(
        "src", stripe_of(F.col("dst"), F.col("n_stripes")).alias("stripe"), "dst"
    )
    table = BucketedTable(run, EDGES, ["src", "stripe"], task_count(spark, total, 2**20, 2**24))
    try:
        table.write(placed, limit=limit, n=n)
    finally:
        table.close()
    run.drop(LINKS)
    run.drop("nodes")
    return run.facts(EDGES)


def _next(
    ranks: DataFrame, placed: DataFrame, limit: int, n: int, damping: float, held: float, still: float
) -> DataFrame:
    """The next round from the last one, its dangling rank and its rank of a node without in-edges."""
    shares = ranks.where("out_deg > 0").select(
        F.col("node").alias("src"),
        (F.col("rank") / F.col("out_deg")).alias("share"),
        all_stripes(stripes(F.col("out_deg"), limit)).alias("stripe"),
    )
    # One row for each node and stripe of a bucket, which holds at most 2**24 edges.
    received = placed.join(shares.hint("shuffle_hash"), ["src", "stripe"]).select(
        F.col("dst").alias("node"),
        F.col("share").alias("c"),
        F.lit(None).cast("bigint").alias("out_deg"),
        F.lit(None).cast("double").alias("fed"),
    )
    # Each node's own row keeps it in the result, carries its degree and what still nodes give it.
    own = ranks.select("node", (F.lit(still) * F.col("fed")).alias("c"), "out_deg", "fed")
    return (
        received.unionByName(own)
        .groupBy("node")
        .agg(F.sum("c").alias("c"), F.max("out_deg").alias("out_deg"), F.max("fed").alias("fed"))
        .select(
            "node",
            damped(F.col("c"), F.lit(held), n, damping).alias("rank"),
            "out_deg",
            "fed",
        )
    )


def rank_rounds(
    edges: DataFrame,
    iterations: int = 10,
    damping: float = 0.85,
    rows_per_stripe: int = ROWS_PER_STRIPE,
    folder: str | None = None,
    every_round: bool = True,
) -> Iterator[tuple[int, DataFrame]]:
    """``(i, table)`` with tables ``(node, rank, out_deg)``: the start ranks, then one per round.

    Each table is written before the next round reads it. ``folder`` names the run's folder,
    by default a new one in the shared folder. A run that is started again with its folder, and the
    same edges, yields the rounds it has and goes on from the last. Without ``every_round``
    only the last whole round is kept and yielded.
    """
    if iterations < 0:
        raise ValueError("iterations must not be negative")
    run = RunFolder(edges.sparkSession, folder, "pagerank")
    settings = run.facts("settings") or run.mark("settings", damping=damping)
    if settings["damping"] != damping:
        raise ValueError(f"{run.folder} was begun with damping {settings['damping']}")
    facts = _begin(run, edges, rows_per_stripe)

    def moving(i: int) -> DataFrame:
        ranks = run.spark.read.schema(f"{RANKS}, fed DOUBLE").parquet(run.path(run.round(i)))
        return ranks.na.fill(0.0, ["fed"])

    def table(i: int) -> DataFrame:
        ranks = moving(i).select("node", "rank", "out_deg")
        if run.facts(STILL) is None:  # a run of an earlier version, whose rounds hold every node
            return ranks
        still = run.spark.read.schema("node BIGINT, out_deg BIGINT").parquet(run.path(STILL))
        return ranks.unionByName(still.withColumn("rank", F.lit(run.facts(run.round(i))["still"])))

    there = [i for i in run.rounds() if i <= iterations]
    if not there:
        raise ValueError(f"{run.folder} holds later rounds only")
    for i in there if every_round else there[-1:]:
        yield i, table(i)
    last = there[-1]
    if last == iterations:
        return
    bucketed = BucketedTable(run, EDGES, ["src", "stripe"], facts["buckets"])
    placed = bucketed.read(PLACED)
    try:
        for i in range(last + 1, iterations + 1):
            before, n = moving(i - 1), facts["n"]
            held = before.where("out_deg = 0").agg(F.coalesce(F.sum("rank"), F.lit(0.0))).first()[0]
            still = run.facts(run.round(i - 1)).get("still", 0.0)
            ranks = _next(before, placed, facts["limit"], n, damping, held, still)
            run.write(run.round(i), ranks, still=(1.0 - damping) / n + damping * (held / n))
            if not every_round:
                run.drop(run.round(i - 1))
            yield i, table(i)
    finally:
        bucketed.close()
    if not folder:
        run.drop(EDGES)


def pagerank_rounds(
    edges: DataFrame,
    iterations: int = 10,
    damping: float = 0.85,
    rows_per_stripe: int = ROWS_PER_STRIPE,
    folder: str | None = None,
) -> Iterator[DataFrame]:
    """The tables of :func:`rank_rounds`, from the start ranks on."""
    for _, ranks in rank_rounds(edges, iterations, damping, rows_per_stripe, folder):
        yield ranks


def pagerank(
    edges: DataFrame, iterations: int = 10, damping: float = 0.85, folder: str | None = None
) -> DataFrame:
    """``(node, rank)`` after the given number of rounds; ranks add up to 1.

    Of the run's tables only the last round stays, and the edges if a ``folder`` is named.
    """
    *_, (_, last) = rank_rounds(edges, iterations, damping, folder=folder, every_round=False)
    return last.select("node", "rank")


def dangling_trace(
    edges: DataFrame, iterations: int = 10, damping: float = 0.85, folder: str | None = None
) -> DataFrame:
    """``(iteration, dangling)``: the rank each round took from dangling nodes.

    One scan of all rounds' tables.
    """
    if iterations < 1:
        raise ValueError("a trace needs at least one iteration")
    spark = edges.sparkSession
    run = RunFolder(spark, folder, "pagerank")
    for _ in rank_rounds(edges, iterations - 1, damping, folder=run.folder):
        pass
    held = (
        run.all_rounds(RANKS)
        .where(F.col("iteration") < iterations)
        .groupBy((F.col("iteration") + 1).alias("iteration"))
        .agg(F.sum(F.when(F.col("out_deg") == 0, F.col("rank"))).alias("dangling"))
    )
    # Without nodes no round has rows.
    every = spark.range(1, iterations + 1).withColumnRenamed("id", "iteration")
    return every.join(F.broadcast(held), "iteration", "left").na.fill(0.0, ["dangling"])
