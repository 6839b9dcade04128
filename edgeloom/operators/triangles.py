"""Directed 3-cycles, a -> b -> c -> a.

Plain 2-paths through a hub are far too many, so each cycle is found from its
lowest-degree node only: nodes are ordered by (degree, id), and a wedge
x -> y -> z is formed only where y comes before both x and z. Every cycle has
exactly one such y. No node then has more than sqrt(2 * edges) later
neighbours, and the number of wedges stays below edges ** 1.5. (J. Cohen,
"Graph twiddling in a MapReduce world", 2009; S. Suri and S. Vassilvitskii,
"Counting triangles and the curse of the last reducer", 2011.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.operators.broadcasts import BROADCAST_ROWS, fits_broadcast, join_broadcast
from edgeloom.operators.degrees import degree_in_out
from edgeloom.operators.edges import max_filter, weighted_edges
from edgeloom.operators.intersections import MAX_LEN, closed_sets
from edgeloom.operators.lists import deal_tasks, heavy_starts, join_lists, pair_counts, pairs_of_starts, sums_by_pair
from edgeloom.operators.partitions import EDGES_PER_TASK, class_count, cycle_counts
from edgeloom.operators.skew import (
    PAIRS_PER_TASK,
    ROWS_PER_STRIPE,
    hot_limit,
    hot_pairs,
    hot_rows,
    split_join,
)
from edgeloom.storage import keep

EXACT = "decimal(38,0)"
STRATEGIES = ("shuffle", "broadcast", "partition", "intersect")


def _with_degree(
    edges: DataFrame, end: str, other: str, degrees: DataFrame, limit: int
) -> DataFrame:
    """Add the degree of the node in column ``end``; drop edges off all cycles."""
    table = degrees.where("passable").select(
        F.col("node").alias(end), F.col("deg").alias(f"{end}_deg")
    )
    counts = degrees.select(
        F.col("node").alias(end), F.col("deg").alias("n_left"), F.lit(1).alias("n_right")
    )
    return split_join(edges, table, end, (other, end), hot_rows(counts, end, limit))


def ordered_edges(
    weighted: DataFrame, rows_per_stripe: int = ROWS_PER_STRIPE
) -> DataFrame:
    """``(low, high, out, m)``: each distinct edge seen from its earlier node.

    ``weighted(src, dst, m)`` is a kept table of distinct edges. ``out`` is
    true where the edge leaves ``low``. Self-loops are left out, as are edges of nodes that have no in-edge or no out-edge: no cycle passes
    them. The result is a table in the shared folder: the wedge join, its row
    counts and the closing join all read it.
    """
    simple = weighted.where("src <> dst")
    degrees = keep(
        degree_in_out(simple).select(
            "node",
            (F.col("in_deg") + F.col("out_deg")).alias("deg"),
            ((F.col("in_deg") > 0) & (F.col("out_deg") > 0)).alias("passable"),
        ),
        "degrees",
    )
    limit = hot_limit(2 * weighted.count(), rows_per_stripe)
    ranked = _with_degree(simple, "src", "dst", degrees, limit)
    ranked = _with_degree(ranked, "dst", "src", degrees, limit)
    out = F.struct("src_deg", "src") < F.struct("dst_deg", "dst")
    return keep(
        ranked.select(
            F.when(out, F.col("src")).otherwise(F.col("dst")).alias("low"),
            F.when(out, F.col("dst")).otherwise(F.col("src")).alias("high"),
            out.alias("out"),
            "m",
        ),
        "ordered_edges",
    )


def _ends(ordered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(y, x, m_in)`` and ``(y, z, m_out)``: edges into and out of their earlier node."""
    ins = ordered.where("NOT out").select(
        F.col("low").alias("y"), F.col("high").alias("x"), F.col("m").alias("m_in")
    )
    outs = ordered.where("out").select(
        F.col("low").alias("y"), F.col("high").alias("z"), F.col("m").alias("m_out")
    )
    return ins, outs


def wedges(
    ordered: DataFrame,
    broadcast_outs: bool = False,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """``(y, x, z, m_in, m_out)``: x -> y -> z with y before x and z, x <> z."""
    ins, outs = _ends(ordered)
    if broadcast_outs:
        found = join_broadcast(ins, outs, "y", "x")
    else:
        later = ordered.groupBy(F.col("low").alias("y")).agg(
            F.count_if(~F.col("out")).alias("n_left"), F.count_if("out").alias("n_right")
        )
        counts = keep(later, "counts")
        limit = hot_limit(ordered.count())
        hot, tasks = hot_pairs(counts, "y", limit, pairs_per_task)
        found = split_join(ins, outs, "y", ("x", "z"), hot, tasks)
    return found.where("x <> z")


def closed_pairs(
    ordered: DataFrame,
    *measures: Column,
    broadcast_edges: bool = False,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """Wedges summed over y per (x, z), where the edge z -> x closes them.

    ``measures`` are aggregates over ``m_in`` and ``m_out`` that skip nulls. Wedges are dealt out by x as
    lists and summed there, together with the closing edges.
    """
    closing = ordered.select(
        F.when(F.col("out"), F.col("low")).otherwise(F.col("high")).alias("z"),
        F.when(F.col("out"), F.col("high")).otherwise(F.col("low")).alias("x"),
        F.col("m").alias("m_close"),
    )
    if broadcast_edges:
        hits = wedges(ordered, True, pairs_per_task).join(F.broadcast(closing), ["z", "x"])
        return hits.groupBy("z", "x", "m_close").agg(*measures)
    ins, outs = _ends(ordered)
    counts = pair_counts(ins, outs)
    heavy, total = heavy_starts(keep(pairs_of_starts(ins, counts), "starts"), pairs_per_task)
    nothing = F.lit(None).cast("bigint")
    # A closing edge is a list of its own, so that it is where the wedges of its x are.
    closes = closing.select(
        "x", nothing.alias("m_in"), F.array("z").alias("ids"), F.array(nothing).alias("copies"), "m_close"
    )
    lists = join_lists(ins, outs, counts, pairs_per_task).withColumn("m_close", nothing).unionByName(closes)
    tasks = max(2, 2 * deal_tasks(ordered, total + ordered.count()))
    pairs = sums_by_pair(lists, heavy, tasks, False, *measures, F.max("m_close").alias("m_close"), F.count("m_in").alias("met"))
    return pairs.where("m_close IS NOT NULL AND met > 0").drop("met")


def triangle_count(
    edges: DataFrame,
    max_id: int | None = None,
    strategy: str = "shuffle",
    max_broadcast_rows: int = BROADCAST_ROWS,
    pairs_per_task: int = PAIRS_PER_TASK,
    edges_per_task: int = EDGES_PER_TASK,
) -> DataFrame:
    """One row ``triangles``: directed 3-cycles of the simple graph, each once.

    ``strategy="broadcast"`` ships the edges whole to every task if there are
    at most ``max_broadcast_rows`` of them and shuffles otherwise. ``"partition"`` counts
    the subgraphs of triples of node classes, each of at most ``edges_per_task`` edges, and
    shuffles where that takes too many classes. ``"intersect"`` intersects neighbour sets.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    weighted = keep(weighted_edges(max_filter(edges, max_id)), "weighted")
    ordered = ordered_edges(weighted)
    total = F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("triangles")
    if strategy == "intersect":
        return closed_sets(ordered).agg(total)
    if strategy == "partition":
        classes = class_count(ordered, edges_per_task)
        if classes:
            return cycle_counts(ordered, classes, edges_per_task).agg(total)
    small = strategy == "broadcast" and fits_broadcast(ordered, max_broadcast_rows)
    pairs = closed_pairs(
        ordered,
        F.count("m_in").alias("n"),
        broadcast_edges=small,
        pairs_per_task=pairs_per_task,
    )
    return pairs.agg(total)


def _wide(term: str) -> str:
    return f"CAST({term} AS {EXACT})"


def triangle_work(edges: DataFrame, edges_per_task: int = EDGES_PER_TASK) -> DataFrame:
    """One row ``(edges, wedges, classes, copies)``: rows that the ways to count would shuffle.

    ``edges`` are those that can be on a cycle, ``wedges`` the pairs that "shuffle" forms, ``copies`` the edges
    that "partition" sends for its ``classes`` (null if it takes too many).
    """
    spark = edges.sparkSession
    ordered = ordered_edges(keep(weighted_edges(edges), "weighted"))
    later = ordered.groupBy("low").agg(
        (F.count_if(~F.col("out")) * F.count_if("out")).alias("w"), F.count(F.lit(1)).alias("e")
    )
    n, wedges_ = later.agg(F.coalesce(F.sum("e"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0))).first()
    classes = class_count(ordered, edges_per_task)
    row = (n, wedges_, classes, classes and classes * n)
    return spark.createDataFrame([row], "edges BIGINT, wedges BIGINT, classes BIGINT, copies BIGINT")


MODES = ("all", "semi", "set")


def closed_walks(
    edges: DataFrame,
    mode: str = "all",
    max_id: int | None = None,
    pairs_per_task: int = PAIRS_PER_TASK,
    strategy: str = "shuffle",
    max_len: int = MAX_LEN,
) -> DataFrame:
    """One row ``hits``, DECIMAL(38,0): closed walks a -> b -> c -> a on a multigraph.

    Every starting point counts. The modes differ in how copies of an edge
    and self-loops count:

    * ``all`` - each copy of each of the three edges is a walk of its own;
    * ``semi`` - copies of the first two edges count, the closing edge only
      has to exist, and walks whose second edge leads back to a are left out;
    * ``set`` - copies of the first edge count, the other two have to exist.

    Walks over three different nodes come from the 3-cycles, each cycle
    giving three starting points at once. The rest uses a self-loop: l copies
    of the loop at v, together with the pairs of edges v -> u, u -> v.
    ``strategy="intersect"`` finds the cycles by neighbour sets of at most ``max_len``.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    if strategy not in ("shuffle", "intersect"):
        raise ValueError(f"unknown strategy {strategy!r}")
    weighted = keep(weighted_edges(max_filter(edges, max_id)), "weighted")
    ordered = ordered_edges(weighted)

    # Three different nodes: x -> y, y -> z, z -> x with a, b, c copies.
    if strategy == "intersect":
        pairs = closed_sets(ordered, max_len)
    else:
        pairs = closed_pairs(
            ordered,
            F.count("m_in").alias("n"),
            F.sum("m_in").alias("a"),
            F.sum("m_out").alias("b"),
            F.sum(F.col("m_in") * F.col("m_out")).alias("ab"),
            pairs_per_task=pairs_per_task,
        )
    # Decimal products: three copy counts multiplied can exceed BIGINT.
    by_cycle = {
        "all": f"3 * {_wide('ab')} * m_close",
        "semi": f"ab + {_wide('a + b')} * m_close",
        "set": f"a + b + {_wide('n')} * m_close",
    }

    # Two different nodes or one: only nodes with a self-loop take part.
    loops = weighted.where("src = dst").select(
        F.col("src").alias("v"), F.col("m").alias("l")
    )
    touched = ordered
    if fits_broadcast(loops):  # else most nodes may have one
        looped_ids = loops.select("v")
        touched = ordered.join(F.broadcast(looped_ids), F.col("low") == F.col("v"), "left_semi").unionByName(
            ordered.join(F.broadcast(looped_ids), F.col("high") == F.col("v"), "left_semi")
        ).distinct()
    mutual = (
        touched
        .groupBy("low", "high")
        .agg(
            F.sum(F.when(F.col("out"), F.col("m"))).alias("f"),
            F.sum(F.when(~F.col("out"), F.col("m"))).alias("r"),
        )
        .where("f IS NOT NULL AND r IS NOT NULL")
    )
    per_node = (
        mutual.select(F.explode(F.array("low", "high")).alias("v"), "f", "r")
        .groupBy("v")
        .agg(
            F.count(F.lit(1)).alias("k"),
            F.sum(F.col("f") + F.col("r")).alias("s"),
            F.sum(F.col("f") * F.col("r")).alias("fr"),
        )
    )
    looped = loops.join(per_node, "v", "left").na.fill(0, ["k", "s", "fr"])
    by_loop = {
        "all": f"{_wide('l')} * l * l + 3 * {_wide('l')} * fr",
        "semi": f"{_wide('l')} * s",
        "set": f"l + {_wide('l')} * k + s",
    }

    def term(df: DataFrame, text: str) -> DataFrame:
        return df.select(F.expr(text).cast(EXACT).alias("h"))

    hits = term(pairs, by_cycle[mode]).unionByName(term(looped, by_loop[mode]))
    total = F.coalesce(F.sum("h").cast(EXACT), F.lit(0).cast(EXACT))
    return hits.agg(total.alias("hits"))
