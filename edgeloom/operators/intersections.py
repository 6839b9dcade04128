"""Directed 3-cycles by intersecting neighbour sets, edge by edge.

Nodes stand in the order of their degrees. The cycle over y1 < y2 < y3 is found from the edge between
y1 and y2: y3 is in the later out-neighbours of one end and in the later in-neighbours of the other. No
node has more than sqrt(2 * edges) later neighbours. Sets are sorted arrays, cut into parts of
at most ``max_len``; a part of one meets only those parts of the other whose range overlaps. What is
shuffled are sets, one row for each edge and part, instead of a row for each wedge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.operators.adjacency import weighted_sets
from edgeloom.operators.skew import ROWS_PER_STRIPE, hot_limit, hot_rows, split_join
from edgeloom.storage import keep

MAX_LEN = 2**12


def later_sets(ordered: DataFrame, out: bool, node: str, max_len: int) -> DataFrame:
    """``(node, part, ids, copies)``: later neighbours that edges lead to, or come from."""
    picked = ordered.where("out" if out else "NOT out").select(
        F.col("low").alias("src"), F.col("high").alias("dst"), "m"
    )
    return weighted_sets(keep(picked, "later"), max_len).select(
        F.col("src").alias(node),
        "part",
        F.col("neighbours").alias(f"{node}_ids"),
        F.col("copies").alias(f"{node}_copies"),
    )


def _joined(rows: DataFrame, sets: DataFrame, node: str, other: str, limit: int) -> DataFrame:
    """Add the sets of ``node``; nodes of very many edges are dealt over stripes."""
    left = rows.groupBy(node).agg(F.count(F.lit(1)).alias("n_left"))
    counts = left.withColumn("n_right", F.lit(1))
    return split_join(rows, sets, node, (other, "part"), hot_rows(counts, node, limit)).drop("part")


def closed_sets(
    ordered: DataFrame, max_len: int = MAX_LEN, rows_per_stripe: int = ROWS_PER_STRIPE
) -> DataFrame:
    """``(m_close, n, a, b, ab)`` for edges and parts of sets that have common nodes.

    ``n`` is their number; ``a`` and ``b`` sum the copies of the two edges at the common
    nodes, ``ab`` their products; ``m_close`` is the copies of the edge itself.
    """
    limit = hot_limit(ordered.count(), rows_per_stripe)
    rows = ordered.select(
        F.when(F.col("out"), F.col("high")).otherwise(F.col("low")).alias("to"),
        F.when(F.col("out"), F.col("low")).otherwise(F.col("high")).alias("from"),
        F.col("m").alias("m_close"),
    )
    both = _joined(rows, later_sets(ordered, True, "to", max_len), "to", "from", limit)
    both = _joined(both, later_sets(ordered, False, "from", max_len), "from", "to", limit)
    overlap = (F.col("to_ids")[0] <= F.element_at("from_ids", -1)) & (
        F.col("from_ids")[0] <= F.element_at("to_ids", -1)
    )
    met = both.where(overlap).withColumn("common", F.array_intersect("to_ids", "from_ids"))
    hits = met.where(F.size("common") > 0)

    def copies(side: str):
        known = F.map_from_arrays(f"{side}_ids", f"{side}_copies")
        return F.transform("common", lambda v: F.element_at(known, v))

    def total(array):
        return F.aggregate(array, F.lit(0).cast("bigint"), lambda s, x: s + x)

    products = F.zip_with(copies("to"), copies("from"), lambda x, y: x * y)
    return hits.select(
        "m_close",
        F.size("common").cast("bigint").alias("n"),
        total(copies("to")).alias("a"),
        total(copies("from")).alias("b"),
        total(products).alias("ab"),
    )
