"""Directed 3-cycles counted class by class, without shuffling wedges.

Nodes are hashed into p classes. The task of one triple of classes gets all edges between them and
counts the cycles of its own subgraph whose nodes are in just these three classes, so each cycle counts
once. Every edge is copied to the p triples that hold both its classes. (S. Suri and S.
Vassilvitskii, "Counting triangles and the curse of the last reducer", 2011.) An edge is not sent to a
triple whose third class has no node that could close a cycle with it.

p is taken so that no triple can have more than ``edges_per_task`` edges, by the counted edges between
classes. Shuffled rows are at most p times the edges; that is less than the wedges where these are many, and
at most ``MOST_CLASSES`` times the edges: beyond it the caller takes another way.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.operators.skew import hot_limit, hot_rows, split_join, task_count
from edgeloom.storage import keep

EDGES_PER_TASK = 2**18
MOST_CLASSES = 256
EDGES_PER_GROUP = 2**16
# Wedges held at a time.
CHUNK = 2**21


def _classed(ordered: DataFrame, p: int) -> DataFrame:
    def number(c: str):
        return F.pmod(F.xxhash64(c), F.lit(p)).cast("int")

    return ordered.select("*", number("low").alias("a"), number("high").alias("b"))


def class_count(ordered: DataFrame, edges_per_task: int = EDGES_PER_TASK) -> int | None:
    """The least p of a doubling row that keeps every triple small; None if none does.

    A triple holds the edges inside three classes and between three pairs of them.
    """
    total = ordered.count()
    p = max(1, math.isqrt(6 * total // edges_per_task))
    while p <= MOST_CLASSES:
        pairs = _classed(ordered, p).groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        inside = F.max(F.when(F.col("a") == F.col("b"), F.col("count")))
        between = F.max(F.when(F.col("a") != F.col("b"), F.col("count")))
        most = pairs.count().agg(inside.alias("i"), between.alias("b")).first()
        bound = (3 if p > 2 else p) * (most.i or 0) + (3 if p > 2 else p - 1) * (most.b or 0)
        if bound <= edges_per_task:
            return p
        p *= 2
    return None


def cycles_between(low, high, out, a, b, triple: tuple[int, int, int]) -> int:
    """Cycles of the subgraph given by its edges whose nodes' classes are ``triple``.

    ``low`` comes before ``high`` in the order of all nodes; ``out`` edges leave ``low``.
    A cycle is found from its first node y, as x -> y -> z with z -> x.
    """
    names, at = np.unique(np.concatenate([low, high]), return_inverse=True)
    n = len(names)
    low, high = at[: len(low)], at[len(low) :]
    kind = np.empty(n, np.int64)
    kind[low], kind[high] = a, b
    edges = np.sort(np.where(out, low * n + high, high * n + low))
    order = np.argsort(low[out], kind="stable")
    y_out, z_out = low[out][order], high[out][order]
    y_in, x_in = low[~out], high[~out]
    first = np.searchsorted(y_out, y_in, "left")
    many = np.searchsorted(y_out, y_in, "right") - first
    ends, found = np.cumsum(many), 0
    want = np.array(sorted(triple))
    start = 0
    while start < len(y_in):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + CHUNK, "right")))
        part = slice(start, stop)
        size = many[part]
        place = np.repeat(first[part], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        x, z, y = np.repeat(x_in[part], size), z_out[place], np.repeat(y_in[part], size)
        key = z * n + x
        spot = np.searchsorted(edges, key)
        closed = edges[np.minimum(spot, len(edges) - 1)] == key
        classes = np.sort(np.stack([kind[x[closed]], kind[y[closed]], kind[z[closed]]], axis=1), axis=1)
        found += int((classes == want).all(axis=1).sum())
        start = stop
    return found


def triple_edges(ordered: DataFrame, p: int, third: Column | None = None) -> DataFrame:
    """``(triple, low, high, ends)``: each edge once for each triple of classes that holds it.

    ``third``, an array of classes, leaves out triples with another third class. ``triple`` is a number to base p,
    as is ``ends``, the classes of both ends, times two, plus one for ``out``.
    """
    every = F.sequence(F.lit(0), F.lit(p - 1))
    three = F.array_sort(F.array("a", "b", "c"))
    code = (three[0].cast("bigint") * p + three[1]) * p + three[2]
    return (
        _classed(ordered, p)
        .withColumn("c", F.explode(every if third is None else third))
        .select(
            code.alias("triple"),
            "low",
            "high",
            ((F.col("a") * p + F.col("b")) * 2 + F.col("out").cast("int")).alias("ends"),
        )
    )


def _class_bits(classed: DataFrame, node: str, other: str, p: int) -> DataFrame:
    """``(node, n, bits)``: a bit for each class of the nodes at the other ends; 64 to a number."""
    words = [
        f"bit_or(CASE WHEN {other} div 64 = {k} THEN shiftleft(1L, CAST({other} % 64 AS INT)) ELSE 0L END)"
        for k in range(-(-p // 64))
    ]
    return classed.groupBy(node).agg(
        F.count(F.lit(1)).alias("n_left"), F.expr(f"array({', '.join(words)})").alias(f"{node}_bits")
    )


def with_thirds(ordered: DataFrame, p: int) -> DataFrame:
    """``(low, high, out, thirds)``: bits of the classes where an edge u -> v can find its third node w.

    Some edge v -> w and some edge w -> u have to end in the class, so an edge is copied to at most as many
    triples as v has out-edges and u in-edges, however many classes there are.
    """
    a, b = F.col("a"), F.col("b")
    ends = _classed(ordered, p).select(
        F.when(F.col("out"), F.col("low")).otherwise(F.col("high")).alias("u"),
        F.when(F.col("out"), F.col("high")).otherwise(F.col("low")).alias("v"),
        F.when(F.col("out"), a).otherwise(b).alias("u_class"),
        F.when(F.col("out"), b).otherwise(a).alias("v_class"),
        "out",
    )
    limit = hot_limit(ordered.count())
    found = ends.drop("u_class", "v_class")
    for node, other, at, of in (("u", "v", "v", "u_class"), ("v", "u", "u", "v_class")):
        # u's in-edges come from rows where it is v, and v's out-edges from those where it is u.
        sets = keep(_class_bits(ends.select(F.col(at).alias(node), of), node, of, p), "class_bits")
        # Rows of a node on the side that is joined.
        counts = ends.groupBy(node).agg(F.count(F.lit(1)).alias("n_left")).withColumn("n_right", F.lit(1))
        found = split_join(found, sets.drop("n_left"), node, (other, node), hot_rows(counts, node, limit))
    both = F.zip_with("u_bits", "v_bits", lambda x, y: x.bitwiseAND(y))
    low = F.when(F.col("out"), F.col("u")).otherwise(F.col("v")).alias("low")
    high = F.when(F.col("out"), F.col("v")).otherwise(F.col("u")).alias("high")
    rows = found.select(low, high, "out", both.alias("thirds"))
    return keep(rows.where(F.exists("thirds", lambda w: w != 0)), "thirds")


def cycle_counts(ordered: DataFrame, p: int, edges_per_task: int = EDGES_PER_TASK) -> DataFrame:
    """``(triple, n)``: cycles over each triple of classes that has one.

    A group of triples of about ``EDGES_PER_GROUP`` edges, or one triple, is handed to Python at a time.
    """
    edges = with_thirds(ordered, p)
    ones = F.aggregate("thirds", F.lit(0), lambda n, w: n + F.bit_count(w))
    copies = edges.agg(F.coalesce(F.sum(ones), F.lit(0))).first()[0]
    tasks = task_count(ordered.sparkSession, copies, max(1, edges_per_task // 16), 4 * EDGES_PER_TASK)
    third = F.expr(
        f"filter(sequence(0, {p - 1}), c -> shiftrightunsigned(thirds[c div 64], c % 64) & 1L = 1L)"
    )
    groups = max(tasks, -(-copies // EDGES_PER_GROUP))
    group = F.pmod(F.xxhash64("triple"), F.lit(groups)).alias("group")
    spread = triple_edges(edges, p, third).select(group, "triple", "low", "high", "ends").repartition(tasks, "group")

    def count(table: pa.Table) -> pa.Table:
        table = table.sort_by("triple")
        triple, low, high, ends = (table[c].to_numpy() for c in ("triple", "low", "high", "ends"))
        cuts = np.flatnonzero(np.diff(triple, prepend=-1, append=-1))
        names, found = [], []
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            code, part = int(triple[start]), slice(start, stop)
            both = ends[part] >> 1
            three = (code // p**2, code // p % p, code % p)
            n = cycles_between(low[part], high[part], (ends[part] & 1).astype(bool), both // p, both % p, three)
            if n:
                names.append(code)
                found.append(n)
        return pa.table({"triple": pa.array(names, pa.int64()), "n": pa.array(found, pa.int64())})

    return spread.groupBy("group").applyInArrow(count, "triple bigint, n bigint")
