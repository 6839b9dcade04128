"""Centroid clustering of integer vectors with ns-bounds.

Lloyd's rounds, without most of their distances. Every vector keeps the exact distance to its
centroid and, for each group of centroids, a lower bound of the distance to the others in it,
together with the round each was taken in. All former centroids are kept (``history``), so a
bound is loosened by the norm of the *total* displacement of a centroid since that round. This is
never more than the sum of its moves round by round, and nothing at all for one that came back.
A vector whose bounds still part it from all other centroids keeps its own unseen; else its
distance is taken anew, and the groups that still fail are scanned exactly. Bounds are compared
with a margin against rounding, and ties are scanned, so the result is Lloyd's own.

A round reads a table of vectors and bounds and writes the next one in the shared folder; nothing
is shuffled but the sums of vectors that changed their cluster, summed before. The driver holds
``k`` centroids of each round. The table before is deleted when the next one stands.

Vectors count with exactly ``dims`` components, none null or non-finite; others are left out. Null
ids are like any other value, repeated rows count each, other columns are not read. With fewer
than ``k`` vectors each is a centroid; with none the result is empty. Components are
``floor(scale * x)`` and must stay below 2**27, so that squared distances fit 64 bits: larger
ones are an error before the first round. Sums of a cluster's components and distances have to
fit 64 bits too, else Spark reports an overflow.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeloom.storage import delete, new_path

LARGEST = 2**27
PER_GROUP = 8
# Elements of a block of rows in memory: rows times components and centroids.
BLOCK = 2**20
# More than the rounding of a square root and a sum; relative.
MARGIN = 1e-9
FAR = np.iinfo(np.int64).max


def integers(vectors: DataFrame, key: str, column: str, dims: int, scale: int) -> DataFrame:
    """``(key, v)`` of the vectors that count, components as whole numbers."""
    x = F.col(column)
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("bigint"))
    return vectors.where((F.size(x) == dims) & whole).select(F.col(key).alias("key"), scaled.alias("v"))


def first_centroids(table: DataFrame, k: int, salt: str) -> np.ndarray:
    """The vectors with the least hashes of their ids, in that order; at most ``k`` rows."""
    name = F.concat(F.lit(salt), F.coalesce(F.col("key").cast("string"), F.lit("")))
    rows = table.select(F.sha2(name, 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def groups_of(k: int) -> np.ndarray:
    """Group of each centroid: runs of ``PER_GROUP``."""
    return np.arange(k) // PER_GROUP


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows and centroids, as int64."""
    dims = x.shape[1]
    largest = max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0))
    if dims * (2 * int(largest)) ** 2 < 2**53:
        # Whole numbers this small are exact as floats, whatever the order of summing.
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        out = (a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)[None, :]
        return out.astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in centroids], axis=1)


def to_own(x: np.ndarray, centroids: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to its own centroid."""
    return ((x - centroids[label]) ** 2).sum(1)


def displacement(history: np.ndarray) -> np.ndarray:
    """``[round, centroid]``: way from its place in that round to the last one, rounded up."""
    way = (history[-1][None, :, :] - history).astype(np.float64)
    return np.sqrt((way * way).sum(2)) * (1 + MARGIN)


class Round:
    """One assignment to the last centroids of ``history``; called on blocks of rows."""

    def __init__(self, history: np.ndarray, exact: bool) -> None:
        self.now = len(history) - 1
        self.centroids = history[-1]
        self.k = len(self.centroids)
        self.group = groups_of(self.k)
        self.n_groups = int(self.group[-1]) + 1
        self.moved = displacement(history)
        self.group_moved = np.stack(
            [self.moved[:, self.group == g].max(1) for g in range(self.n_groups)], axis=1
        )
        self.exact = exact

    def first(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """All distances, as no bounds are known."""
        rows = np.arange(len(x))
        found = squared(x, self.centroids)
        label = found.argmin(1)
        dist = found[rows, label]
        others = found.astype(np.float64)
        others[rows, label] = np.inf
        low = np.stack([others[:, self.group == g].min(1) for g in range(self.n_groups)], axis=1)
        return {
            "cluster": label,
            "dist": dist,
            "at": np.full(len(x), self.now),
            "low": np.sqrt(low) * (1 - MARGIN),
            "low_at": np.full(low.shape, self.now),
            "scanned": np.full(len(x), self.k),
        }

    def next(self, x: np.ndarray, old: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        label, dist, at = old["cluster"].copy(), old["dist"].copy(), old["at"].copy()
        low, low_at = old["low"].copy(), old["low_at"].copy()
        scanned = np.zeros(len(x), np.int64)
        up = np.sqrt(dist.astype(np.float64)) * (1 + MARGIN) + self.moved[at, label]
        below = low - self.group_moved[low_at, np.arange(self.n_groups)[None, :]]

        rows = np.flatnonzero(up >= below.min(1))
        own, before = to_own(x[rows], self.centroids, label[rows]), label[rows]
        dist[rows], at[rows] = own, self.now
        scanned[rows] = 1
        up = np.sqrt(own.astype(np.float64)) * (1 + MARGIN)
        fails = below[rows] <= up[:, None]
        near, second, number = self._scan(x[rows], before, fails)
        scanned[rows] += (fails * np.bincount(self.group)[None, :]).sum(1)

        # Groups stand in the order of their numbers, so the first of equal distances is the least.
        group = near.argmin(1)
        every = np.arange(len(rows))
        wins = (near[every, group] < own) | (
            (near[every, group] == own) & (number[every, group] < before)
        )
        label[rows[wins]] = number[wins, group[wins]]
        dist[rows[wins]] = near[wins, group[wins]]

        # What bounds a group is its nearest centroid but the own one.
        near[wins, group[wins]] = second[wins, group[wins]]
        bound = np.where(near == FAR, np.inf, near.astype(np.float64))
        bound = np.where(fails, np.sqrt(bound) * (1 - MARGIN), below[rows])
        left = np.sqrt(own[wins].astype(np.float64)) * (1 - MARGIN)
        lost = self.group[before[wins]]
        bound[wins, lost] = np.minimum(bound[wins, lost], left)
        new = fails.copy()
        new[wins, lost] = True
        low[rows] = np.where(new, bound, low[rows])
        low_at[rows] = np.where(new, self.now, low_at[rows])
        if self.exact:
            late = np.flatnonzero(at != self.now)
            dist[late], at[late] = to_own(x[late], self.centroids, label[late]), self.now
        return {
            "cluster": label, "dist": dist, "at": at, "low": low, "low_at": low_at, "scanned": scanned,
        }

    def _scan(self, x, own, fails) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the groups that failed: least and second distance and least number, own centroids apart."""
        near = np.full(fails.shape, FAR)
        second, number = near.copy(), np.zeros(fails.shape, np.int64)
        for g in range(self.n_groups):
            rows = np.flatnonzero(fails[:, g])
            if not len(rows):
                continue
            members = np.flatnonzero(self.group == g)
            found = squared(x[rows], self.centroids[members])
            found[own[rows][:, None] == members[None, :]] = FAR
            every, best = np.arange(len(rows)), found.argmin(1)
            near[rows, g], number[rows, g] = found[every, best], members[best]
            found[every, best] = FAR
            second[rows, g] = found.min(1)
        return near, second, number


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(values.reshape(-1), kind))


def _assigner(history: np.ndarray, exact: bool):
    """A map over Arrow batches of vectors, with bounds unless this is the first round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = Round(history, exact)
        dims = history.shape[2]
        rows = max(1, BLOCK // (dims + step.k))
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                x = _matrix(part["v"], dims)
                if step.now:
                    old = {n: part[n].to_numpy(zero_copy_only=False) for n in ("cluster", "dist", "at")}
                    old |= {n: _matrix(part[n], step.n_groups) for n in ("low", "low_at")}
                    new, was = step.next(x, old), old["cluster"]
                else:
                    new, was = step.first(x), np.full(len(x), -1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["key"],
                        part["v"],
                        pa.array(new["cluster"], pa.int32()),
                        pa.array(was, pa.int32()),
                        pa.array(new["dist"], pa.int64()),
                        pa.array(new["at"], pa.int32()),
                        _lists(new["low"], pa.float64()),
                        _lists(new["low_at"], pa.int32()),
                        pa.array(new["scanned"], pa.int32()),
                    ],
                    ["key", "v", "cluster", "was", "dist", "at", "low", "low_at", "scanned"],
                )

    return run


def _schema(key: T.DataType) -> T.StructType:
    fields = T.StructType([T.StructField("key", key)])
    rest = "v array<bigint>, cluster int, was int, dist bigint, at int, low array<double>, low_at array<int>, scanned int"
    for field in T.StructType.fromDDL(rest):
        fields.add(field)
    return fields


def _changes(state: DataFrame, dims: int) -> dict[int, tuple[int, list[int]]]:
    """Rows and component sums by which each cluster grew; one row a cluster."""
    ends = F.array(
        F.struct(F.col("cluster").alias("c"), F.lit(1).alias("sign")),
        F.struct(F.col("was").alias("c"), F.lit(-1).alias("sign")),
    )
    moved = state.where("cluster <> was").select("v", F.explode(ends).alias("e")).where("e.c >= 0")
    sign = F.col("e.sign").cast("bigint")
    sums = [F.sum(sign * F.col("v")[i]).alias(f"s{i}") for i in range(dims)]
    rows = moved.groupBy(F.col("e.c").alias("c")).agg(F.sum(sign).alias("n"), *sums).collect()
    return {r.c: (r.n, [r[f"s{i}"] for i in range(dims)]) for r in rows}


class _Table:
    """A table in the shared folder, replaced round by round."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.path = spark, None

    def replace(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(self.spark, name)
        df.write.parquet(path)
        if self.path:
            delete(self.spark, self.path)
        self.path = path
        return self.spark.read.schema(df.schema).parquet(path)


def fit(
    vectors: DataFrame,
    key: str = "vec_id",
    column: str = "embedding",
    dims: int = 64,
    k: int = 40,
    rounds: int = 5,
    scale: int = 256,
    salt: str = "2:",
    watch=None,
) -> tuple[DataFrame, np.ndarray]:
    """``(key, cluster, distance)`` of the kept vectors, and the centroids of every round.

    ``watch`` is called with each round's table, which has the number of distances taken
    (``scanned``) in each row.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[key].dataType
    table = _Table(spark)
    state = table.replace(integers(vectors, key, column, dims, scale), "vectors")
    largest = state.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0]
    if largest is not None and largest >= LARGEST:
        raise ValueError(f"a component is {largest} after scaling; below {LARGEST} is allowed")
    history = first_centroids(state, k, salt).reshape(1, -1, dims)
    if not history.shape[1]:
        return state.select("key", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), history

    totals = [[0, [0] * dims] for _ in range(history.shape[1])]
    for now in range(rounds + 1):
        assign = _assigner(history, exact=now == rounds)
        state = table.replace(state.mapInArrow(assign, _schema(kind)), f"round-{now}")
        if watch:
            watch(state)
        if now == rounds:
            break
        for c, (n, sums) in _changes(state, dims).items():
            totals[c][0] += n
            totals[c][1] = [a + b for a, b in zip(totals[c][1], sums, strict=True)]
        # Python's // rounds down, on whole numbers of any size.
        new = [
            [s // n for s in sums] if n else [int(x) for x in history[-1][c]]
            for c, (n, sums) in enumerate(totals)
        ]
        history = np.concatenate([history, np.array(new, np.int64)[None]])
    return state.select("key", "cluster", F.col("dist").alias("distance")), history


def cluster(vectors: DataFrame, key: str = "vec_id", **options) -> DataFrame:
    """``(key, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of the kept vectors."""
    found, history = fit(vectors, key, **options)
    spark = vectors.sparkSession
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total = sum(int(r.s) for r in sums)
    named = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in history[-1]]
    rows = [(r.cluster, int(r.s), total, named[r.cluster]) for r in sums]
    table = spark.createDataFrame(
        rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    # At most k rows.
    out = found.join(F.broadcast(table), "cluster")
    return out.select(F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
