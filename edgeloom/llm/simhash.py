"""SimHash near-duplicates by a hierarchical index over fingerprints in Gray order.

A fingerprint has the bits that are set in over half the XXH64 hashes of a text's word shingles.
Two texts are linked when their fingerprints differ in at most ``most`` bits.

**The index.** Fingerprints are sorted by Gray rank (the place of the pattern in the reflected Gray
code), so that neighbours share long bit patterns. Runs of them are leaves. A leaf's node holds the
bits that all its fingerprints share, as a mask and a pattern; the runs of nodes above share fewer,
up to one node for each bucket. Two nodes are compared by the differences gathered in the bits
both share: at more than ``most`` no pair below can be a link, and both whole groups are left.
What remains is compared bit by bit, within leaves first by nodes of 16 fingerprints.

**Spread.** Of ``most + 1`` blocks of bits at least one is equal in any link. So each distinct
fingerprint is filed once for each block, in the bucket of that block's bits; with more
fingerprints, more blocks of which several have to be equal keep buckets small (``blocks_for``).
All of it is one table, range-partitioned by bucket and Gray rank: a large bucket is cut over many
tasks by rank, and its leaves meet only where the nodes above them, joined level by level, are near.

Equal fingerprints are counted once, whatever the number of texts. A leaf pair gives one link for each
fingerprint and local component, not all pairs: components stay the same. Null and empty
texts, and those of blanks, have fingerprint zero, linked like any other. Long texts are hashed in
pieces. Repeated rows and null ids count like any row; a component of rows without ids has a
null id. Only the two columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.components import components
from edgeloom.llm.textblocks import lean, row_blocks, runs, utf8
from edgeloom.operators.skew import hot_limit, hot_rows, split_join
from edgeloom.storage import keep

SEED = 42
BITS = 64
MOST = 4
# Fingerprints of a leaf, of a node within a leaf, and nodes below a node.
LEAF = 256
TWIG = 16
FAN = 16
# Bytes of text and shingles hashed at a time.
BLOCK_BYTES = 2**18
SHINGLES = 2**15

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# ------------------------------------------------------------------ fingerprints


def _votes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many of the shingles, ``starts`` to ``ends`` in ``text``, have each bit set."""
    votes = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, len(starts), SHINGLES):
        spans = zip(starts[k : k + SHINGLES].tolist(), ends[k : k + SHINGLES].tolist(), strict=True)
        hashes = np.array([digest(text[a:b], SEED) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(0, dtype=np.int64)
    return votes


def _is_blank(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """Fingerprint of each text of a block of bytes, unsigned."""
    data = _LOWER[data]
    starts, ends, rows = runs(~_is_blank(data), offsets)
    out = np.zeros(len(offsets) - 1, np.uint64)
    # Words with one blank after each, so that any run of words is a slice.
    lengths = ends - starts + 1
    at = np.concatenate([[0], np.cumsum(lengths)])
    joined = np.full(at[-1], 32, np.uint8)
    inside = np.arange(at[-1]) - np.repeat(at[:-1], lengths)
    word = inside < np.repeat(lengths - 1, lengths)
    joined[word] = data[(np.repeat(starts, lengths) + inside)[word]]
    text = joined.tobytes()
    bounds = np.searchsorted(rows, np.arange(len(offsets)))
    weights = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
    for row in np.flatnonzero(np.diff(bounds)):
        first, last = bounds[row], bounds[row + 1]
        n = max(1, last - first - size + 1)
        begin = at[first : first + n]
        end = at[first + min(size, last - first) : last + 1] - 1
        out[row] = weights[2 * _votes(text, begin, end) > n].sum(dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``(key, fp)`` of every row; ``fp`` is the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch["text"])
            found = [np.empty(0, np.uint64)]
            for first, last in row_blocks(offsets, BLOCK_BYTES):
                part = data[offsets[first] : offsets[last]]
                found.append(fingerprints_of(part, offsets[first : last + 1] - offsets[first], size))
            fp = np.concatenate(found).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(fp)], ["key", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return source.mapInArrow(lean(run), f"key {kind}, fp bigint")


# ------------------------------------------------------------------ the index


def gray_rank(pattern: np.ndarray) -> np.ndarray:
    """Place of each pattern in the reflected Gray code."""
    rank = pattern.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def blocks_for(n: int, most: int) -> int:
    """Blocks of bits, so that buckets of evenly spread fingerprints stay near a leaf's size.

    Links are the same for any number above ``most``; ``C(blocks, most)`` rows are filed for
    each fingerprint.
    """
    blocks = most + 1
    while blocks < most + 4 and n / 2 ** (BITS * (blocks - most) // blocks) > 4 * LEAF:
        blocks += 1
    return blocks


def layouts(blocks: int, most: int) -> list[list[tuple[int, int]]]:
    """For each choice of equal blocks: all blocks as (shift, width), the equal ones in front."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    spans = [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
    return [
        [spans[i] for i in equal] + [s for i, s in enumerate(spans) if i not in equal]
        for equal in combinations(range(blocks), blocks - most)
    ]


def arrange(fp: np.ndarray, layout: list[tuple[int, int]]) -> np.ndarray:
    """The blocks of ``fp`` in the order of ``layout``, the first one highest."""
    out = np.zeros(len(fp), np.uint64)
    for shift, width in layout:
        out = (out << np.uint64(width)) | ((fp >> np.uint64(shift)) & np.uint64(2**width - 1))
    return out


def _filed(distinct: DataFrame, blocks: int, most: int) -> DataFrame:
    """``(copy, bucket, rank, fp)``: each fingerprint once for each layout."""
    ways = layouts(blocks, most)
    equal = [sum(width for _, width in way[: blocks - most]) for way in ways]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = np.uint64(2**63)
        for batch in batches:
            fp = batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            for copy, way in enumerate(ways):
                front = arrange(fp, way)
                bucket = (front >> np.uint64(BITS - equal[copy])).astype(np.int64)
                # Signed numbers in the order of unsigned ones.
                rank = (gray_rank(front) ^ sign).view(np.int64)
                columns = [np.full(len(fp), copy, np.int32), bucket, rank, fp.view(np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], ["copy", "bucket", "rank", "fp"]
                )

    return distinct.select("fp").mapInArrow(run, "copy int, bucket bigint, rank bigint, fp bigint")


def shared_bits(ones: np.ndarray, any_bit: np.ndarray) -> np.ndarray:
    """Mask of the bits that are equal in all patterns with this conjunction and disjunction."""
    return ~(ones ^ any_bit)


def _twigs(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First places, shared patterns and masks of runs of ``TWIG`` fingerprints."""
    at = np.arange(0, len(fp), TWIG)
    ones, any_bit = np.bitwise_and.reduceat(fp, at), np.bitwise_or.reduceat(fp, at)
    return at, ones, shared_bits(ones, any_bit)


def near_pairs(a: np.ndarray, b: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of two leaves that differ in at most ``most`` bits."""
    at_a, ones_a, mask_a = _twigs(a)
    at_b, ones_b, mask_b = _twigs(b)
    gathered = (ones_a[:, None] ^ ones_b[None, :]) & mask_a[:, None] & mask_b[None, :]
    i, j = np.nonzero(np.bitwise_count(gathered) <= most)
    inside = np.arange(TWIG)
    # The last run may be short: its last fingerprint stands in for what is missing.
    left = np.minimum(at_a[i][:, None] + inside, len(a) - 1)
    right = np.minimum(at_b[j][:, None] + inside, len(b) - 1)
    near = np.bitwise_count(a[left][:, :, None] ^ b[right][:, None, :]) <= most
    pair, x, y = np.nonzero(near)
    return left[pair, x], right[pair, y]


def star_links(values: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For links of places ``i`` and ``j``: one to the first of its component for each other place."""
    label = np.arange(len(values))
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            break
        label = new
    other = np.flatnonzero(label != np.arange(len(values)))
    return values[label[other]], values[other]


_LEAF = "kind int, copy int, bucket bigint, part int, seq int, ones bigint, any_bit bigint, fps binary, a bigint, b bigint"
_NAMES = [f.split()[0] for f in _LEAF.split(", ")]
_KINDS = {"kind": pa.int32(), "copy": pa.int32(), "part": pa.int32(), "seq": pa.int32(), "fps": pa.binary()}


def _rows(kind: int, columns: dict[str, list]) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    columns = columns | {"kind": [kind] * n}
    kinds = {name: _KINDS.get(name, pa.int64()) for name in _NAMES}
    arrays = [pa.array(columns.get(name, [None] * n), kinds[name]) for name in _NAMES]
    return pa.RecordBatch.from_arrays(arrays, _NAMES)


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    """Runs of at most ``LEAF`` fingerprints of one bucket, in order; a run may cross batches."""
    held, at = np.empty(0, np.uint64), None
    for batch in batches:
        copy, bucket = (batch[c].to_numpy(zero_copy_only=False) for c in ("copy", "bucket"))
        fp = batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(fp):
            continue
        new = np.flatnonzero((copy[1:] != copy[:-1]) | (bucket[1:] != bucket[:-1])) + 1
        for first, last in zip([0, *new.tolist()], [*new.tolist(), len(fp)], strict=True):
            here = (int(copy[first]), int(bucket[first]))
            if here != at:
                if len(held):
                    yield at, held
                held, at = np.empty(0, np.uint64), here
            for start in range(first, last, LEAF):
                held = np.concatenate([held, fp[start : min(last, start + LEAF)]])
                if len(held) > LEAF:
                    yield at, held[:LEAF]
                    held = held[LEAF:]
    if len(held):
        yield at, held


def _crowded(
    leaves: Iterator[tuple[tuple[int, int], np.ndarray]],
) -> Iterator[tuple[tuple[int, int], np.ndarray, bool]]:
    """Each leaf, and whether its bucket may have another one, here or in a neighbour partition."""
    held, first, several = None, None, False
    for at, fps in leaves:
        first = first or at
        if held:
            same = held[0] == at
            yield *held, same or several or held[0] == first
            several = same
        held = (at, fps)
    if held:
        yield *held, True


def _cutter(most: int):
    """A map over sorted partitions: leaves of crowded buckets (kind 0) and links within leaves (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        out, links = {n: [] for n in _NAMES[1:8]}, []
        for (copy, bucket), fps, crowded in _crowded(_leaves(batches)):
            if crowded:
                ends = [np.bitwise_and.reduce(fps), np.bitwise_or.reduce(fps)]
                ones, any_bit = np.array(ends, np.uint64).view(np.int64).tolist()
                row = [copy, bucket, part, seq, ones, any_bit, fps.tobytes()]
                for values, value in zip(out.values(), row, strict=True):
                    values.append(value)
                seq += 1
            if len(fps) > 1:
                i, j = near_pairs(fps, fps, most)
                apart = i < j
                if apart.any():
                    links.append(star_links(fps.view(np.int64), i[apart], j[apart]))
            if len(out["seq"]) >= 1024 or len(links) >= 1024:
                yield from _emitted(out, links)
                out, links = {n: [] for n in out}, []
        yield from _emitted(out, links)

    return run


def _emitted(leaves: dict[str, list], links: list) -> Iterator[pa.RecordBatch]:
    if leaves["seq"]:
        yield _rows(0, leaves)
    if links:
        a, b = (np.concatenate(x) for x in zip(*links, strict=True))
        yield _rows(1, {"a": a.tolist(), "b": b.tolist()})


def _comparer(most: int):
    """A map over pairs of leaves: the links between them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch["x_fps"], batch["y_fps"], strict=True):
                a, b = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                i, j = near_pairs(a, b, most)
                if len(i):
                    both = np.concatenate([a, b]).view(np.int64)
                    left, right = star_links(both, i, j + len(a))
                    yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], ["a", "b"])

    return run


def _numbered(leaves: DataFrame) -> DataFrame:
    """Leaves numbered one after the other in the order of bucket and rank."""
    spark = leaves.sparkSession
    # One row for each task that wrote leaves.
    counts = sorted(leaves.groupBy("part").count().collect())
    starts, total = [], 0
    for part, n in counts:
        starts.append((part, total))
        total += n
    offsets = spark.createDataFrame(starts, "part int, start bigint")
    return leaves.join(F.broadcast(offsets), "part").select(
        "copy", "bucket", (F.col("start") + F.col("seq")).alias("no"), "ones", "any_bit", "fps"
    )


def _side(nodes: DataFrame, side: str, *more: str) -> DataFrame:
    """Nodes as the ``x`` or ``y`` of a pair, with the number of the node above."""
    names = ("no", "ones", "any_bit", *more)
    up = F.floor(F.col("no") / FAN).cast("bigint").alias(f"{side}_up")
    return nodes.select("copy", "bucket", up, *(F.col(n).alias(f"{side}_{n}") for n in names))


def _near_nodes(most: int) -> Column:
    """Whether the differences gathered in the bits that both nodes share are few enough."""
    return F.expr(
        f"bit_count((x_ones ^ y_ones) & ~((x_ones ^ x_any_bit) | (y_ones ^ y_any_bit))) <= {most}"
    )


def _leaf_pairs(leaves: DataFrame, most: int) -> DataFrame | None:
    """Pairs of different leaves of one bucket that may hold a link, found from the top down."""
    per_bucket = leaves.groupBy("copy", "bucket").agg(
        F.count("*").alias("n"), F.min("no").alias("least"), F.max("no").alias("most")
    )
    crowded = keep(per_bucket.where("n > 1"), "crowded")
    apart = crowded.agg(F.max(F.expr("least ^ most"))).first()[0]
    if apart is None:
        return None
    nodes = leaves.join(crowded, ["copy", "bucket"], "left_semi").select("copy", "bucket", "no", "ones", "any_bit")
    levels = [keep(nodes, "nodes")]
    while FAN ** len(levels) <= apart:
        above = _side(levels[-1], "x").groupBy("copy", "bucket", F.col("x_up").alias("no"))
        levels.append(
            keep(above.agg(F.bit_and("x_ones").alias("ones"), F.bit_or("x_any_bit").alias("any_bit")), "nodes")
        )
    top = crowded.select("copy", "bucket", F.expr(f"least div {FAN ** len(levels)}").alias("no"))
    pairs = top.select("copy", "bucket", F.col("no").alias("x_no"), F.col("no").alias("y_no"))
    for level in reversed(levels):
        up = pairs.withColumnsRenamed({"x_no": "x_up", "y_no": "y_up"})
        below = up.join(_side(level, "x"), ["copy", "bucket", "x_up"]).join(
            _side(level, "y"), ["copy", "bucket", "y_up"]
        )
        below = below.where("x_no <= y_no").where(_near_nodes(most))
        pairs = keep(below.select("copy", "bucket", "x_no", "y_no"), "pairs")
    return pairs.where("x_no < y_no")


def links(distinct: DataFrame, most: int = MOST) -> DataFrame:
    """``(a, b)``: links that join the same fingerprints of ``distinct(fp)`` as all near pairs."""
    spark = distinct.sparkSession
    blocks = blocks_for(distinct.count(), most)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    filed = keep(_filed(distinct, blocks, most), "filed")
    placed = filed.repartitionByRange(tasks, "copy", "bucket", "rank").sortWithinPartitions(
        "copy", "bucket", "rank"
    )
    cut = keep(placed.select("copy", "bucket", "fp").mapInArrow(lean(_cutter(most)), _LEAF), "leaves")
    inside = cut.where("kind = 1").select("a", "b")
    leaves = _numbered(cut.where("kind = 0"))
    pairs = _leaf_pairs(leaves, most)
    if pairs is None:
        return inside
    with_x = pairs.join(_side(leaves, "x", "fps").select("copy", "bucket", "x_no", "x_fps"), ["copy", "bucket", "x_no"])
    both = with_x.join(_side(leaves, "y", "fps").select("copy", "bucket", "y_no", "y_fps"), ["copy", "bucket", "y_no"])
    across = both.select("x_fps", "y_fps").mapInArrow(lean(_comparer(most)), "a bigint, b bigint")
    return inside.union(across)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, most: int = MOST
) -> DataFrame:
    """``(key, fp, component_id)`` of every row: the least id of the texts it can reach by links."""
    found = keep(fingerprints(docs, key, text, size), "fingerprints")
    distinct = keep(
        found.groupBy("fp").agg(F.min("key").alias("first"), F.count("*").alias("n")), "distinct"
    )
    label = keep(components(links(distinct, most)), "components").select(F.col("node").alias("fp"), "label")
    firsts = label.join(distinct, "fp").groupBy("label").agg(F.min("first").alias("component"))
    linked = label.join(firsts, "label").select("fp", "component")
    ids = distinct.join(linked, "fp", "left").select(
        "fp", F.coalesce("component", "first").alias("component_id")
    )
    # A fingerprint of very many texts is dealt over stripes.
    counts = distinct.select("fp", F.col("n").alias("n_left"), F.lit(1).alias("n_right"))
    hot = hot_rows(counts, "fp", hot_limit(distinct.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]))
    out = split_join(found, ids, "fp", ("key", "fp"), hot)
    return out.select(F.col("key").alias(key), "fp", "component_id")
