"""Near-duplicate documents by an exact n-gram Jaccard join.

Two documents link when their sets of ``n``-word shingles have a Jaccard
similarity of at least ``percent`` / 100. The join is exact over the hashed
shingles: 64 bits each, and 64 bits for a whole set.

**Filter.** Under any total order of the tokens, two linked sets share a token
among the first ``size - ceil(t * size) + 1`` tokens of each. A pair is a
candidate only if that holds under each of several orders: it has to come out of
the join of every order's prefixes, and the results are intersected
before anything is verified. The first shared token also bounds the overlap by what
is left of either set behind it; so the smaller set's token has to be in a prefix of about
half the length, and texts that differ by many rare tokens never meet, however many
common ones they share. Before their sets are sent, the pairs left are held against
sketches: the number of a set's tokens in each of ``SKETCH`` classes. The sum of the lesser
numbers is never below the overlap, so what it rules out is no link. All orders put rare tokens first. How rare a
token is comes from a table of ``2**BUCKET_BITS`` counters over all documents, the
only thing that is broadcast; it has that size whatever the corpus. Within a power of
two of the count, each order is a random one of its own. Any such order is
valid, so the counters need not be exact.

**Large groups.** Equal sets are one node. Among the nodes that share a prefix
token, each is first verified against one leader, the node whose tokens are the
most common (the original of a family of near copies has no token that is rare).
Nodes found connected need not be compared any more: the full candidate
join then only takes pairs of different components, and of a token only
the nodes outside its largest component against the others. No pair within a
found group is ever formed, and none outside is left out.

A null text, an empty one, and one of blanks have an empty set and link with
nothing. A text of fewer words is one shingle. Repeated rows are documents with
equal sets. Rows without an id are documents too; they are never the id of a
component unless it has no other. Extra columns are not looked at.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgeloom.llm.components import components
from edgeloom.llm.textblocks import (
    lean,
    mix,
    row_blocks,
    runs,
    utf8,
    window_hashes,
    word_hashes,
)
from edgeloom.storage import keep

WORDS, PERCENT = 5, 80
ORDERS = 2
BUCKET_BITS = 20
SLICE_BITS = 16
# Above this many rows a token's group is summed up before it is shuffled.
HOT_BITS = 17
BROADCAST_ROWS = 2**20
SEEN = 2**20
FLUSH_ROWS = 2**16
EARLIER = 4
# Classes of a sketch, one byte each; a full byte rules nothing out.
SKETCH = 256

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_SEEDS = mix(np.arange(1, 17, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def shingle_sets(column: pa.Array, size: int):
    """For each row the sorted distinct hashes of its shingles."""
    all_data, all_offsets = utf8(column)
    for first, last in row_blocks(all_offsets):
        offsets = all_offsets[first : last + 1]
        data, offsets = all_data[offsets[0] : offsets[-1]], offsets - offsets[0]
        starts, ends, rows = runs(IS_WORD[data], offsets)
        words = word_hashes(data, starts, ends)
        hashes, at = window_hashes(words, rows, size)
        counts = np.bincount(rows, minlength=last - first)
        ends_of = np.searchsorted(rows[at], np.arange(last - first), "right")
        begin, word = 0, 0
        for row in range(last - first):
            n = int(counts[row])
            if 0 < n < size:
                own = words[word : word + n]
                yield window_hashes(own, np.zeros(n, np.int64), n)[0]
            else:
                yield np.unique(hashes[begin : ends_of[row]])
            begin, word = ends_of[row], word + n


def digest(shingles: np.ndarray) -> int:
    """64-bit name of a set, as a signed number."""
    with np.errstate(over="ignore"):
        total = mix(shingles ^ _SEEDS[15]).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def _bucket(shingles: np.ndarray, bits: int) -> np.ndarray:
    return shingles >> np.uint64(64 - bits)


def _profiles(size: int, bits: int):
    """Task: set size and name of each document, then the task's token counters."""

    def run(batches):
        counts = np.zeros(2**bits, np.uint32)
        for batch in batches:
            n, names = [], []
            for shingles in shingle_sets(batch.column(2), size):
                n.append(len(shingles))
                names.append(digest(shingles) if len(shingles) else None)
                counts[_bucket(shingles, bits)] += 1
            rows = [
                batch.column(0),
                batch.column(1),
                pa.array(n, pa.int64()),
                pa.array(names, pa.int64()),
                pa.nulls(len(n), pa.int32()),
                pa.nulls(len(n), pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(rows, names=PROFILE_NAMES)
        if counts.any():
            parts = counts.reshape(-1, 2 ** min(bits, SLICE_BITS))
            packed = [zlib.compress(p.tobytes(), 1) for p in parts]
            n = len(packed)
            rows = [pa.nulls(n, pa.int64()) for _ in range(4)]
            rows += [pa.array(range(n), pa.int32()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(rows, names=PROFILE_NAMES)

    return run


PROFILE_NAMES = ["id", "text_hash", "n", "node", "slice", "counts"]
PROFILE = "id bigint, text_hash bigint, n bigint, node bigint, slice int, counts binary"


def _add_slices(batches):
    """Task: sum of the counters of each slice it gets, one batch at a time."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            part = np.frombuffer(zlib.decompress(packed), np.uint32).astype(np.uint64)
            totals[i] = totals[i] + part if i in totals else part
    if totals:
        arrays = [
            pa.array(list(totals), pa.int32()),
            pa.array([t.tobytes() for t in totals.values()], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["slice", "counts"])


def rarity(profiles: DataFrame, bits: int) -> np.ndarray:
    """For each counter, the power of two of its count; 2**bits bytes in all."""
    parts = profiles.where("slice IS NOT NULL").select("slice", "counts")
    slices = 2 ** max(0, bits - SLICE_BITS)
    summed = parts.repartition(slices, "slice").mapInArrow(_add_slices, "slice int, counts binary")
    out = np.zeros((slices, 2 ** min(bits, SLICE_BITS)), np.uint8)
    for row in summed.collect():  # 8 bytes for each counter, a fixed number
        counts = np.frombuffer(row.counts, np.uint64)
        out[row.slice] = np.ceil(np.log2(np.maximum(counts, 1)))
    return out.reshape(-1)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _prefixes(size: int, percent: int, bits: int, orders: int, ranks):
    """Task: the prefix tokens of each new set under each order.

    A token is its order key: power of two of its count, then random bits, of
    which the last four are the number of the order.
    """

    names = ["token", "node", "size", "pos"]

    def flush(tokens, nodes, sizes):
        lengths = [len(t) for t in tokens]
        arrays = [
            pa.array(np.concatenate(tokens).view(np.int64)),
            pa.array(np.repeat(np.array(nodes, np.int64), lengths)),
            pa.array(np.repeat(np.array(sizes, np.int64), lengths)),
            pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in lengths])),
        ]
        for held in (tokens, nodes, sizes):
            held.clear()
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches):
        seen: set[int] = set()
        powers, waiting = ranks.value, 0
        tokens, nodes, sizes = [], [], []
        for shingles in (s for batch in batches for s in shingle_sets(batch.column(0), size)):
            n = len(shingles)
            node = digest(shingles)
            if not n or node in seen:
                continue
            if len(seen) >= SEEN:
                seen.clear()
            seen.add(node)
            power = powers[_bucket(shingles, bits)]
            # How common the set's tokens are on average, in 1/1000 of a power of two.
            common = int(power.mean(dtype=np.float64) * 1000)
            length = prefix_length(n, percent)
            for order in range(orders):
                keys = (power.astype(np.uint64) << np.uint64(57)) | (
                    mix(shingles ^ _SEEDS[order]) >> np.uint64(7)
                )
                if length < n:
                    keys = np.partition(keys, length - 1)[:length]
                tokens.append(np.sort(keys) & ~np.uint64(15) | np.uint64(order))
                nodes.append(node)
                sizes.append(common << 40 | min(n, 2**40 - 1))
                waiting += length
            if waiting >= FLUSH_ROWS:
                yield flush(tokens, nodes, sizes)
                waiting = 0
        if tokens:
            yield flush(tokens, nodes, sizes)

    return run


def _shared_tokens(prefixes: DataFrame, percent: int) -> DataFrame:
    """``(token, node, size, pos, first, leader, leader_size, leader_pos)`` of shared tokens.

    ``first`` marks the shorter prefix, which a set's token has to be in to meet larger
    sets; tokens without such a row are left out. In ``prefixes`` the commonness of a set's
    tokens stands above its size, so the greatest ``(size, node)`` is the leader.
    The counters bound the rows of all tokens below ``HOT_BITS``; those meet in one
    task each, in order of size, which leaves out rows without one of a fitting size. Others are summed up first and then joined, which adaptive
    execution can split.
    """
    size = F.col("size").bitwiseAND(2**40 - 1)
    first = (size - F.col("pos")) * (100 + percent) >= size * (2 * percent)
    rows = prefixes.withColumn("first", first)
    best = F.max(F.struct("size", "node", "pos"))
    sums = {"n": F.count(F.lit(1)), "best": best, "firsts": F.max("first")}
    power = F.shiftrightunsigned("token", 57)
    by_token = Window.partitionBy("token")
    by_size = by_token.orderBy(size)
    # A row without a neighbour in size that is close enough meets no other row.
    near = (F.lag(size).over(by_size) * 100 >= size * percent) | (
        F.lead(size).over(by_size) * percent <= F.when(F.col("first"), size * 100).otherwise(size * percent)
    )
    few = (
        rows.where(power < HOT_BITS)
        .repartition("token")
        .dropDuplicates(["token", "node"])
        .withColumn("near", near)
        .where("near")
        .drop("near")
        .withColumns({name: total.over(by_token) for name, total in sums.items()})
    )
    many = keep(rows.where(power >= HOT_BITS).distinct(), "hot_prefixes")
    totals = many.groupBy("token").agg(*(total.alias(name) for name, total in sums.items()))
    many = many.join(keep(totals, "hot_tokens").hint("merge"), "token")
    return (
        few.unionByName(many)
        .where("n > 1 AND firsts")
        .select(
            "token",
            "node",
            size.alias("size"),
            "pos",
            "first",
            F.col("best.node").alias("leader"),
            F.col("best.size").bitwiseAND(2**40 - 1).alias("leader_size"),
            F.col("best.pos").alias("leader_pos"),
        )
    )


def _close(a: str, b: str, percent: int) -> F.Column:
    """Sizes and what is left behind the shared token allow the similarity."""
    n, m = F.col(f"{a}size"), F.col(f"{b}size")
    left = F.least(n - F.col(f"{a}pos"), m - F.col(f"{b}pos"))
    return (
        (n * 100 >= m * percent)
        & (m * 100 >= n * percent)
        & (left * (100 + percent) >= (n + m) * percent)
    )


def _under_all(pairs: DataFrame, a: str, b: str, orders: int) -> DataFrame:
    """Pairs ``(a, b)`` that come with a shared token of every order."""
    order = F.expr("shiftleft(1, CAST(token & 15 AS INT))")
    found = pairs.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.bit_or(order).alias("o"))
    return found.where(F.col("o") == 2**orders - 1).select("a", "b")


def _candidates(shared: DataFrame, labels: DataFrame, orders: int, percent: int) -> DataFrame:
    """``(a, b)`` that share a prefix token under every order, in different components.

    Of each token, rows of the shorter prefix (``a``) meet rows of larger or equal sets
    (``b``); those of the token's largest component only meet the nodes outside it. A pair is met at the first
    token it shares of each order, and seldom at others.
    """
    columns = ["size", "pos", "first"]
    labelled = shared.join(_small(labels), "node", "left").select(
        "token", "node", *columns, F.coalesce("label", "node").alias("label")
    )
    label = F.col("label")
    mixed = labelled.groupBy("token").agg(F.min(label).alias("low"), F.max(label).alias("high"))
    mixed = keep(mixed.where("low <> high").select("token"), "mixed_tokens")
    rows = labelled.join(_small(mixed), "token")
    parts = rows.groupBy("token", "label").agg(F.count(F.lit(1)).alias("n"))
    tops = parts.groupBy("token").agg(F.max(F.struct("n", "label")).alias("top"))
    tops = keep(tops.select("token", F.col("top.label").alias("top")), "open_tokens")
    rows = rows.join(_small(tops), "token").withColumn("outside", label != F.col("top")).drop("top")
    rows = keep(_with_earlier(rows), "open_rows")

    def side(name: str, part: DataFrame) -> DataFrame:
        kept = ("node", "label", "size", "pos", "earlier")
        return part.select("token", *(F.col(c).alias(f"{name}_{c}") for c in kept))

    def met(a: DataFrame, b: DataFrame) -> DataFrame:
        larger = (F.col("a_size") <= F.col("b_size")) & (F.col("a_label") != F.col("b_label"))
        # A pair that shares an earlier token of this order is met there.
        new = ~F.arrays_overlap("a_earlier", "b_earlier")
        pairs = side("a", a).join(side("b", b).hint("merge"), "token")
        return pairs.where(larger & _close("a_", "b_", percent) & new).select(
            F.least("a_node", "b_node").alias("a"),
            F.greatest("a_node", "b_node").alias("b"),
            "token",
        )

    pairs = met(rows.where("first AND outside"), rows).union(
        met(rows.where("first AND NOT outside"), rows.where("outside"))
    )
    return _under_all(pairs, "a", "b", orders)


def _with_earlier(rows: DataFrame) -> DataFrame:
    """``rows`` with ``earlier``: the last ``EARLIER`` tokens of the row's set and order before its own.

    The rows of a set and order, a prefix at most, meet once. Where two sets share a token, an earlier
    one that they share is among the rows of both, is in the shorter prefix as well, and leaves more
    behind it, so the pair is met there; the first they share is never left out.
    """
    order = F.col("token").bitwiseAND(15)
    before = Window.partitionBy("node", order).orderBy("pos").rowsBetween(-EARLIER, -1)
    return rows.withColumn("earlier", F.collect_list("token").over(before))


def sketch(shingles: np.ndarray) -> bytes:
    """How many tokens fall in each class, at most 255."""
    counts = np.bincount((shingles % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _sets(size: int):
    """Task: the wanted sets, once per task."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            nodes, sets = [], []
            for wanted, shingles in zip(
                batch.column(1).to_pylist(), shingle_sets(batch.column(0), size), strict=True
            ):
                if wanted not in seen and len(shingles) and digest(shingles) == wanted:
                    seen.add(wanted)
                    nodes.append(wanted)
                    sets.append(shingles)
            arrays = [
                pa.array(nodes, pa.int64()),
                pa.array([len(t) for t in sets], pa.int64()),
                pa.array([sketch(t) for t in sets], pa.binary()),
                pa.array([t.view(np.int64) for t in sets], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "n", "sketch", "shingles"])

    return run


def _possible(percent: int):
    """Task: the pairs ``(a, b, total, left, right)`` whose sketches allow the similarity."""

    def run(batches):
        for batch in batches:
            total = batch.column(2).to_numpy()
            left, right = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SKETCH)
                for i in (3, 4)
            )
            lesser = np.minimum(left, right)
            most = lesser.sum(axis=1, dtype=np.int64)
            fit = (most * (100 + percent) >= total * percent) | (lesser == 255).any(axis=1)
            yield batch.select([0, 1]).filter(pa.array(fit))

    return run


def _small(table: DataFrame) -> DataFrame:
    """A written table for the narrow side of a join: broadcast up to ``BROADCAST_ROWS`` rows."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table.hint("merge")


def _similar(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """The written pairs ``(a, b)`` of nodes that are links, from the texts of one document each.

    The sets of ``a`` are sent to those of ``b``, which may have many partners; before
    them their sketches, which most pairs that are no links do not get past.
    """
    named = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = keep(
        named.join(nodes.hint("merge"), "node").select(
            "node", F.col("doc.id").alias("wanted_id"), F.col("doc.text_hash").alias("wanted_hash")
        ),
        "wanted",
    )
    same = F.col("id").eqNullSafe(F.col("wanted_id")) & (F.col("text_hash") == F.col("wanted_hash"))
    texts = docs.join(_small(wanted), same).select("text", "node")
    kind = "node bigint, n bigint, sketch binary, shingles array<bigint>"
    sets = keep(texts.mapInArrow(lean(_sets(size)), kind), "sets")

    def met(pairs: DataFrame, column: str) -> DataFrame:
        hubs = keep(pairs.select(F.col("b").alias("node")).distinct(), "hubs")
        left = sets.join(_small(pairs), F.col("node") == F.col("a")).select(
            "a", "b", F.col("n").alias("left_n"), F.col(column).alias("left")
        )
        right = sets.join(_small(hubs), "node", "left_semi").select(
            F.col("node").alias("b"), F.col("n").alias("right_n"), F.col(column).alias("right")
        )
        both = left.join(right.hint("merge"), "b")
        return both.select("a", "b", F.expr("left_n + right_n").alias("total"), "left", "right")

    fit = met(pairs, "sketch").mapInArrow(lean(_possible(percent)), "a bigint, b bigint")
    shared = met(keep(fit, "possible"), "shingles").withColumn(
        "both", F.size(F.array_intersect("left", "right"))
    )
    linked = shared.where(F.col("both") * 100 >= (F.col("total") - F.col("both")) * percent)
    return keep(linked.select("a", "b"), "verified")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = WORDS,
    percent: int = PERCENT,
    orders: int = ORDERS,
    bucket_bits: int = BUCKET_BITS,
) -> DataFrame:
    """``(key, n_shingles, component_id)``: the least id that links reach, for each row."""
    if not 1 <= orders <= 15 or not 0 < percent <= 100:
        raise ValueError("1 to 15 orders and 1 to 100 percent")
    spark = docs.sparkSession
    source = docs.select(
        F.col(key).cast("bigint").alias("id"),
        F.xxhash64(text).alias("text_hash"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    profiles = keep(source.mapInArrow(lean(_profiles(size, bucket_bits)), PROFILE), "profiles")
    ranks = spark.sparkContext.broadcast(rarity(profiles, bucket_bits))
    profiles = profiles.where("slice IS NULL")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash"))
    nodes = keep(
        profiles.where("node IS NOT NULL").groupBy("node").agg(first.alias("doc")), "nodes"
    )
    prefixes = source.select("text").mapInArrow(
        lean(_prefixes(size, percent, bucket_bits, orders, ranks)),
        "token bigint, node bigint, size bigint, pos int"
    )
    shared = keep(_shared_tokens(prefixes, percent), "shared_tokens")

    stars = shared.where((F.col("node") != F.col("leader")) & _close("", "leader_", percent))
    stars = keep(_under_all(stars, "node", "leader", orders), "stars")
    links = _similar(stars, source, nodes, size, percent)
    labels = components(links)
    pairs = _candidates(shared, labels, orders, percent)
    known = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = keep(pairs.join(known.hint("merge"), ["a", "b"], "left_anti"), "candidates")
    if not pairs.isEmpty():
        links = links.union(_similar(pairs, source, nodes, size, percent))
        labels = components(links)

    grouped = nodes.join(labels.hint("merge"), "node", "left").select(
        "node", "doc", F.coalesce("label", "node").alias("label")
    )
    least = grouped.groupBy("label").agg(F.min("doc.id").alias("component_id"))
    found = keep(grouped.join(least.hint("merge"), "label").select("node", "component_id"), "found")
    return profiles.join(found.hint("merge"), "node", "left").select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
