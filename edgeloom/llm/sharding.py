"""Jump consistent hashing: stable keys to shards without a ring table.

A key walks through ever larger buckets, drawing from a generator seeded by the
key, until the next bucket would be at or above the number of shards. The walk for one
more shard only differs if its next stop is the new shard, so growing from n to n + 1
moves 1 / (n + 1) of the keys, all into the new shard.

Everything is a column expression; the 64-bit generator works on halves of 32
bits, as Spark's long arithmetic does not wrap.

Null keys are hashed as 0. Rows with one key go to one shard, repeated rows
included. Extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeloom.operators.skew import task_count
from edgeloom.storage import keep

# Fixed values of the published generator: key = key * MULTIPLIER + 1 (mod 2**64).
MULTIPLIER = 2862933555777941757
LOW, HIGH = MULTIPLIER & 0xFFFFFFFF, MULTIPLIER >> 32
# Nearly every walk ends within this many steps; others take the longer path.
STEPS = 64
ROWS_PER_TASK = 2**21


def _times(value: Column, factor: int) -> Column:
    """``value * factor`` modulo 2**48 at least, for values below 2**32."""
    low = value.bitwiseAND(0xFFFF) * factor
    high = F.shiftright(value, 16) * factor
    return low + F.shiftleft(high.bitwiseAND(0xFFFF), 16)


def _step(s: Column, n: int) -> Column:
    """One jump: remember the bucket, draw, and compute the next bucket."""
    low_product = s["lo"].bitwiseAND(0xFFFF) * LOW
    high_product = F.shiftright(s["lo"], 16) * LOW
    t = low_product + F.shiftleft(high_product.bitwiseAND(0xFFFF), 16) + 1
    carry = F.shiftright(t, 32) + F.shiftright(high_product, 16)
    cross = _times(s["hi"], LOW).bitwiseAND(0xFFFFFFFF) + (s["lo"] * HIGH).bitwiseAND(0xFFFFFFFF)
    hi = (carry + cross).bitwiseAND(0xFFFFFFFF)
    draw = F.shiftright(hi, 1) + 1
    jump = (s["next"] + 1).cast("double") * (F.lit(float(2**31)) / draw.cast("double"))
    moved = F.struct(
        hi.alias("hi"),
        t.bitwiseAND(0xFFFFFFFF).alias("lo"),
        jump.cast("bigint").alias("next"),
        F.when(s["next"] < n, s["next"]).otherwise(s["shard"]).alias("shard"),
        s["next"].alias("grown"),
    )
    return F.when(s["next"] <= n, moved).otherwise(s)


def jump(key: Column, n: int) -> Column:
    """Struct ``(shard, grown)``: the key's shard among ``n`` and among ``n + 1``."""
    if n < 1:
        raise ValueError("at least one shard is needed")
    key = F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))
    zero = F.lit(0).cast("bigint")
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("hi"),
        key.bitwiseAND(0xFFFFFFFF).alias("lo"),
        zero.alias("next"),
        zero.alias("shard"),
        zero.alias("grown"),
    )
    walked = F.aggregate(F.sequence(F.lit(0), F.lit(min(n, STEPS))), start, lambda s, _: _step(s, n))
    if n > STEPS:
        # Each step moves up by one at least, so n + 1 steps always suffice.
        walked = F.aggregate(
            F.array(walked),
            start,
            lambda _, s: F.when(s["next"] > n, s).otherwise(
                F.aggregate(F.sequence(F.lit(0), F.lit(n)), s, lambda u, _: _step(u, n))
            ),
        )
    return F.transform(
        F.array(walked),
        lambda s: F.struct(s["shard"].cast("int").alias("shard"), s["grown"].cast("int").alias("grown")),
    )[0]


def shards(docs: DataFrame, n: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, size, text_crc32, shard, grown_shard)`` for each row.

    ``size`` is the text's UTF-8 bytes plus one; a null text has no bytes.
    """
    found = F.col("jump")
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        jump(F.col(key), n).alias("jump"),
    ).select(key, "size", "text_crc32", found["shard"].alias("shard"), found["grown"].alias("grown_shard"))


def with_slots(rows: DataFrame, shard: str, order: list[str]) -> DataFrame:
    """Add ``slot``, the row's position in its shard by ``order``, without gaps from 0.

    Rows are range partitioned by shard and order, so that a large shard takes
    many tasks. Each row keeps its position in its partition; the offset of a
    shard's part of a partition comes from a table with at most one row per
    partition and shard border. A running number separates equal rows, which
    may then go to several tasks.
    """
    spark = rows.sparkSession
    kept = keep(rows.withColumn("__tie", F.monotonically_increasing_id()), "shards")
    tasks = task_count(spark, kept.count(), ROWS_PER_TASK // 16, ROWS_PER_TASK)
    columns = [shard, *order, "__tie"]
    placed = keep(
        kept.repartitionByRange(tasks, *columns)
        .sortWithinPartitions(*columns)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__at", F.monotonically_increasing_id().bitwiseAND(2**33 - 1)),
        "placed",
    )
    parts = placed.groupBy(shard, "__part").agg(
        F.count(F.lit(1)).alias("n"), F.min("__at").alias("first")
    )
    before = Window.partitionBy(shard).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        F.col(shard),
        "__part",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("__offset"),
    )
    return (
        placed.join(F.broadcast(offsets), [shard, "__part"])
        .withColumn("slot", F.col("__at") + F.col("__offset"))
        .drop("__tie", "__part", "__at", "__offset")
    )
