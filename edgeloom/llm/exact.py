"""Exact deduplication by distributed radix partitioning from the first byte on.

All texts start in one group. Each round splits every group by its texts' next
bytes; groups of one text are done, groups whose texts have ended are groups
of equal texts, and only the others are carried into the next round with the
rest of their bytes. Rounds take more bytes each time, so even texts of 2 GB need
eight. Equality follows from the bytes themselves; no digest decides.

Splitting is an aggregation by (group, next bytes), which sums up copies before
they meet, and a join with the table of groups that are not single. The texts of a large group
are dealt over stripes in that join, so they never meet in one task.

Texts are compared without ``[\\x20\\x09-\\x0D]``; null counts as empty. Of equal
texts the one with most code points stays, then the smallest id (rows without
one last), then any one of the equal rows. Repeated ids are rows of their own.
Extra columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.operators.skew import all_stripes, hot_limit, stripes
from edgeloom.storage import keep

BLANKS = "[\\x20\\x09-\\x0D]+"
FIRST_BYTES = 32
GROWTH = 16
# Rows of a group that go to one task with the rest of their bytes.
ROWS_PER_STRIPE = 2**15


def _split(rows: DataFrame, width: int, ends: bool) -> DataFrame:
    """One round over ``(id, chars, digest, uid, group, rest)``.

    Returns the same columns with the next group and rest, ``done``, and for
    done rows ``keep_id``, ``group_size`` and ``kept``. Without ``ends`` no
    group ends, as rows have no stable number yet.
    """
    keyed = rows.withColumns(
        {
            "head": F.substring("rest", 1, width),
            "rest": F.substring("rest", width + 1, 2**31 - 1),
        }
    )
    counts = [F.count(F.lit(1)).alias("n")]
    if ends:
        order = F.struct(
            (-F.col("chars")).alias("chars"), F.col("id").isNull().alias("no_id"), "id", "uid"
        )
        counts.append(F.min(order).alias("best"))
    groups = keyed.groupBy("group", "head").agg(*counts).where("n > 1")
    if not ends:
        groups = groups.withColumn("best", F.lit(None).cast("struct<id:bigint,uid:bigint>"))
    groups = keep(
        groups.select(
            F.col("group").alias("g"),
            F.col("head").alias("h"),
            "n",
            F.col("best.id").alias("best_id"),
            F.col("best.uid").alias("best_uid"),
            F.monotonically_increasing_id().alias("next_group"),
        ),
        "groups",
    )
    # Only groups above the limit are listed, fewer than a million whatever the size.
    limit = hot_limit(groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], ROWS_PER_STRIPE)
    count = F.when(F.col("n") > limit, stripes(F.col("n"), limit)).otherwise(F.lit(1))
    striped = groups.withColumn("n_stripes", count)
    hot = striped.where("n_stripes > 1").select(
        F.col("g").alias("group"), F.col("h").alias("head"), "n_stripes"
    )
    # Equal rows of different tasks go to different stripes.
    spot = F.pmod(F.xxhash64("id", "chars", F.spark_partition_id()), F.coalesce("n_stripes", F.lit(1)))
    dealt = (
        keyed.join(F.broadcast(hot), ["group", "head"], "left")
        .withColumn("stripe", spot.cast("int"))
        .drop("n_stripes")
    )
    copied = striped.withColumn("s", all_stripes(F.col("n_stripes"))).drop("n_stripes")
    # The join is the same at every size, whatever table would be small enough to broadcast.
    joined = dealt.join(
        copied.hint("merge"),
        (F.col("group") == F.col("g")) & (F.col("head") == F.col("h")) & (F.col("stripe") == F.col("s")),
        "left",
    )
    single = F.col("n").isNull()
    ended = F.lit(ends) & (F.octet_length("head") < width)
    return joined.select(
        "id",
        "chars",
        "digest",
        (F.col("uid") if ends else F.monotonically_increasing_id()).alias("uid"),
        F.col("next_group").alias("group"),
        F.when(~single & ~ended, F.col("rest")).alias("rest"),
        (single | ended).alias("done"),
        F.when(single, F.col("id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("bigint")).alias("group_size"),
        (single | (F.col("uid") == F.col("best_uid"))).alias("kept"),
    )


def dedup_exact(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    first_bytes: int = FIRST_BYTES,
    growth: int = GROWTH,
) -> DataFrame:
    """``(key, keep_id, group_size, kept, text_sha256)`` for each row of ``docs``.

    ``text_sha256`` describes the compared text; it plays no part in comparing.
    """
    bare = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), BLANKS, "")
    rows = docs.select(
        F.col(key).cast("bigint").alias("id"),
        F.coalesce(F.length(text), F.lit(0)).alias("chars"),
        F.encode(bare, "UTF-8").alias("rest"),
    ).select(
        "id",
        "chars",
        F.unhex(F.sha2("rest", 256)).alias("digest"),
        F.lit(None).cast("bigint").alias("uid"),
        F.lit(0).cast("bigint").alias("group"),
        "rest",
    )
    done, width, ends = [], first_bytes, False
    while True:
        split = keep(_split(rows, width, ends), "split")
        done.append(split.where("done"))
        rows = split.where("NOT done").select("id", "chars", "digest", "uid", "group", "rest")
        if rows.isEmpty():
            break
        width, ends = min(width * growth, 2**30), True
    return reduce(DataFrame.unionByName, done).select(
        F.col("id").alias(key),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
