"""Joins that stay balanced when one key holds a large part of all rows.

A key with many rows is cut into a grid: its left rows are spread over
``n_rows`` stripes and its right rows over ``n_cols`` stripes, each row is
copied to the other side's stripes, and the cells are joined on their own.
Every pair still meets exactly once, in the cell of its two stripes.

Only keys above a limit are split and listed in a broadcast table. Both limits
keep that list short whatever the size of the input: fewer than
``HOT_KEYS_MAX`` keys can have more than ``total rows / HOT_KEYS_MAX`` rows,
and fewer than ``CELLS_PER_TASK * tasks`` keys can build more than that part
of all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_KEYS_MAX = 1_000_000
ROWS_PER_STRIPE = 1_000_000
PAIRS_PER_TASK = 2**26
CELLS_PER_TASK = 16
TASKS_MAX = HOT_KEYS_MAX // CELLS_PER_TASK


def task_count(spark: SparkSession, work: int, good: int, most: int) -> int:
    """Tasks for ``work`` rows or pairs: about ``good`` each, never over ``most``.

    The session's cores and shuffle partitions are the bounds in between, so
    small inputs are not cut into many empty tasks.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(spark.sparkContext.defaultParallelism, work // good)
    return max(1, min(partitions, wanted), -(-work // most))


def hot_limit(total_rows: int, floor: int = ROWS_PER_STRIPE) -> int:
    """Rows per key above which a key is split."""
    return max(floor, -(-total_rows // HOT_KEYS_MAX))


def stripes(rows: Column, limit: int) -> Column:
    """Number of stripes that hold ``rows`` rows, ``limit`` in each."""
    return F.greatest(F.lit(1), F.ceil(rows / F.lit(limit))).cast("int")


def stripe_of(value: Column, count: Column) -> Column:
    """Stripe that a row belongs to, from the column that varies within a key."""
    return F.pmod(F.xxhash64(value), F.coalesce(count, F.lit(1))).cast("int")


def all_stripes(count: Column) -> Column:
    """One copy of the row for each stripe."""
    return F.explode(F.sequence(F.lit(0), F.coalesce(count, F.lit(1)) - 1))


def hot_rows(counts: DataFrame, key: str, limit: int) -> DataFrame:
    """Keys to split by their rows, from ``counts(key, n_left, n_right)``."""
    return counts.where((F.col("n_left") > limit) | (F.col("n_right") > limit)).select(
        key,
        stripes(F.col("n_left"), limit).alias("n_rows"),
        stripes(F.col("n_right"), limit).alias("n_cols"),
    )


def hot_pairs(
    counts: DataFrame, key: str, limit: int, pairs_per_task: int = PAIRS_PER_TASK
) -> tuple[DataFrame, int]:
    """Keys to split for a join that builds all pairs within each key, and its tasks.

    Adaptive coalescing goes by the size of the input, which says little
    about the number of pairs, so tasks and cells follow the pairs. The grid
    of a key is chosen so that the fewest rows are copied.
    """
    n_left, n_right = F.col("n_left").cast("double"), F.col("n_right").cast("double")
    total = counts.agg(F.coalesce(F.sum(n_left * n_right), F.lit(0.0))).first()[0]
    good = max(1, pairs_per_task // 64)
    tasks = task_count(counts.sparkSession, int(total), good, pairs_per_task)
    tasks = min(TASKS_MAX, tasks)
    pairs_per_cell = max(pairs_per_task / 1024, total / (CELLS_PER_TASK * tasks))

    cells = F.ceil(n_left * n_right / pairs_per_cell)
    by_pairs = F.ceil(F.sqrt(cells * n_left / F.greatest(n_right, F.lit(1.0))))
    rows = F.greatest(F.least(by_pairs, n_left), F.ceil(n_left / limit), F.lit(1))
    cols = F.greatest(
        F.least(F.ceil(cells / F.col("n_rows")), n_right), F.ceil(n_right / limit), F.lit(1)
    )
    hot = (
        counts.where((n_left > limit) | (n_right > limit) | (n_left * n_right > pairs_per_cell))
        .withColumn("n_rows", rows.cast("int"))
        .select(key, "n_rows", cols.cast("int").alias("n_cols"))
    )
    return hot, tasks


def split_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: tuple[str, str],
    hot: DataFrame,
    tasks: int | None = None,
) -> DataFrame:
    """Inner join on ``key``, with the keys of ``hot(key, n_rows, n_cols)`` split.

    ``spread`` names the column of each side that varies within a key.
    ``tasks`` fixes the number of tasks; without it Spark chooses.
    """
    cells = [key, "cell_row", "cell_col"]
    listed = F.broadcast(hot)
    striped_left = (
        left.join(listed, key, "left")
        .withColumn("cell_row", stripe_of(F.col(spread[0]), F.col("n_rows")))
        .withColumn("cell_col", all_stripes(F.col("n_cols")))
        .drop("n_rows", "n_cols")
    )
    striped_right = (
        right.join(listed, key, "left")
        .withColumn("cell_col", stripe_of(F.col(spread[1]), F.col("n_cols")))
        .withColumn("cell_row", all_stripes(F.col("n_rows")))
        .drop("n_rows", "n_cols")
    )
    if tasks:
        striped_left = striped_left.repartition(tasks, *cells)
        striped_right = striped_right.repartition(tasks, *cells)
    return striped_left.join(striped_right, cells).drop("cell_row", "cell_col")
