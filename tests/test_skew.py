"""Hot keys are spread over tasks, and plans stay free of costly shapes."""

import brute
from pyspark.sql import functions as F

import edgeloom as el
from edgeloom.operators import skew
from edgeloom.plans import graphs as g

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def two_sides(spark):
    left = spark.range(2000).selectExpr("IF(id % 3 = 0, 7, id) AS k", "id AS a")
    right = spark.range(900).selectExpr("IF(id % 3 = 0, 7, id) AS k", "id AS b")
    counts = (
        left.groupBy("k")
        .agg(F.count("*").alias("n_left"))
        .join(right.groupBy("k").agg(F.count("*").alias("n_right")), "k", "full")
        .na.fill(0)
    )
    return left, right, counts


def check_spread(left, right, hot, tasks):
    joined = skew.split_join(left, right, "k", ("a", "b"), hot, tasks)
    assert joined.count() == left.join(right, "k").count()
    assert joined.select("k", "a", "b").distinct().count() == joined.count()
    per_task = (
        joined.where("k = 7").groupBy(F.spark_partition_id().alias("p")).count().collect()
    )
    total = sum(r["count"] for r in per_task)
    assert len(per_task) > tasks / 2
    assert max(r["count"] for r in per_task) < total / 4


def test_every_pair_meets_once_and_hot_rows_are_spread(spark):
    left, right, counts = two_sides(spark)
    hot = skew.hot_rows(counts, "k", 50)
    assert [(r.k, r.n_rows, r.n_cols) for r in hot.collect()] == [(7, 14, 7)]
    check_spread(left, right, hot, tasks=16)


def test_cells_follow_the_number_of_pairs(spark):
    left, right, counts = two_sides(spark)
    hot, tasks = skew.hot_pairs(counts, "k", 10**6, pairs_per_task=30_000)
    assert tasks == 8
    [row] = hot.collect()
    # 668 x 301 pairs are nearly all there are; 16 cells for each of 8 tasks.
    assert row.k == 7
    assert 128 <= row.n_rows * row.n_cols <= 160
    assert row.n_rows > row.n_cols
    check_spread(left, right, hot, tasks)


def test_a_side_without_pairs_is_still_split_by_rows(spark):
    counts = spark.createDataFrame(
        [(1, 500, 0), (2, 500, 1), (3, 1, 1)], "k BIGINT, n_left BIGINT, n_right BIGINT"
    )
    hot, _ = skew.hot_pairs(counts, "k", 100, pairs_per_task=100)
    grids = {r.k: (r.n_rows, r.n_cols) for r in hot.collect()}
    assert grids[1] == (5, 1)
    assert grids[2][0] >= 5 and grids[2][1] == 1
    assert 3 not in grids


def test_few_keys_can_be_above_the_limits():
    assert skew.hot_limit(1_000, 10) == 10
    rows = 5 * 10**12
    assert rows / skew.hot_limit(rows) <= skew.HOT_KEYS_MAX
    assert skew.CELLS_PER_TASK * skew.TASKS_MAX <= skew.HOT_KEYS_MAX


def test_tasks_follow_the_number_of_pairs(spark):
    counts = spark.createDataFrame(
        [(1, 10**6, 10**6), (2, 5, 0)], "k BIGINT, n_left BIGINT, n_right BIGINT"
    )
    assert skew.hot_pairs(counts, "k", 10**6)[1] == 10**12 // skew.PAIRS_PER_TASK + 1
    assert skew.task_count(spark, 0, 2**20, 2**24) == 8
    assert skew.task_count(spark, 2**40, 2**20, 2**24) == 2**16
    assert skew.hot_pairs(counts.where("k = 2"), "k", 10**6)[1] == 8


def test_counts_combine_before_the_shuffle(spark):
    edges = g.hops(spark, SF_DIR)
    for df in (el.follower_count(edges), el.degree_in_out(edges)):
        assert plan_of(df).count("partial_") >= 1


def test_filter_and_columns_reach_the_scan(spark):
    plan = plan_of(el.max_filter(g.follows(spark, SF_DIR), 50))
    assert "LessThanOrEqual(l_partkey,50)" in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in plan


def test_no_pair_is_built_by_a_cross_join_or_in_python(edges_of):
    df = edges_of(brute.multigraph(0))
    plans = [
        plan_of(op(df))
        for op in (
            el.path2_pairs,
            el.path2_cardinality,
            el.triangle_count,
            el.closed_walks,
            el.adjacency_list,
        )
    ]
    for plan in plans:
        for shape in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
            assert shape not in plan


def test_cardinality_builds_no_paths(edges_of):
    assert "Join" not in plan_of(el.path2_cardinality(edges_of(brute.multigraph(0))))
