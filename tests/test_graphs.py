"""The edge relations, and published counts on two of them."""

import random

import pytest

import edgeloom as el
from edgeloom.operators.triangles import ordered_edges, wedges
from edgeloom.plans import graphs as g
from edgeloom.storage import keep

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("rows", [0, 1, 2, 500])
def test_successive_rows_across_ranges(spark, rows):
    rng = random.Random(rows)
    # A third of the rows share one time stamp.
    data = [(0 if i % 3 else rng.randrange(50), i, rng.randrange(9)) for i in range(rows)]
    df = spark.createDataFrame(data, "ts BIGINT, event_id BIGINT, user_id BIGINT")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = g.successive(df, ["ts", "event_id"], "user_id").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    users = [u for _, _, u in sorted(data)]
    assert sorted(tuple(r) for r in got) == sorted(zip(users, users[1:]))


@pytest.mark.parametrize("per_range", [7, 100])
def test_ranges_follow_the_rows(spark, per_range):
    data = [(i % 11, i, i * 7 % 13) for i in range(400)]
    df = spark.createDataFrame(data, "ts BIGINT, event_id BIGINT, user_id BIGINT")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        got = g.successive(df, ["ts", "event_id"], "user_id", per_range).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    users = [u for _, _, u in sorted(data)]
    assert sorted(tuple(r) for r in got) == sorted(zip(users, users[1:]))


def test_a_scan_does_not_shuffle(spark):
    plan = g.follows(spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Exchange" not in plan
    assert g.follows(spark, SF_DIR).count() == spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()


@pytest.fixture(scope="module")
def part_graph(spark):
    """Parts whose id does not end in 0 and their suppliers."""
    edges = el.distinct_edges(g.follows(spark, SF_DIR).where("src <> dst"))
    return edges.where("src % 10 <> 0").cache()


def test_published_counts_on_the_part_graph(part_graph):
    assert part_graph.count() == 46_518
    assert el.degree_in_out(part_graph).count() == 1_810
    assert el.dangling_nodes(part_graph).count() == 10
    assert el.max_filter(part_graph, 100).count() == 2_288
    assert int(el.path2_cardinality(part_graph).first()[0]) == 1_063_161
    assert el.path2_pairs(part_graph).agg({"paths": "sum"}).first()[0] == 1_062_679
    assert el.triangle_count(part_graph).first().triangles == 4_105
    for mode in ("all", "semi", "set"):
        assert el.closed_walks(part_graph, mode).first().hits == 12_315


def test_published_ranks_on_the_part_graph(part_graph):
    ranks = {r.node: round(r.rank, 10) for r in el.pagerank(part_graph).collect()}
    top = sorted(ranks, key=ranks.get, reverse=True)[:3]
    assert [(v, ranks[v]) for v in top] == [
        (63, 0.0101934864),
        (25, 0.0101666897),
        (96, 0.0100729752),
    ]


def test_published_counts_on_hops(spark):
    hops = g.hops(spark, SF_DIR)
    assert hops.count() == 9_999
    assert el.distinct_edges(hops).count() == 8_023
    assert el.max_filter(hops, 100).count() == 4_607
    assert int(el.path2_cardinality(hops).first()[0]) == 677_093
    assert el.triangle_count(hops).first().triangles == 51_449
    walks = [el.closed_walks(hops, m).first().hits for m in ("all", "semi", "set")]
    assert walks == [309_352, 245_149, 197_318]


def kept(df):
    return keep(el.weighted_edges(df), "weighted")


def test_wedges_are_few(spark):
    ordered = ordered_edges(kept(g.hops(spark, SF_DIR)))
    assert wedges(ordered).count() <= 130_638
