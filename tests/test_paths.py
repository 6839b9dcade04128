import brute
import pytest

import edgeloom as el
from edgeloom import storage
from edgeloom.operators import broadcasts, paths
from edgeloom.storage import keep


def pairs_of(df):
    return {(r.x, r.z): r.paths for r in df.collect()}


def cardinality(df):
    return int(el.path2_cardinality(df).first().path2_count)


HAND = {
    "one cycle": ([(1, 2), (2, 3), (3, 1)], 3),
    "not a cycle": ([(1, 2), (2, 3), (1, 3)], 1),
    "two-cycle": ([(1, 2), (2, 1)], 2),
    "empty": ([], 0),
}


@pytest.mark.parametrize("name", HAND)
def test_cardinality_on_hand_graphs(edges_of, name):
    edges, want = HAND[name]
    assert cardinality(edges_of(edges)) == want


def test_two_cycle_has_no_pairs(edges_of):
    assert pairs_of(el.path2_pairs(edges_of([(1, 2), (2, 1)]))) == {}


def test_cardinality_does_not_overflow(spark):
    copies = spark.range(3_000_000).selectExpr("id AS src", "0L AS dst")
    back = copies.selectExpr("dst AS src", "src + 1 AS dst")
    assert cardinality(copies.unionByName(back)) >= 9 * 10**12


@pytest.mark.parametrize("returns", [False, True])
@pytest.mark.parametrize("per_task", [100, 2**26])
def test_pairs_equal_brute_force(edges_of, returns, per_task):
    edges = brute.hub_graph()
    got = pairs_of(el.path2_pairs(edges_of(edges), keep_returns=returns, pairs_per_task=per_task))
    assert got == brute.path2(edges, returns)


def test_broadcast_and_its_fallback_agree(edges_of):
    edges = brute.multigraph(1)
    df = edges_of(edges)
    small = el.path2_pairs(df, strategy="broadcast")
    large = el.path2_pairs(df, strategy="broadcast", max_broadcast_rows=3)
    assert pairs_of(small) == pairs_of(large) == brute.path2(edges, False)
    assert "BroadcastHashJoin [y" in small._jdf.queryExecution().toString()


def test_slabs_of_a_bounded_size(spark, edges_of, monkeypatch):
    edges = brute.multigraph(1, nodes=40, edges=300)
    df = edges_of(edges)
    sizes, join = [], broadcasts.join_broadcast
    monkeypatch.setattr(broadcasts, "join_broadcast", lambda a, b, *k: sizes.append(b.count()) or join(a, b, *k))
    got = el.path2_pairs(df, strategy="slabs", max_broadcast_rows=30)
    assert pairs_of(got) == brute.path2(edges, False)
    assert len(sizes) > 5 and max(sizes) <= 30 and sum(sizes) == len(set(edges))
    # A node with more edges than a slab may hold leaves the join to the other way.
    assert broadcasts.slab_count(edges_of(brute.hub_graph()), "src", 20) is None
    assert pairs_of(el.path2_pairs(edges_of([]), strategy="slabs")) == {}


@pytest.mark.parametrize("returns", [False, True])
def test_blocks_have_bounded_pairs_and_go_on(edges_of, tmp_path, monkeypatch, returns):
    edges = brute.hub_graph(80, 40)
    weighted = keep(el.weighted_edges(edges_of(edges)), "weighted")
    links = set(edges)
    of = {x: sum(1 for a, b in links for c, _ in links if a == x and b == c) for x, _ in links}
    blocks = paths.plan_blocks(weighted, 300)
    assert len(blocks) > 3 and sum(n for *_, n in blocks) == sum(of.values())
    for first, last, n in blocks:
        inside = [of[x] for x in of if first <= x <= last]
        assert n == sum(inside) and n < 300 + max(inside)

    done, shuffled = [], paths._shuffled
    monkeypatch.setattr(paths, "_shuffled", lambda *a: done.append(1) or shuffled(*a))
    folder = str(tmp_path / "run")
    got = el.path2_blocks(edges_of(edges), 300, returns, folder=folder)
    want = brute.path2(edges, returns)
    assert pairs_of(got) == want and got.select("block").distinct().count() <= len(done) == len(blocks)
    storage.RunFolder(got.sparkSession, folder).drop("pairs/block=2/_whole")
    assert pairs_of(el.path2_blocks(edges_of(edges), 300, returns, folder=folder)) == want
    assert len(done) == len(blocks) + 1


def test_blocks_of_no_edges(edges_of):
    assert el.path2_blocks(edges_of([])).collect() == []


def test_cardinality_is_the_sum_of_all_pairs(edges_of):
    df = edges_of(brute.multigraph(2))
    total = sum(pairs_of(el.path2_pairs(df, keep_returns=True)).values())
    assert total == cardinality(df)


def test_pairs_cross_the_shuffle_as_lists(edges_of):
    """no row for each pair is moved."""
    plan = el.path2_pairs(edges_of(brute.hub_graph()))._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Generate posexplode")]
    assert "Exchange" not in above and "Exchange" in plan


def test_small_blocks_share_a_job(edges_of, monkeypatch):
    """the number of jobs does not follow the number of small blocks."""
    assert paths._waves([(0, 0, 2**20)] * 200, list(range(200))) == [
        list(range(i, min(i + 64, 200))) for i in range(0, 200, 64)
    ]
    assert paths._waves([(0, 0, 2**32)] * 3, [0, 2]) == [[0], [2]]
    edges, jobs = brute.multigraph(8, nodes=40, edges=400), []
    apart = paths.parts_apart
    monkeypatch.setattr(paths, "parts_apart", lambda s: jobs.append(1) or apart(s))
    got = el.path2_blocks(edges_of(edges), 200)
    assert pairs_of(got) == brute.path2(edges, False)
    assert len(jobs) == 1 and got.select("block").distinct().count() > 5


def test_slabs_share_a_pass_and_read_only_their_rows(edges_of, monkeypatch):
    """passes do not follow the number of small slabs, and no pass reads the whole table."""
    edges = brute.multigraph(1, nodes=40, edges=300)
    read, passes, join, keep_ = [], [], broadcasts.join_broadcast, broadcasts.keep
    monkeypatch.setattr(broadcasts, "join_broadcast", lambda a, *k: read.append(a.count()) or join(a, *k))
    monkeypatch.setattr(broadcasts, "keep", lambda df, name: passes.append(name) or keep_(df, name))
    got = el.path2_pairs(edges_of(edges), strategy="slabs", max_broadcast_rows=30)
    assert pairs_of(got) == brute.path2(edges, False)
    assert sum(read) == len(set(edges)) and len(read) > 5 and len(passes) == 1
