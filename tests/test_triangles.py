import brute
import numpy as np
import pytest

import edgeloom as el
from pyspark.sql import functions as F

from edgeloom.operators import intersections, partitions
from edgeloom.operators import triangles as triangle_ops
from edgeloom.operators.triangles import ordered_edges
from edgeloom.storage import keep

# edges, triangles, then closed walks in the modes all, semi and set
HAND = {
    "one cycle": ([(1, 2), (2, 3), (3, 1)], 1, (3, 3, 3)),
    "not a cycle": ([(1, 2), (2, 3), (1, 3)], 0, (0, 0, 0)),
    "shared edge": ([(1, 2), (2, 3), (3, 1), (2, 4), (4, 1)], 2, (6, 6, 6)),
    "self-loop": ([(1, 1)], 0, (1, 0, 1)),
    "duplicate closing edge": ([(1, 2), (2, 3), (3, 1), (3, 1)], 1, (6, 5, 4)),
    "empty": ([], 0, (0, 0, 0)),
}


def kept(df):
    return keep(el.weighted_edges(df), "weighted")


def triangles(df, **options):
    return el.triangle_count(df, **options).first().triangles


def hits(df, mode, **options):
    return el.closed_walks(df, mode, **options).first().hits


@pytest.mark.parametrize("name", HAND)
def test_hand_graphs(edges_of, name):
    edges, count, walks = HAND[name]
    df = edges_of(edges)
    assert triangles(df) == count
    assert tuple(hits(df, m) for m in ("all", "semi", "set")) == walks


@pytest.mark.parametrize("seed", range(4))
def test_random_multigraphs(edges_of, seed):
    edges = brute.multigraph(seed, nodes=5 + 3 * seed)
    df = edges_of(edges)
    assert triangles(df) == brute.triangles(edges)
    for mode in ("all", "semi", "set"):
        assert hits(df, mode) == brute.walks(edges, mode), mode


def test_hub_is_split_without_changing_the_result(edges_of):
    edges = brute.hub_graph()
    df = edges_of(edges)
    want = brute.triangles(edges)
    assert triangles(df) == triangles(df, pairs_per_task=20) == want
    assert hits(df, "all", pairs_per_task=20) == brute.walks(edges, "all")


def test_degrees_are_attached_across_stripes(edges_of):
    df = edges_of(brute.hub_graph())
    rows = sorted(ordered_edges(kept(df), rows_per_stripe=3).collect())
    assert rows == sorted(ordered_edges(kept(df)).collect())
    assert len(rows) > 100


def test_edges_off_all_cycles_are_dropped_early(edges_of):
    cycle = [(1, 2), (2, 3), (3, 1), (2, 1)]
    sink = [(i, 99) for i in range(1, 40)]
    source = [(98, i) for i in range(1, 40)]
    df = edges_of(cycle + sink + source)
    # The sink is a hub that is looked up in stripes, and found to be no use.
    assert ordered_edges(kept(df), rows_per_stripe=4).count() == len(cycle)
    assert triangles(df) == 1


def test_strategies_agree(edges_of):
    edges = brute.multigraph(7, nodes=12, edges=90)
    df = edges_of(edges)
    want = brute.triangles(edges)
    assert triangles(df, strategy="broadcast") == want
    assert triangles(df, strategy="broadcast", max_broadcast_rows=5) == want
    with pytest.raises(ValueError):
        triangles(df, strategy="other")


@pytest.mark.parametrize("edges_per_task", [1, 120, 10**6])
def test_partition_counts_each_cycle_once(edges_of, edges_per_task):
    for edges in (brute.multigraph(3, nodes=25, edges=200), brute.hub_graph(80, 40), []):
        found = triangles(edges_of(edges), strategy="partition", edges_per_task=edges_per_task)
        assert found == brute.triangles(edges)


def test_triples_are_small_and_hold_each_edge_once_for_each_class(edges_of):
    ordered = ordered_edges(kept(edges_of(brute.multigraph(4, nodes=60, edges=900))))
    p = partitions.class_count(ordered, 300)
    assert p > 2
    rows = partitions.triple_edges(ordered, p)
    sizes = [r["count"] for r in rows.groupBy("triple").count().collect()]
    assert max(sizes) <= 300 and sum(sizes) == p * ordered.count()
    assert rows.distinct().count() == rows.count()
    assert partitions.class_count(ordered, 1) is None


def test_wedges_in_chunks(monkeypatch, edges_of):
    monkeypatch.setattr(partitions, "CHUNK", 7)
    edges = brute.multigraph(9, nodes=20, edges=200)
    rows = ordered_edges(kept(edges_of(edges))).collect()
    columns = [np.array([r[c] for r in rows]) for c in ("low", "high", "out")]
    nothing = np.zeros(len(rows), int)
    assert partitions.cycles_between(*columns, nothing, nothing, (0, 0, 0)) == brute.triangles(edges)


@pytest.mark.parametrize("max_len,mode", [(1, "all"), (3, "set")])
def test_intersections_of_neighbour_sets(edges_of, max_len, mode):
    edges = brute.multigraph(max_len, nodes=9, edges=90)
    df = edges_of(edges)
    assert triangles(df, strategy="intersect") == brute.triangles(edges)
    assert hits(df, mode, strategy="intersect", max_len=max_len) == brute.walks(edges, mode)
    with pytest.raises(ValueError):
        hits(df, "set", strategy="partition")


def test_hub_sets_are_bounded_and_dealt_over_stripes(edges_of):
    edges = brute.hub_graph()
    ordered = ordered_edges(kept(edges_of(edges)))
    for out in (True, False):
        sets = intersections.later_sets(ordered, out, "node", 4).collect()
        assert max(len(r.node_ids) for r in sets) <= 4
        whole = {}
        for r in sorted(sets, key=lambda r: (r.node, r.part)):
            whole.setdefault(r.node, []).extend(r.node_ids)
        later = ordered.where("out" if out else "NOT out").collect()
        assert whole == {v: sorted(r.high for r in later if r.low == v) for v in {r.low for r in later}}
    found = intersections.closed_sets(ordered, max_len=4, rows_per_stripe=3)
    assert sum(r.n for r in found.collect()) == brute.triangles(edges)


def test_work_of_each_way(edges_of):
    edges = brute.multigraph(4, nodes=60, edges=900)
    ordered = ordered_edges(kept(edges_of(edges)))
    row = el.triangle_work(edges_of(edges), edges_per_task=300).first()
    assert row.edges == ordered.count() and row.copies == row.classes * row.edges
    later = {}
    for r in ordered.collect():
        later.setdefault(r.low, []).append(r.out)
    assert row.wedges == sum(sum(x) * (len(x) - sum(x)) for x in later.values())
    assert el.triangle_work(edges_of(edges), edges_per_task=1).first().copies is None


def test_max_id_filters_both_ends(edges_of):
    edges = brute.multigraph(5, nodes=12, edges=90)
    kept = [(a, b) for a, b in edges if a <= 8 and b <= 8]
    df = edges_of(edges)
    assert triangles(df, max_id=8) == brute.triangles(kept)
    assert hits(df, "set", max_id=8) == brute.walks(kept, "set")


def test_edges_go_only_to_triples_that_can_close(edges_of):
    """copies are bounded by degrees and not by the number of classes."""
    edges = [(i, (i + d) % 300) for i in range(300) for d in (1, 2)] + [(i, (i - 3) % 300) for i in range(300)]
    ordered = ordered_edges(kept(edges_of(edges)))
    rows = partitions.with_thirds(ordered, 100).collect()
    assert 0 < sum(bin(w % 2**64).count("1") for r in rows for w in r.thirds) <= 3 * ordered.count()
    for p in (3, 70):
        assert sum(r.n for r in partitions.cycle_counts(ordered, p).collect()) == brute.triangles(edges)


def test_wedges_are_not_moved_one_by_one(edges_of):
    """F8, F9: sums by pair need no shuffle, and tasks follow the wedges."""
    df = edges_of(brute.hub_graph())
    pairs = triangle_ops.closed_pairs(ordered_edges(kept(df)), F.count("m_in").alias("n"))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Generate posexplode")]
    assert "Exchange" not in above and "Join" not in above
