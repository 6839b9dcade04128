from pathlib import Path

import brute
import pytest

import edgeloom as el
from edgeloom import storage
from edgeloom.operators import pagerank

# Ranks of the 100 x 100 chain graph after 10 rounds.
CHAIN_RANKS = {
    1: 1.588812573561084e-05,
    2: 2.9391220523344347e-05,
    3: 4.086705694684287e-05,
    4: 5.061974152456418e-05,
    8: 7.702118669812162e-05,
    12: 1.047006992966952e-04,
    100: 1.047006992966952e-04,
}

# Dangling rank per round on the 1000 x 1000 chain graph, as
# whole multiples of 1e-10 (published with that truncation).
CHAIN_DANGLING = [
    10000000, 10008000, 10015000, 10021000, 10027000,
    10031000, 10035000, 10038000, 10041000, 10043000,
]


def as_dict(df):
    return {r.node: r.rank for r in df.collect()}


def check(got, want):
    assert set(got) == set(want)
    assert all(got[v] == pytest.approx(want[v], abs=1e-14) for v in want)


def test_tiny_chain_one_round(edges_of):
    got = as_dict(el.pagerank(edges_of([(1, 2), (3, 4)]), iterations=1))
    check(got, {1: 0.14375, 2: 0.35625, 3: 0.14375, 4: 0.35625})


def test_chain_graph_gives_the_published_ranks(spark):
    got = as_dict(el.pagerank(el.chain_graph(spark, 100, sentinel=False)))
    assert len(got) == 10_000
    for node, rank in CHAIN_RANKS.items():
        assert got[node] == pytest.approx(rank, abs=1e-17)
    assert sum(got.values()) == pytest.approx(1.0, abs=1e-12)


def test_chain_graph_gives_the_published_dangling_mass(spark):
    rows = el.dangling_trace(el.chain_graph(spark, 1000, sentinel=False)).collect()
    held = [r.dangling for r in sorted(rows)]
    # Published counters drop the digits after 1e-10 of each of 1000 nodes.
    for got, want in zip(held, CHAIN_DANGLING, strict=True):
        assert -1e-6 < got * 1e10 - want < 1001


@pytest.mark.parametrize("rows_per_stripe", [5, 1_000_000])
def test_hub_with_dangling_nodes(edges_of, rows_per_stripe):
    edges = brute.hub_graph() + [(0, 1000 + i) for i in range(40)]
    want, held = brute.ranks(edges, 4)
    tables = list(el.pagerank_rounds(edges_of(edges), 4, rows_per_stripe=rows_per_stripe))
    assert len(tables) == 5
    check(as_dict(tables[-1]), want)
    trace = el.dangling_trace(edges_of(edges), 4).collect()
    assert [r.dangling for r in sorted(trace)] == pytest.approx(held, abs=1e-14)


def test_all_nodes_dangling_or_none(edges_of):
    assert as_dict(el.pagerank(edges_of([]))) == {}
    ring = [(i, (i + 1) % 5) for i in range(5)]
    check(as_dict(el.pagerank(edges_of(ring))), dict.fromkeys(range(5), 0.2))


def test_no_rounds_gives_the_start_ranks(edges_of):
    check(as_dict(el.pagerank(edges_of([(1, 2)]), iterations=0)), {1: 0.5, 2: 0.5})


def test_edges_are_not_moved_within_a_round(edges_of, monkeypatch):
    plans = {}
    write = storage.RunFolder.write

    def spy(self, name, df, **facts):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(self, name, df, **facts)

    monkeypatch.setattr(storage.RunFolder, "write", spy)
    el.pagerank(edges_of(brute.hub_graph()), iterations=2)
    plan = plans["rounds/iteration=2"]
    assert "BroadcastNestedLoopJoin" not in plan and "Cartesian" not in plan
    assert "PythonUDF" not in plan
    join = plan[plan.index("ShuffledHashJoin") :]
    above, below = join.split("Bucketed: true")
    assert "Exchange" not in above and "Sort" not in above
    assert "Exchange hashpartitioning(src" in below


def parts_of(folder):
    return sorted(p.name for p in (Path(folder) / "rounds").iterdir())


def test_a_run_goes_on_from_its_last_whole_round(edges_of, tmp_path, monkeypatch):
    edges = brute.hub_graph() + [(0, 1000 + i) for i in range(40)]
    want, held = brute.ranks(edges, 7)
    folder = str(tmp_path / "run")
    rounds = el.pagerank_rounds(edges_of(edges), 7, folder=folder)
    for _ in range(5):  # start ranks and four rounds
        next(rounds)
    rounds.close()
    # Round 5 was begun and not ended.
    half = tmp_path / "run" / "rounds" / "iteration=5"
    half.mkdir()
    (half / "part-00000.parquet").write_bytes(b"half")

    worked = []
    step = pagerank._next
    monkeypatch.setattr(pagerank, "_next", lambda *a: worked.append(1) or step(*a))
    monkeypatch.setattr(pagerank, "distinct_edges", lambda _: pytest.fail("edges were read again"))
    tables = dict(el.rank_rounds(edges_of(edges), 7, folder=folder))
    assert sorted(tables) == list(range(8)) and len(worked) == 3
    check(as_dict(tables[7]), want)
    trace = el.dangling_trace(edges_of(edges), 7, folder=folder).collect()
    assert [r.dangling for r in sorted(trace)] == pytest.approx(held, abs=1e-14)
    with pytest.raises(ValueError, match="damping"):
        next(el.pagerank_rounds(edges_of(edges), 7, damping=0.5, folder=folder))


def test_only_the_last_round_stays(edges_of, tmp_path):
    edges = brute.hub_graph()
    folder = str(tmp_path / "run")
    check(as_dict(el.pagerank(edges_of(edges), 3, folder=folder)), brute.ranks(edges, 3)[0])
    assert parts_of(folder) == ["iteration=3"]
    check(as_dict(el.pagerank(edges_of(edges), 5, folder=folder)), brute.ranks(edges, 5)[0])
    assert parts_of(folder) == ["iteration=5"]
    with pytest.raises(ValueError, match="later rounds"):
        el.pagerank(edges_of(edges), 3, folder=folder)


def test_no_tables_are_left_in_the_catalog(spark, edges_of):
    el.pagerank(edges_of([(1, 2), (2, 1)]), 2)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("edgeloom_")]


def test_trace_is_one_scan(edges_of):
    plan = el.dangling_trace(edges_of(brute.hub_graph()), 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_trace_of_an_empty_graph(edges_of):
    assert sorted(map(tuple, el.dangling_trace(edges_of([]), 3).collect())) == [(1, 0.0), (2, 0.0), (3, 0.0)]


def test_nodes_without_in_edges_take_no_part_in_rounds(edges_of, tmp_path):
    """rounds move only what changes from node to node; all nodes are in the result."""
    edges = [(i, i % 5) for i in range(5, 90)] + [(0, 1), (1, 2), (2, 0), (3, 200), (0, 3)]
    folder = str(tmp_path / "run")
    check(as_dict(el.pagerank(edges_of(edges), 4, folder=folder)), brute.ranks(edges, 4)[0])
    spark = edges_of([]).sparkSession
    assert spark.read.parquet(f"{folder}/rounds/iteration=4").count() == 6
    assert spark.read.parquet(f"{folder}/edges").count() == 5
