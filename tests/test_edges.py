import brute
import pytest

import edgeloom as el

LINES = ["1,2", "1,2,3", "1,2,", "1", "1,", "", "x,2"]


@pytest.fixture
def lines(spark):
    def build(rows):
        return spark.createDataFrame([(r,) for r in rows], "line STRING")

    return build


def test_malformed_lines(lines):
    df = lines(LINES)
    assert [tuple(r) for r in el.parse_edges(df).collect()] == [(1, 2), (1, 2)]
    rejects = {r.line: r.reason for r in el.parse_rejects(df).collect()}
    assert rejects == {
        "1,2,3": "field_count",
        "1": "field_count",
        "1,": "field_count",
        "": "field_count",
        "x,2": "not_a_number",
    }


def test_ids_must_be_whole_numbers_that_fit(lines):
    good = ["-3,+4", "007,8"]
    bad = [" 1,2", "1.0,2", "1e3,2", "9223372036854775808,1", ",2", "1,NaN"]
    df = lines(good + bad)
    assert sorted(tuple(r) for r in el.parse_edges(df).collect()) == [(-3, 4), (7, 8)]
    assert {r.line for r in el.parse_rejects(df).collect()} == set(bad)


def test_lines_with_other_separators(lines):
    assert el.parse_edges(lines(["1\t2", "3\t4\t"]), "\t").count() == 2
    assert el.parse_edges(lines(["1 2", "2 0"]), " ").count() == 2
    assert el.parse_edges(lines(["1|2", "1,2"]), "|").count() == 1


def test_max_filter_is_inclusive_on_both_ends(edges_of):
    df = edges_of([(5, 5), (5, 6), (6, 5), (1, 2)])
    assert sorted(tuple(r) for r in el.max_filter(df, 5).collect()) == [(1, 2), (5, 5)]
    assert el.max_filter(df, None).count() == 4


def test_reverse_distinct_weighted_and_tagged(edges_of):
    df = edges_of([(1, 2), (1, 2), (2, 2)])
    assert sorted(tuple(r) for r in el.reverse_edges(df).collect()) == [
        (2, 1),
        (2, 1),
        (2, 2),
    ]
    assert el.distinct_edges(df).count() == 2
    weights = {(r.src, r.dst): r.m for r in el.weighted_edges(df).collect()}
    assert weights == {(1, 2): 2, (2, 2): 1}
    tagged = el.tag_inputs(Original=df, New=el.reverse_edges(df))
    assert tagged.groupBy("tag").count().collect() == [("Original", 3), ("New", 3)]


def test_degrees_and_dangling_nodes(edges_of):
    df = edges_of([(1, 2), (1, 2), (2, 2), (3, 4)])
    degrees = {r.node: (r.in_deg, r.out_deg) for r in el.degree_in_out(df).collect()}
    assert degrees == {1: (0, 2), 2: (3, 1), 3: (0, 1), 4: (1, 0)}
    assert {r.node: r.followers for r in el.follower_count(df).collect()} == {2: 3, 4: 1}
    assert {r.node: r.out_deg for r in el.out_degree(df).collect()} == {1: 2, 2: 1, 3: 1}
    assert [r.node for r in el.dangling_nodes(df).collect()] == [4]


def test_operators_accept_no_rows(edges_of):
    df = edges_of([])
    for op in (
        el.follower_count,
        el.degree_in_out,
        el.dangling_nodes,
        el.adjacency_list,
        el.adjacency_set,
        el.path2_pairs,
    ):
        assert op(df).count() == 0


@pytest.mark.parametrize("max_len", [3, 1000])
def test_adjacency_is_whole_when_split(edges_of, max_len):
    edges = brute.hub_graph()
    got = el.adjacency_list(edges_of(edges), max_len).collect()
    assert all(len(r.neighbours) <= max_len for r in got)
    back = {}
    for r in sorted(got, key=lambda r: (r.src, r.part)):
        assert r.n == sum(r.copies)
        rows = [d for d, m in zip(r.neighbours, r.copies) for _ in range(m)]
        back.setdefault(r.src, []).extend(rows)
    want = {}
    for a, b in sorted(edges):
        want.setdefault(a, []).append(b)
    assert back == want

    sets = el.adjacency_set(edges_of(edges), max_len).collect()
    assert all(len(r.neighbours) <= max_len and r.n == len(r.neighbours) for r in sets)
    joined = {}
    for r in sorted(sets, key=lambda r: (r.src, r.part)):
        joined.setdefault(r.src, []).extend(r.neighbours)
    assert joined == {a: sorted(set(b)) for a, b in want.items()}


def test_parts_have_the_same_length_whatever_the_ids(edges_of, monkeypatch):
    from edgeloom.operators import adjacency

    monkeypatch.setattr(adjacency, "ROWS_PER_RANGE", 16)
    ids = [*range(-99, 100), *range(10**12, 10**12 + 10**9, 10**7)]
    edges = [(7, i) for i in ids] + [(8, 1), (9, -5)]
    got = el.adjacency_set(edges_of(edges), 50).where("src = 7").collect()
    rows = sorted(got, key=lambda r: r.part)
    assert [r.n for r in rows] == [50] * 5 + [len(set(ids)) - 250]
    assert [d for r in rows for d in r.neighbours] == sorted(set(ids))


def test_chain_graph(spark):
    rows = sorted(tuple(r) for r in el.chain_graph(spark, 2).collect())
    assert rows == [(1, 2), (2, 0), (3, 4), (4, 0)]
    rows = sorted(tuple(r) for r in el.chain_graph(spark, 2, sentinel=False).collect())
    assert rows == [(1, 2), (3, 4)]


def test_chain_over_a_table_that_ends_within_a_chain(spark):
    nodes = spark.range(1, 6).selectExpr("id AS node")
    rows = sorted(tuple(r) for r in el.chain_edges(nodes, 2).collect())
    assert rows == [(1, 2), (2, 0), (3, 4), (4, 0), (5, 0)]


def test_layout_by_the_greater_id_is_read_in_part(spark, edges_of, tmp_path):
    from pyarrow import parquet

    edges = [(i % 997, i % 13 * 40) for i in range(5000)]
    path = str(tmp_path / "t")
    el.write_by_greatest(edges_of(edges), path, rows_per_file=500)
    for limit in (None, 0, 100, 10**6):
        want = sorted(e for e in edges if limit is None or max(e) <= limit)
        assert sorted(map(tuple, el.read_up_to(spark, path, limit).collect())) == want
    ends = []
    for file in (tmp_path / "t").glob("*.parquet"):
        groups = parquet.ParquetFile(file).metadata
        for i in range(groups.num_row_groups):
            known = groups.row_group(i).column(2).statistics
            ends.append((known.min, known.max))
    ends.sort()
    assert len(ends) >= 10 and all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    plan = el.read_up_to(spark, path, 100)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(greatest), LessThanOrEqual(greatest,100)]" in plan
    assert sum(a <= 100 for a, _ in ends) < len(ends) / 3
