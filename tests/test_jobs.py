"""The command-line jobs on a small file."""

from pathlib import Path

import brute
import pytest

from edgeloom.__main__ import run


def lines_of(path):
    parts = sorted(Path(path).glob("part-*"))
    return sorted(line for p in parts for line in p.read_text().splitlines())


@pytest.fixture
def edges(tmp_path):
    rows = brute.multigraph(11)
    text = "".join(f"{a},{b}\n" for a, b in rows) + "broken\n"
    (tmp_path / "edges").write_text(text)
    return rows, str(tmp_path / "edges")


def test_counting_jobs_print_their_total(spark, edges, capsys):
    rows, path = edges
    run(spark, ["path2", path, "--rejects", path + "-rejects"])
    assert lines_of(path + "-rejects") == ["field_count\tbroken"]
    run(spark, ["triangles", path])
    run(spark, ["triangles", path, "--strategy", "broadcast", "--max-id", "6"])
    run(spark, ["walks", path, "--mode", "semi"])
    small = [(a, b) for a, b in rows if a <= 6 and b <= 6]
    said = capsys.readouterr()
    n, above = len(rows), len(rows) - len(small)
    counts = f"lines: {n + 1}, rejected: 1 (field_count 1, not_a_number 0), above the greatest id: "
    assert [line for line in said.err.splitlines() if line.startswith("lines")] == [
        f"{counts}{x}, edges: {n - x}" for x in (0, 0, above, 0)
    ]
    assert said.out.splitlines() == [
        f"2-paths: {sum(brute.path2(rows, True).values())}",
        f"triangles: {brute.triangles(rows)}",
        f"triangles: {brute.triangles(small)}",
        f"closed walks: {brute.walks(rows, 'semi')}",
    ]


def test_followers_and_pairs_are_written(spark, edges, tmp_path):
    rows, path = edges
    run(spark, ["followers", path, str(tmp_path / "f"), "--out-sep", "\t"])
    want = {b: sum(1 for e in rows if e[1] == b) for _, b in rows}
    assert lines_of(tmp_path / "f") == sorted(f"{v}\t{n}" for v, n in want.items())
    run(spark, ["path2-pairs", path, str(tmp_path / "p"), "--keep-returns"])
    pairs = brute.path2(rows, True)
    assert lines_of(tmp_path / "p") == sorted(f"{x},{z},{n}" for (x, z), n in pairs.items())


def test_rank_jobs(spark, edges, tmp_path):
    rows, path = edges
    run(spark, ["pagerank", path, str(tmp_path / "r"), "--iterations", "2", "--every-round"])
    for i in range(3):
        want, _ = brute.ranks(rows, i)
        got = dict(line.split(",") for line in lines_of(tmp_path / f"r-{i}"))
        assert {int(v): float(r) for v, r in got.items()} == pytest.approx(want, abs=1e-14)
    folder = str(tmp_path / "run")
    run(spark, ["pagerank", path, str(tmp_path / "a"), "--iterations", "1", "--run", folder])
    run(spark, ["pagerank", path, str(tmp_path / "b"), "--iterations", "2", "--run", folder])
    assert lines_of(tmp_path / "b") == lines_of(tmp_path / "r-2")
    run(spark, ["chain", str(tmp_path / "c"), "-k", "3", "--iterations", "1", "--max-node", "4"])
    got = [line.split(",")[0] for line in lines_of(tmp_path / "c")]
    assert got == ["1", "2", "3", "4"]
