from pathlib import Path

import brute
from pyspark.sql import functions as F

import pytest

import edgeloom as el
from edgeloom.sinks.text import in_text_order


def lines_of(path):
    parts = sorted(Path(path).glob("part-*"))
    return [line for p in parts for line in p.read_text().splitlines()]


def test_raw_files_with_rejects(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1,2\n2,3,\nx,1\n\n")
    (tmp_path / "b.txt").write_text("3,1\n1,2,3\n")
    paths = [str(tmp_path / n) for n in ("a.txt", "b.txt")]
    edges, rejects = el.read_edge_lines(spark, paths)
    assert sorted(tuple(r) for r in edges.collect()) == [(1, 2), (2, 3), (3, 1)]
    assert rejects.count() == 3


def test_space_separated_file(spark, tmp_path):
    (tmp_path / "chain").write_text("1 2\n2 0\n3 4\n4 0")
    edges = el.read_edges(spark, str(tmp_path / "chain"), " ")
    assert sorted(tuple(r) for r in edges.collect()) == [(1, 2), (2, 0), (3, 4), (4, 0)]


def test_text_order_sorts_by_the_text_of_the_key(edges_of, tmp_path):
    df = edges_of([(2, 1), (10, 1), (1, 1), (10, 0)])
    el.write_delimited(df, str(tmp_path / "o"), text_order=True)
    assert lines_of(tmp_path / "o") == ["1,1", "10,0", "10,1", "2,1"]


def test_copies_of_one_row_are_sorted_in_pieces(spark):
    df = spark.range(3000).selectExpr("IF(id % 3 = 0, id, 7) AS src", "2L AS dst")
    out = in_text_order(df, copies=100)
    rows = [tuple(r) for r in out.collect()]
    assert rows == sorted((tuple(r) for r in df.collect()), key=lambda r: str(r[0]))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        where = out.select("src", F.spark_partition_id().alias("task"))
        holders = where.where("src = 7").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert holders > 3


def test_read_edges_has_the_rule_of_the_line_parser(spark, tmp_path):
    lines = ["1,2", "1,2,3", "1,2,", "1", '"7",8', " x,2", "-3,+4", "9,99999999999999999999"]
    (tmp_path / "odd.csv").write_text("\n".join(lines))
    got = sorted(tuple(r) for r in el.read_edges(spark, str(tmp_path)).collect())
    assert got == [(-3, 4), (1, 2), (1, 2)]
    with pytest.raises(ValueError, match="one character"):
        el.read_edges(spark, str(tmp_path), "||")


def test_tuples_keep_doubles_exactly(spark, tmp_path):
    values = [(0, 0.0), (8, 7.702118669812162e-05), (12, 1.0 / 3.0)]
    df = spark.createDataFrame(values, "node BIGINT, rank DOUBLE")
    el.write_tuples(df, str(tmp_path / "t"))
    assert "(8,7.702118669812162E-5)" in lines_of(tmp_path / "t")
    back = el.read_tuples(spark, str(tmp_path / "t"), "node BIGINT, rank DOUBLE")
    assert sorted(tuple(r) for r in back.collect()) == values


def test_split_by_rows(edges_of):
    df = edges_of(brute.multigraph(4, edges=100))
    split = el.split_by_rows(df, 40)
    assert split.rdd.getNumPartitions() == 3
    assert split.count() == 100


def test_lines_are_parsed_by_one_rule(spark, tmp_path):
    lines = ["1,2", "2,3,", "x,1", "", "1,2,3", "9,1", "99999999999999999999,1", "+4,-5"]
    df = spark.createDataFrame([(x,) for x in lines], "line STRING")
    parsed = el.parse_lines(df)
    edges = parsed.where("reason IS NULL").select("src", "dst")
    assert sorted(edges.collect()) == sorted(el.parse_edges(df).collect())
    rejects = parsed.where("reason IS NOT NULL").select("line", "reason")
    assert sorted(rejects.collect()) == sorted(el.parse_rejects(df).collect())
    counted, seen = el.counted_lines(parsed, 3)
    assert len(counted.where("reason IS NULL").collect()) == 4
    want = {"lines": 8, "field_count": 2, "not_a_number": 2, "above_max": 2, "edges": 2}
    assert seen.get == want


def test_lines_are_numbered_where_they_are(spark, tmp_path):
    text = {f"f{i}": [f"{i}-{j}" * (j % 5 + 1) for j in range(300 * i)] for i in range(4)}
    for name, lines in text.items():
        (tmp_path / name).write_text("".join(f"{x}\n" for x in lines))
    whole = [x for name in sorted(text) for x in text[name]]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        parts = el.split_lines(spark, str(tmp_path), 70)
        plan = parts._jdf.queryExecution().executedPlan().toString()
        rows = sorted(parts.collect(), key=lambda r: r.pos)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.pos, r.line) for r in rows] == list(enumerate(whole, 1))
    assert [r.part for r in rows] == [i // 70 for i in range(len(whole))]
    # Only the index of blocks is exchanged.
    assert "Exchange hashpartitioning" not in plan and plan.count("Exchange SinglePartition") == 1
    with pytest.raises(ValueError):
        el.split_lines(spark, str(tmp_path), 0)


def test_many_parts_share_partitions(spark):
    """the driver hears from a bounded number of tasks."""
    split = el.split_by_rows(spark.range(30_000, numPartitions=4).toDF("src"), 10)
    assert split.rdd.getNumPartitions() == 2**11
    sizes = [r["count"] for r in split.groupBy("part").count().collect()]
    assert len(sizes) == 3000 and max(sizes) <= 14 and sum(sizes) == 30_000
