"""Registered queries against their SQL on whole tables, and the pipeline's stages."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from edgeloom.llm import jaccard, lines
from edgeloom.llm.oracle import ORACLE
from edgeloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    yield con
    con.close()


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    got = driver.queries()[name](spark, SF_DIR)
    cur = duck.execute(ORACLE[name])
    assert sorted(got.columns) == sorted(d[0] for d in cur.description)
    want = sorted(cur.fetchall(), key=str)
    assert sorted(map(tuple, got.select(*[d[0] for d in cur.description]).collect()), key=str) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_has_a_row_for_each_input_row(spark, duck, name):
    got = driver.queries()[name](spark, SF_DIR)
    sources = {"page_id": "pages", "conv_id": "conversations"}
    key = next((k for k in sources if k in got.columns), "doc_id")
    distinct = "DISTINCT" if key == "conv_id" else ""
    source = sources.get(key, "documents")
    want = sorted(r[0] for r in duck.execute(f"SELECT {distinct} {key} FROM {source}").fetchall())
    assert sorted(r[0] for r in got.select(key).collect()) == want


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "12 34", "en", "s", 5)], docs.schema)
    first = corpus_pipeline.identify_language(spark, docs.union(odd), SF_DIR)
    assert first.columns == docs.columns
    assert first.where("doc_id >= 1000000").isEmpty() and first.count() == docs.count()
    second = corpus_pipeline.drop_repeated_lines(spark, first, SF_DIR)
    assert second.columns == docs.columns
    assert lines.dedup_lines(second).where("__lines.n_dropped > 0").isEmpty()
    third = corpus_pipeline.drop_near_duplicates(spark, second, SF_DIR)
    assert third.columns == docs.columns
    found = jaccard.near_duplicates(second)
    assert third.count() == found.where("doc_id = component_id").count()


def test_pipeline_runs_to_the_end(spark):
    rows = driver.queries()["pipeline"](spark, SF_DIR).collect()
    assert len(rows) > 500 and all(r.lossless for r in rows)
    dirty = {r.doc_id for r in QUERIES["op10_decontamination"](spark, SF_DIR).where("contaminated").collect()}
    assert len({r.doc_id for r in rows}) == len(rows)
    assert not dirty & {r.doc_id for r in rows}
