"""Every registered query against its SQL, values and types, on whole tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from edgeloom.plans.catalogue import QUERIES

SF_DIR = "/root/testdata/sf0.01"

SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = driver.queries()[name](spark, SF_DIR)
    cur = duck.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()

    assert sorted(got.columns) == sorted(columns)
    assert {c: SPARK_TO_DUCK[t] for c, t in got.dtypes} == types

    rows = sorted(tuple(r) for r in got.select(*columns).collect())
    assert len(rows) > 0
    assert rows == sorted(want)


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["node", "rank"]
    assert result.count() > 0
