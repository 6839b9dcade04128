import pytest

from edgeloom.storage import (
    SETTING,
    BucketedTable,
    RunFolder,
    delete,
    keep,
    new_path,
    shared_folder,
    use_local_folder,
)


class Conf(dict):
    set = dict.__setitem__


class Session:
    """The two session calls that the folder lookup makes."""

    def __init__(self, **conf):
        self.conf = Conf({k.replace("__", "."): v for k, v in conf.items()})
        self.sparkContext = self

    def getCheckpointDir(self):
        return None


def test_the_folder_named_by_the_cluster_is_used():
    session = Session(spark__checkpoint__dir="hdfs:///shared/", spark__master="yarn")
    assert shared_folder(session) == "hdfs:///shared"


@pytest.mark.parametrize("master", ["yarn", "local-cluster[2,1,1024]", "spark://host:7077"])
def test_no_local_folder_on_a_cluster(master):
    session = Session(spark__master=master)
    use_local_folder(session)
    with pytest.raises(RuntimeError, match=SETTING):
        shared_folder(session)


@pytest.mark.parametrize("master", ["local", "local[2]", "local[*]"])
def test_local_mode_gets_one_temporary_folder_on_request(master):
    session = Session(spark__master=master)
    with pytest.raises(RuntimeError, match=SETTING):
        shared_folder(session)
    use_local_folder(session)
    folder = shared_folder(session)
    use_local_folder(session)
    assert folder == shared_folder(session) == session.conf[SETTING]


def test_kept_tables_have_their_own_paths_and_the_same_rows(spark):
    assert new_path(spark, "t") != new_path(spark, "t")
    df = spark.range(10).selectExpr("id", "id * 0.5D AS half")
    table = keep(df, "t")
    assert table.schema.names == df.schema.names
    assert sorted(table.collect()) == sorted(df.collect())
    assert new_path(spark, "t").startswith(shared_folder(spark))


def test_only_own_tables_can_be_deleted(spark, tmp_path):
    path = new_path(spark, "t")
    spark.range(3).write.parquet(path)
    delete(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError, match="shared folder"):
        delete(spark, str(tmp_path))


def test_tables_of_a_run_count_when_they_are_marked(spark, tmp_path):
    run = RunFolder(spark, str(tmp_path / "run"))
    assert run.facts("t") is None and run.rounds() == []
    table = run.write("t", spark.range(5), note="x")
    assert RunFolder(spark, run.folder).facts("t") == {"note": "x"} and table.count() == 5
    for i in (0, 2, 10):
        run.write(run.round(i), spark.range(i).withColumnRenamed("id", "n"))
    spark.range(4).write.parquet(run.path(run.round(11)))
    assert run.rounds() == [0, 2, 10]
    rows = run.all_rounds("n BIGINT").groupBy("iteration").count().collect()
    assert sorted(map(tuple, rows)) == [(2, 2), (10, 10), (11, 4)]
    run.drop("t")
    assert run.facts("t") is None


def test_a_bucketed_table_is_found_again(spark, tmp_path):
    run = RunFolder(spark, str(tmp_path / "run"))
    rows = spark.range(1000).selectExpr("id % 37 AS a", "CAST(id % 3 AS INT) AS b", "id AS c")
    first = BucketedTable(run, "t", ["a", "b"], 5)
    assert first.write(rows, size=1).count() == 1000
    first.close()
    again = BucketedTable(run, "t", ["a", "b"], run.facts("t")["buckets"])
    table = again.read("a BIGINT, b INT, c BIGINT")
    assert sorted(table.collect()) == sorted(rows.collect())
    sums = table.groupBy("a", "b").sum("c")
    assert "Exchange" not in sums._jdf.queryExecution().executedPlan().toString()
    again.close()
