"""Tables kept in the folder that all executors share.

Iterative jobs write their intermediate tables here instead of holding them
on executors, so a lost executor costs a re-read and not a re-computation.
"""

from __future__ import annotations

import contextlib
import json
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; an error if the session names none."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError(f"set {SETTING} to a folder that all executors can reach")
    return folder.rstrip("/")


def use_local_folder(spark: SparkSession) -> None:
    """Name a temporary folder on a single-process session that names none.

    For trial runs and tests. On a cluster, ``local-cluster`` included, executors are other
    processes, and nothing is set.
    """
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not named and re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        spark.conf.set(SETTING, tempfile.mkdtemp(prefix="edgeloom-"))


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call uses."""
    return f"{shared_folder(spark)}/edgeloom/{uuid.uuid4().hex}/{name}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a table that a job of this library wrote and needs no longer."""
    if not path.startswith(f"{shared_folder(spark)}/edgeloom/"):
        raise ValueError(f"{path} is not below the shared folder's edgeloom/")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def parts_apart(spark: SparkSession) -> Iterator[None]:
    """Jobs run meanwhile keep the tasks of a union's parts apart.

    Spark else merges parts that are partitioned alike, so that many parts of one task each are one task.
    """
    setting = "spark.sql.unionOutputPartitioning"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "false")
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


class RunFolder:
    """Tables of one job below one folder, each marked when it is whole.

    A job that is started again with the same folder goes on from the tables that are marked; what an
    ended job left half-written is written anew. Rounds of an iteration are the partitions
    ``iteration=0, 1, ...`` of one table.
    """

    MARK = "_whole"
    ROUNDS = "rounds"

    def __init__(self, spark: SparkSession, folder: str | None = None, name: str = "run") -> None:
        self.spark = spark
        self.folder = (folder or new_path(spark, name)).rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def facts(self, name: str) -> dict | None:
        """What was noted when the table was marked; None if it is not whole."""
        mark = self._path(f"{self.path(name)}/{self.MARK}")
        if not self._fs.exists(mark):
            return None
        stream = self._fs.open(mark)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def mark(self, name: str, **facts) -> dict:
        """Note that a table is whole, with a few facts about it."""
        stream = self._fs.create(self._path(f"{self.path(name)}/{self.MARK}"), True)
        try:
            stream.write(json.dumps(facts).encode())
        finally:
            stream.close()
        return facts

    def drop(self, name: str) -> None:
        self._fs.delete(self._path(self.path(name)), True)

    def write(self, name: str, df: DataFrame, **facts) -> DataFrame:
        """Write a table, mark it, and return the written one."""
        df.write.mode("overwrite").parquet(self.path(name))
        self.mark(name, **facts)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def round(self, i: int) -> str:
        return f"{self.ROUNDS}/iteration={i}"

    def rounds(self) -> list[int]:
        """Numbers of the whole rounds."""
        top = self._path(self.path(self.ROUNDS))
        if not self._fs.exists(top):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(top)]
        numbers = sorted(int(n.partition("=")[2]) for n in names if n.startswith("iteration="))
        return [i for i in numbers if self.facts(self.round(i)) is not None]

    def all_rounds(self, schema: str) -> DataFrame:
        """All rounds there are as one table, ``iteration`` being a column of it."""
        return self.spark.read.schema(f"{schema}, iteration BIGINT").parquet(self.path(self.ROUNDS))


class BucketedTable:
    """A table in a run folder, bucketed so that joins on its keys need not move it.

    Spark keeps bucketing in its catalog, so the files are listed there under a name of their own
    until ``close``; the files stay.
    """

    def __init__(self, run: RunFolder, name: str, keys: list[str], buckets: int) -> None:
        self.run, self.name, self.keys, self.buckets = run, name, keys, buckets
        self.listed = f"edgeloom_{uuid.uuid4().hex}"

    def write(self, df: DataFrame, **facts) -> DataFrame:
        """One file a bucket, sorted by the keys."""
        self.run.drop(self.name)
        # By the same hash as the buckets, so that each task writes one of them.
        placed = df.repartition(self.buckets, *self.keys)
        writer = placed.write.format("parquet").option("path", self.run.path(self.name))
        writer.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(self.listed)
        self.run.mark(self.name, buckets=self.buckets, **facts)
        return self.run.spark.table(self.listed)

    def read(self, schema: str) -> DataFrame:
        """The table as another session left it."""
        keys = ", ".join(self.keys)
        self.run.spark.sql(
            f"CREATE TABLE {self.listed} ({schema}) USING parquet "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.run.path(self.name)}'"
        )
        return self.run.spark.table(self.listed)

    def close(self) -> None:
        self.run.spark.sql(f"DROP TABLE IF EXISTS {self.listed}")
