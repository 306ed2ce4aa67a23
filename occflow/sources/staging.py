"""Intermediate tables in shared storage.

A staged table cuts lineage, outlives a lost executor, and tells the planner its
real size, which is what lets Spark decide by size whether to broadcast it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Off by default: a frame that is run again then shuffles again.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which all machines have to see."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return root


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, for existence checks, removal and renames."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for a frame made and run within goes from the disk when its run ends.

    Otherwise it stays until the driver happens to collect its garbage.
    """
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREED) if before is None else spark.conf.set(FREED, before)


class Stage:
    """Writes intermediate tables below one folder of its own.

    As a context it removes them at the end: write results before.
    """

    def __init__(self, spark: SparkSession, root: str | None = None) -> None:
        self.spark = spark
        base = root or shared_root(spark)
        self.root = f"{base}/occflow-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return it as read back."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Stage:
        return self

    def __exit__(self, *error) -> None:
        self.clear()

    def clear(self) -> None:
        """Remove everything staged here. Frames read from it stop working."""
        path, fs = hadoop_path(self.spark, self.root)
        fs.delete(path, True)
