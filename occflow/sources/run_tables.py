"""Tables of a run, replaced as a whole.

A table is written as a new version beside the one in use; then a small pointer is
switched to it in one step. A write that fails, or an executor or driver lost midway,
leaves the old version in use, and whoever reads the old version goes on reading it:
the version before the current one is kept, older ones are removed.

In a folder the pointer is a file that a rename puts in place; in a catalog it is a
view, and versions are tables beside it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql.types import StructType

from occflow.sources.staging import hadoop_path, shuffles_freed

POINTER = "_current"
CURRENT, PREVIOUS = "occflow.current", "occflow.previous"


@dataclass(frozen=True)
class Arrangement:
    """How the rows of a table lie.

    Rows sorted by ``cluster_by`` let reads of single keys skip most row groups by their
    statistics; intervals that end in a unique column also divide a key of many rows.
    ``bloom`` names columns that get a Bloom filter in each row group, for single values
    of a column that the rows aren't sorted by. A table of a catalog can have ``buckets``
    (column and number): tables alike in these join by that column without a shuffle.
    Rows are then only sorted within their bucket.
    """

    cluster_by: Sequence[str] = ()
    bloom: Sequence[str] = ()
    buckets: tuple[str, int] | None = None

    def laid_out(self, df: DataFrame) -> DataFrame:
        if self.buckets:
            column, count = self.buckets
            return df.repartition(count, column)
        if self.cluster_by:
            return df.repartitionByRange(*self.cluster_by).sortWithinPartitions(*self.cluster_by)
        return df

    def writer(self, df: DataFrame) -> DataFrameWriter:
        made = self.laid_out(df).write.format("parquet").option("compression", "zstd")
        for column in self.bloom:
            made = made.option(f"parquet.bloom.filter.enabled#{column}", "true")
        if self.buckets:
            column, count = self.buckets
            made = made.bucketBy(count, column).sortBy(*(self.cluster_by or (column,)))
        return made


# --- Folders ---


def _pointer(spark: SparkSession, root: str) -> list[str]:
    """The current version and the one before it, as far as there are any."""
    path, fs = hadoop_path(spark, f"{root}/{POINTER}")
    if not fs.exists(path):
        return []
    stream = fs.open(path)
    try:
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return list(iter(reader.readLine, None))
    finally:
        stream.close()


def _switch(spark: SparkSession, root: str, versions: Sequence[str]) -> None:
    """Put a pointer to ``versions`` in place, over an older one."""
    jvm = spark._jvm
    made, fs = hadoop_path(spark, f"{root}/{POINTER}.{uuid.uuid4().hex[:8]}")
    target, _ = hadoop_path(spark, f"{root}/{POINTER}")
    stream = fs.create(made, True)
    stream.write("\n".join(versions).encode())
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(made.toUri(), spark._jsc.hadoopConfiguration())
    overwrite = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = overwrite
    context.rename(fs.makeQualified(made), fs.makeQualified(target), options)


def _remove(spark: SparkSession, path: str) -> None:
    target, fs = hadoop_path(spark, path)
    fs.delete(target, True)


def _save_folder(df: DataFrame, root: str, how: Arrangement) -> str:
    if how.buckets:
        raise ValueError("only tables of a catalog have buckets")
    spark, version = df.sparkSession, f"v-{uuid.uuid4().hex[:12]}"
    try:
        with shuffles_freed(spark):
            how.writer(df.select("*")).save(f"{root}/{version}")
    except Exception:
        _remove(spark, f"{root}/{version}")
        raise
    before = _pointer(spark, root)
    _switch(spark, root, [version, *before[:1]])
    for old in before[1:]:
        _remove(spark, f"{root}/{old}")
    return f"{root}/{version}"


# --- Catalog ---


def _properties(spark: SparkSession, view: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}


def _save_catalog(df: DataFrame, base: str, name: str, how: Arrangement) -> None:
    spark = df.sparkSession
    view, version = f"`{base}`.`{name}`", f"{name}__v_{uuid.uuid4().hex[:12]}"
    stored = f"`{base}`.`{version}`"
    try:
        with shuffles_freed(spark):
            how.writer(df.select("*")).saveAsTable(stored)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {stored}")
        raise
    before: dict[str, str] = {}
    if spark.catalog.tableExists(view):
        if spark.catalog.getTable(view).tableType == "VIEW":
            before = _properties(spark, view)
        else:
            # A plain table of this name, from before there were versions, makes way once.
            spark.sql(f"DROP TABLE {view}")
    kept = before.get(CURRENT, "")
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('{CURRENT}' = '{version}', '{PREVIOUS}' = '{kept}') "
        f"AS SELECT * FROM {stored}"
    )
    if before.get(PREVIOUS):
        spark.sql(f"DROP TABLE IF EXISTS `{base}`.`{before[PREVIOUS]}`")


# --- Both ---


def save(df: DataFrame, base: str, name: str, how: Arrangement | None = None) -> DataFrame:
    """Replace table ``name`` in ``base``, a folder or (without a slash) a catalog schema; return it as stored."""
    spark, how = df.sparkSession, how or Arrangement()
    if "/" not in base:
        _save_catalog(df, base, name, how)
        return spark.table(f"`{base}`.`{name}`")
    return spark.read.schema(df.schema).parquet(_save_folder(df, f"{base}/{name}", how))


def location(spark: SparkSession, path: str) -> str:
    """Where the files of the table at ``path`` are: its current version, or ``path`` if it has no versions."""
    versions = _pointer(spark, path)
    return f"{path}/{versions[0]}" if versions else path


def read(spark: SparkSession, source: str, schema: StructType | None = None) -> DataFrame:
    """A folder when ``source`` looks like a path, else a catalog table or view."""
    if "/" not in source:
        return spark.table(source)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(location(spark, source))


def exists(spark: SparkSession, base: str, name: str) -> bool:
    """Whether a whole version of the table is stored."""
    if "/" not in base:
        return spark.catalog.tableExists(f"`{base}`.`{name}`")
    return bool(_pointer(spark, f"{base}/{name}"))
