"""Run tables and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occflow import constants as C
from occflow.sources import run_tables, species_export
from occflow.sources.readers import CSV_DIALECT
from occflow.sources.staging import hadoop_path

SPECIES_DIR = species_export.SPECIES_DIR
POINT_COLUMNS = (C.OBS_ID, f"{C.NOSPACE} AS species", "latitude", "longitude")


def ensure_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


# Observations are read by species and looked up by id.
OBSERVATIONS = run_tables.Arrangement(cluster_by=(C.SPECIES, C.OBS_ID), bloom=(C.OBS_ID,))


def save_run_table(
    df: DataFrame,
    base: str,
    name: str,
    cluster_by: Sequence[str] = (),
    bloom: Sequence[str] = (),
    buckets: tuple[str, int] | None = None,
) -> DataFrame:
    """Replace run table ``name`` in one step and return it as stored; see ``run_tables``.

    ``base`` is a directory, or a catalog schema when it has no slash.
    """
    return run_tables.save(df, base, name, run_tables.Arrangement(cluster_by, bloom, buckets))


def guard_output(spark: SparkSession, path: str) -> None:
    """Fail before any work when an output directory is already there.

    A job that is to take up an unfinished output is called with ``resume`` and isn't guarded.
    """
    jpath, fs = hadoop_path(spark, path)
    if fs.exists(jpath):
        raise FileExistsError(f"output directory exists: {path}")


def export_csv(df: DataFrame, path: str, header: bool = True, resume: bool = False) -> None:
    """``resume`` keeps a finished folder and replaces an unfinished one; otherwise one that exists is refused."""
    done, fs = hadoop_path(df.sparkSession, f"{path}/_SUCCESS")
    if not (resume and fs.exists(done)):
        df.write.options(header=header, **CSV_DIALECT).mode("overwrite" if resume else "errorifexists").csv(path)


def species_list(observations: DataFrame, column: str = C.NOSPACE) -> DataFrame:
    return observations.select(column).distinct().orderBy(F.col(column).asc_nulls_last())


def export_species_list(observations: DataFrame, path: str, column: str = C.NOSPACE, resume: bool = False) -> None:
    export_csv(species_list(observations, column), path, header=False, resume=resume)


def export_by_species(
    observations: DataFrame,
    path: str,
    columns: Sequence[str] = POINT_COLUMNS,
    header: bool = True,
    resume: bool = False,
) -> None:
    """One directory per species in a single job, in place of one query per species; see ``species_export``."""
    species_export.export_by_species(observations, path, columns, header, resume)


def flatten_by_species(spark: SparkSession, path: str) -> None:
    """Rename an export to ``<species>-<n>.csv``, numbered in id order.

    Optional, for readers that expect one flat folder. Moves no data, but renames
    file by file, which object stores do slowly.
    """
    root, fs = hadoop_path(spark, path)
    for directory in fs.listStatus(root):
        name = directory.getPath().getName()
        if not name.startswith(f"{SPECIES_DIR}="):
            continue
        files = sorted(f.getPath().toString() for f in fs.listStatus(directory.getPath()))
        stem = name.split("=", 1)[1]
        for i, source in enumerate(files):
            target = f"{stem}-{i:05d}.csv"
            fs.rename(hadoop_path(spark, source)[0], hadoop_path(spark, f"{path}/{target}")[0])
        fs.delete(directory.getPath(), True)


def species_attributes(species: DataFrame) -> DataFrame:
    return species.select(
        F.col(C.NOSPACE).alias("species"), "family", C.STATUS, C.GROUP, C.IS_VASC, "growth_form"
    ).orderBy(F.col("species").asc_nulls_last())


def metadata_attributes(metadata: DataFrame, flag: str) -> DataFrame:
    return (
        metadata.filter(F.col(flag) == 1)
        .select(
            F.col(C.NOSPACE).alias("species"),
            "family",
            "filter_group",
            C.STATUS,
            C.GROUP,
            C.IS_VASC,
            F.col("gf").alias("growth_form"),
        )
        .orderBy(F.col("species").asc_nulls_last())
    )
