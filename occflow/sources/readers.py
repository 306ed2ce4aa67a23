"""Inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from occflow import constants as C
from occflow.operators.lookups import has_duplicates
from occflow.sources import run_tables

# Fields are written and read verbatim: quotes doubled, blanks kept, an empty
# string quoted and null left empty.
CSV_DIALECT = {
    "quote": '"',
    "escape": '"',
    "emptyValue": '""',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# A text that no field holds stands for null, so that a quoted empty field isn't null.
AS_WRITTEN = {**CSV_DIALECT, "emptyValue": "", "nullValue": "\x00"}


def read_table(spark: SparkSession, source: str) -> DataFrame:
    """A Parquet directory or run table when ``source`` looks like a path, else a catalog table."""
    return run_tables.read(spark, source)


class SchemaError(ValueError):
    """What is wrong with the columns of an input."""


def check_schema(df: DataFrame, expected: str | StructType, what: str, extra: bool = True) -> DataFrame:
    """``df`` if its columns are as declared; else one error that names all that aren't.

    Columns may come in any order; further ones are allowed if ``extra``. Names count
    with their case, as a name in another case is resolved but not written as declared.
    """
    declared = StructType.fromDDL(expected) if isinstance(expected, str) else expected
    wanted = {f.name: f.dataType.simpleString() for f in declared.fields}
    found: dict[str, list[str]] = {}
    for f in df.schema.fields:
        found.setdefault(f.name, []).append(f.dataType.simpleString())
    faults = [f"missing: {n} {t}" for n, t in wanted.items() if n not in found]
    faults += [f"retyped: {n} {'/'.join(found[n])}, declared {t}" for n, t in wanted.items() if n in found and found[n] != [t]]
    faults += [f"repeated: {n}" for n, t in found.items() if len(t) > 1 and n not in wanted]
    if not extra:
        faults += [f"extra: {n} {'/'.join(t)}" for n, t in found.items() if n not in wanted]
    if faults:
        raise SchemaError(f"{what}: " + "; ".join(faults))
    return df


def read_occurrences(spark: SparkSession, source: str, expected: str | StructType = C.OCCURRENCE_SCHEMA) -> DataFrame:
    """The occurrence table; columns that a run relies on are checked before any work."""
    return check_schema(read_table(spark, source), expected, source)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    header: bool,
    free_text: bool = False,
    skip_damaged: bool = False,
    **files: object,
) -> DataFrame:
    """Files of our dialect, as written: an empty field is null, a quoted empty one an empty string.

    ``free_text`` allows line breaks within fields. A file is then read by one task, so
    keep such files moderate in size. ``skip_damaged`` passes over the rest of a file that
    can't be read. ``files`` are further options that choose files.
    """
    options = {**AS_WRITTEN, "multiLine": free_text, "ignoreCorruptFiles": skip_damaged, **files}
    return spark.read.schema(schema).options(header=header, **options).csv(path)


def csv_header(spark: SparkSession, path: str) -> DataFrame:
    """The columns that the first line of a file names, as strings."""
    return spark.read.options(header=True, **CSV_DIALECT).csv(path)


def read_species_list(spark: SparkSession, path: str) -> DataFrame:
    """One column of names with underscores, no header."""
    return read_csv(spark, path, "species_ul string", header=False)


def read_checklist(spark: SparkSession, path: str) -> DataFrame:
    """One column of species names, with header. The header is checked, and names must be unique."""
    check_schema(csv_header(spark, path), "species string", path, extra=False)
    checklist = read_csv(spark, path, "species string", header=True)
    if has_duplicates(checklist, ["species"], "repeated").first()["repeated"]:
        raise ValueError(f"checklist has repeated species: {path}")
    return checklist


def extract_checklist(distribution: DataFrame) -> DataFrame:
    """Distinct species-rank taxa of a distribution table, from any Spark source."""
    return (
        distribution.filter(F.col("taxon_rank") == "species")
        .select(F.col("taxon").alias("species"))
        .distinct()
        .orderBy(F.col("species").asc_nulls_last())
    )
