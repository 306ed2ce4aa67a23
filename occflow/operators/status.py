"""Native status of species, and removal of species that a run must not repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occflow import constants as C
from occflow.functions import filters
from occflow.operators.lookups import flag_matches, update_from


def joined_set(column: str) -> Column:
    """Sorted distinct values joined by commas; null when there are none."""
    values = F.collect_set(F.col(column).cast("string"))
    return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), ","))


def native_status_table(
    observations: DataFrame, columns: Sequence[str] = ("is_introduced", "native_status")
) -> DataFrame:
    """Per species, the set of values of each column and the number of observations.

    Counting per combination comes first and combines on the map side; the sets
    are then collected from the few combinations a species has.
    """
    combinations = observations.groupBy(C.SPECIES, *columns).agg(F.count(F.lit(1)).alias("obs"))
    return status_sets(combinations, columns)


def status_sets(
    combinations: DataFrame, columns: Sequence[str] = ("is_introduced", "native_status")
) -> DataFrame:
    """Native-status sets from counts ``obs`` of combinations, which may have further columns."""
    return (
        combinations.filter(filters.has_species())
        .groupBy(C.SPECIES)
        .agg(*[joined_set(c).alias(c) for c in columns], F.sum("obs").alias("obs"))
    )


def flag_modelled(species: DataFrame, modelled: DataFrame) -> DataFrame:
    return flag_matches(species, modelled, C.SPECIES, C.SPECIES, "is_sdm_species")


def flag_shared(species: DataFrame, previous: DataFrame) -> DataFrame:
    return flag_matches(species, previous, C.SPECIES, C.SPECIES, "is_in_run1")


def flag_listed(species: DataFrame, checklist: DataFrame) -> DataFrame:
    return flag_matches(species, checklist, C.SPECIES, "species", "is_in_nsr")


def flag_not_unlisted(species: DataFrame, native_status: DataFrame) -> DataFrame:
    """``is_in_nsr`` is 1 unless the species' status set shows that no checklist has it."""
    unlisted = native_status.filter(filters.in_no_checklist(F.col("native_status")))
    return update_from(
        species.withColumn("is_in_nsr", F.lit(1)),
        unlisted,
        C.SPECIES,
        C.SPECIES,
        {"is_in_nsr": F.lit(0)},
    )
