"""Species profile of an extract and removal of conflicting taxonomic status.

The profile holds one row per species, status and group with a row count. One
pass of map-side combined counting makes it, so a species with a third of all
rows costs no more than any other, and every rule at species level works on the
profile instead of the observations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from occflow import constants as C

PROFILE_KEYS = [C.SPECIES, C.NOSPACE, C.STATUS, C.GROUP, C.IS_VASC]


def species_profile(observations: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Row counts by the profile's keys and, if asked, ``more`` columns."""
    return observations.groupBy(*PROFILE_KEYS, *more).agg(F.count(F.lit(1)).alias("obs"))


def narrow_profile(profile: DataFrame) -> DataFrame:
    """The plain profile from one with more columns."""
    return profile.groupBy(*PROFILE_KEYS).agg(F.sum("obs").alias("obs"))


def merge_profiles(*profiles: DataFrame) -> DataFrame:
    """The profile of the observations of all of them together."""
    whole = profiles[0].select(*PROFILE_KEYS, "obs")
    for more in profiles[1:]:
        whole = whole.unionByName(more.select(*PROFILE_KEYS, "obs"))
    return narrow_profile(whole)


def species_status(observations: DataFrame) -> DataFrame:
    """Distinct species and taxonomic status."""
    return observations.select(C.SPECIES, C.NOSPACE, C.STATUS).distinct()


def species_groups(observations: DataFrame) -> DataFrame:
    """Distinct species and plant group."""
    return observations.select(C.SPECIES, C.GROUP, C.IS_VASC).distinct()


def multistatus_species(observations: DataFrame) -> DataFrame:
    """Species with more than one status. A null status counts as one."""
    return (
        species_status(observations)
        .groupBy(C.SPECIES)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) & F.col(C.SPECIES).isNotNull())
        .select(C.SPECIES)
    )


def mark_dropped(profile: DataFrame) -> DataFrame:
    """Add ``is_dropped`` to profile rows of conflicting names.

    Every status but Accepted goes when a species has several, also when none of
    them is Accepted. A null status always stays.
    """
    species = Window.partitionBy(C.SPECIES)
    status = F.col(C.STATUS)
    # The window spans the few profile rows of one species, never observations.
    n_status = F.size(F.collect_set(status).over(species)) + F.max(
        status.isNull().cast("int")
    ).over(species)
    conflicting = (n_status > 1) & F.col(C.SPECIES).isNotNull()
    return profile.withColumn(
        "is_dropped", conflicting & status.isNotNull() & (F.coalesce(status, F.lit(C.ACCEPTED)) != C.ACCEPTED)
    )


def dropped_names(profile: DataFrame) -> DataFrame:
    """Species and status pairs whose observations have to go."""
    return mark_dropped(profile).filter("is_dropped").select(C.SPECIES, C.STATUS).distinct()


def drop_names(observations: DataFrame, names: DataFrame) -> DataFrame:
    return observations.join(names, [C.SPECIES, C.STATUS], "left_anti").select(*observations.columns)


def distinct_taxa(observations: DataFrame, species: DataFrame) -> DataFrame:
    """Distinct taxa, with author, of the observations of the given species."""
    taxa = observations.select(
        "scrubbed_family",
        C.SPECIES,
        "scrubbed_taxon_name_no_author",
        "scrubbed_author",
        "scrubbed_taxonomic_status",
    ).distinct()
    return taxa.join(species.select(C.SPECIES), C.SPECIES, "left_semi").select(*taxa.columns)


def species_rank_taxa(taxa: DataFrame) -> DataFrame:
    """Taxa that are the species itself; authors are left out, as they vary in spelling."""
    return (
        taxa.filter(F.col(C.SPECIES) == F.col("scrubbed_taxon_name_no_author"))
        .drop("scrubbed_author")
        .distinct()
    )


def conflicting_taxa(taxa: DataFrame) -> DataFrame:
    """All taxa of species that have several rows even at species rank."""
    conflicting = (
        species_rank_taxa(taxa).groupBy(C.SPECIES).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    )
    return (
        taxa.join(conflicting.select(C.SPECIES), C.SPECIES, "inner")
        .select(*taxa.columns)
        .orderBy(F.col(C.SPECIES).asc_nulls_last())
    )
