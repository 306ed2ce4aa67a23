"""Species attribute tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from occflow import constants as C
from occflow.functions import derive
from occflow.operators.lookups import nulls_last_struct, update_from

COLUMNS = [C.SPECIES, C.NOSPACE, C.STATUS, C.GROUP, C.IS_VASC, "family", "growth_form"]


def with_growth_form(species: DataFrame, growth_forms: DataFrame) -> DataFrame:
    return update_from(
        species, growth_forms, C.SPECIES, "species", {"family": "family", "growth_form": "gf"}
    )


def species_table(profile: DataFrame, growth_forms: DataFrame) -> DataFrame:
    """One row per species and status, with ``obs``, the observations behind it.

    Where a species has several plant groups, all its rows get the first one.
    """
    window = Window.partitionBy(C.SPECIES)
    first = F.min(nulls_last_struct([C.GROUP, C.IS_VASC])).over(window)
    rows = (
        profile.withColumn("first", first)
        .groupBy(
            C.SPECIES,
            C.NOSPACE,
            C.STATUS,
            F.col(f"first.{C.GROUP}").alias(C.GROUP),
            F.col(f"first.{C.IS_VASC}").alias(C.IS_VASC),
        )
        .agg(F.sum("obs").alias("obs"))
    )
    return with_growth_form(rows, growth_forms).select(*COLUMNS, "obs")


def species_table_by_group(observations: DataFrame, growth_forms: DataFrame) -> DataFrame:
    """Earlier form: a species repeats for each status and plant group it has."""
    rows = observations.select(C.SPECIES, C.NOSPACE, C.STATUS, C.GROUP, C.IS_VASC).distinct()
    return with_growth_form(rows, growth_forms)


def with_growth_form_confidence(species: DataFrame, growth_forms: DataFrame) -> DataFrame:
    return update_from(
        species,
        growth_forms,
        "species",
        "species",
        {"growth_form": "gf", "growth_form_conf": "gf_conf_flag"},
    )


def with_filter_group(species: DataFrame, metadata: DataFrame) -> DataFrame:
    return update_from(
        species.withColumn("is_modelled", F.lit(0)),
        metadata,
        "species",
        C.SPECIES,
        {"is_modelled": F.lit(1), "filter_group": "filter_group"},
    )


def with_filter_counts(species: DataFrame, crosstab: DataFrame) -> DataFrame:
    return update_from(
        species,
        crosstab,
        "species",
        "species",
        {
            "obs_common": F.col("`8. observation_type`"),
            "obs_rare": F.col("`6. year>=1970`"),
            "obs_rare_native": F.col("`7. is_introduced`"),
        },
    )


def modelled_species(species: DataFrame) -> DataFrame:
    return (
        species.filter((F.col("is_modelled") == 1) & (F.col(C.STATUS) == C.ACCEPTED))
        .select(
            "species",
            "genus",
            "family",
            "growth_form",
            "growth_form_conf",
            C.STATUS,
            C.GROUP,
            "is_vascular",
            "filter_group",
            "obs_total",
            "obs_introduced",
        )
        .orderBy(F.col("species").asc_nulls_last())
    )


def introduced_summary(
    all_species: DataFrame, growth_forms: DataFrame, metadata: DataFrame, crosstab: DataFrame
) -> DataFrame:
    """Total and introduced observations of accepted, modelled species."""
    return (
        all_species.transform(with_growth_form_confidence, growth_forms)
        .transform(with_filter_group, metadata)
        .transform(with_filter_counts, crosstab)
        .transform(derive.with_obs_introduced)
        .transform(derive.with_obs_total)
        .transform(modelled_species)
    )


def combine(main: DataFrame, supplemental: DataFrame) -> DataFrame:
    return main.unionByName(supplemental)
