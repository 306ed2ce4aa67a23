"""Validation jobs over occurrences, run tables and country tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occflow import constants as C
from occflow.functions import derive, filters
from occflow.operators import stats as stats_ops
from occflow.operators import status as status_ops
from occflow.operators import taxonomy
from occflow.operators.lookups import alike, update_from
from occflow.sources.staging import Stage
from occflow.spec import RunSpec


def _n() -> Column:
    return F.count(F.lit(1))


def _asc(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


# --- Dates ---


def backfill_dates(raw: DataFrame, occ: DataFrame, stage: Stage | None = None) -> DataFrame:
    """Take event dates from the occurrences by id, the earliest of each, and derive year and decade.

    Occurrences are cut to the ids and species of ``raw`` before they are shuffled.
    """
    dated = occ.filter(F.col("event_date").isNotNull()).select(C.OBS_ID, C.SPECIES, "event_date")
    dated = alike(dated, raw, stage).select(C.OBS_ID, "event_date")
    return (
        update_from(
            raw.drop("event_date", "event_year", "decade"),
            dated,
            C.OBS_ID,
            C.OBS_ID,
            {"event_date": "event_date"},
        )
        .transform(derive.with_event_year)
        .transform(derive.with_decade)
    )


def obs_per_decade(raw: DataFrame) -> DataFrame:
    return (
        raw.groupBy("decade").agg(_n().alias("raw_obs")).orderBy(F.col("decade").desc_nulls_first())
    )


def obs_per_species_decade(raw: DataFrame) -> DataFrame:
    return (
        raw.filter(filters.native_or_unknown())
        .groupBy(F.col(C.SPECIES).alias("species"), C.STATUS, "decade")
        .agg(_n().alias("raw_obs"))
        .orderBy(*_asc("species", C.STATUS), F.col("decade").desc_nulls_first())
    )


def dated_native(raw: DataFrame) -> DataFrame:
    return raw.filter(filters.accepted_native()).select(C.OBS_ID, C.NOSPACE, "decade")


# --- Effect of filter choices ---


def filter_test_data(occ: DataFrame, limit: int | None = None) -> DataFrame:
    spec = RunSpec("filter_test", introduced="native_or_unknown", select="validation", limit=limit)
    return spec.limited(occ.filter(spec.predicate())).select(*spec.columns())


def null_rates_obs(data: DataFrame) -> DataFrame:
    """Rows with an unknown value, and their share of all rows, in one pass."""
    totals = data.agg(
        _n().alias("total"),
        F.count(F.when(F.col("is_introduced").isNull(), 1)).alias("introduced"),
        F.count(F.when(F.col("event_date").isNull(), 1)).alias("date"),
    )
    return _null_rates(totals, "total_obs", "rows", "perc_obs")


def null_rates_species(data: DataFrame) -> DataFrame:
    """As :func:`null_rates_obs`, for the species that have such rows."""
    per_species = (
        data.filter(filters.has_species())
        .groupBy(C.SPECIES)
        .agg(
            F.max(F.col("is_introduced").isNull().cast("int")).alias("introduced"),
            F.max(F.col("event_date").isNull().cast("int")).alias("date"),
        )
    )
    totals = per_species.agg(
        _n().alias("total"),
        F.coalesce(F.sum("introduced"), F.lit(0)).alias("introduced"),
        F.coalesce(F.sum("date"), F.lit(0)).alias("date"),
    )
    return _null_rates(totals, "total_spp", "species", "perc_spp")


def _null_rates(totals: DataFrame, total_label: str, count: str, percent: str) -> DataFrame:
    labels = {total_label: "total", "is_introduced_null": "introduced", "event_date_null": "date"}
    rows = [
        F.struct(
            F.lit(label).alias("test"),
            F.col(c).cast("bigint").alias(count),
            derive.percent_of(F.col(c), F.col("total")).alias(percent),
        )
        for label, c in labels.items()
    ]
    return totals.select(F.inline(F.array(*rows)))


def null_introduced_by_country(data: DataFrame) -> DataFrame:
    return (
        data.filter(F.col("is_introduced").isNull())
        .groupBy("country")
        .agg(_n().alias("obs"))
        .orderBy(*_asc("country"))
    )


def undated_plots(data: DataFrame) -> DataFrame:
    return (
        data.filter(F.col("event_date").isNull() & (F.col("observation_type") == "plot"))
        .groupBy("datasource", "dataset")
        .agg(_n().alias("count"))
    )


def undated_by_type(data: DataFrame, sample_size: int | None = None) -> DataFrame:
    """Undated rows per type, and their percentage of ``sample_size``, or else of all of ``data``."""
    whole = data.count() if sample_size is None else sample_size
    return (
        data.filter(F.col("event_date").isNull())
        .groupBy("observation_type")
        .agg(_n().alias("rows"))
        .withColumn("prop_rows", derive.percent_of(F.col("rows"), F.lit(whole), "decimal(20,1)"))
    )


def peek_undated(data: DataFrame, rows: int = 12) -> DataFrame:
    """A few undated rows to look at, lowest ids first."""
    return (
        data.filter(F.col("event_date").isNull())
        .orderBy(*_asc(C.OBS_ID))
        .limit(rows)
        .select(
            "observation_type",
            "datasource",
            "dataset",
            "scrubbed_family",
            C.SPECIES,
            "country",
            "is_introduced",
            "event_date_verbatim",
            "date_collected_verbatim",
        )
    )


# --- Run overlap ---


def overlap(species: DataFrame, previous: DataFrame) -> DataFrame:
    """Counts around the removal of shared species; none may be left afterwards.

    ``species`` holds species rows with ``obs``.
    """
    flagged = status_ops.flag_shared(species, previous)
    left = flagged.filter(F.col("is_in_run1") == 0).drop("is_in_run1")
    return stats_ops.overlap_rows(flagged, status_ops.flag_shared(left, previous))


# --- Species that were not modelled ---

PROFILE_COLUMNS = ("is_introduced", "taxonomic_status", "native_status")


def species_status_profile(occ: DataFrame, modelled: DataFrame) -> DataFrame:
    """All species passing the main filter, their status sets, and if they were modelled."""
    observations = (
        occ.filter(filters.quality_filter())
        .select(C.SPECIES, F.col("scrubbed_taxonomic_status").alias(C.STATUS), "native_status", "is_introduced")
    )
    return status_ops.native_status_table(observations, PROFILE_COLUMNS).transform(
        status_ops.flag_modelled, modelled
    )


def _totals(species: DataFrame, *keys: str) -> DataFrame:
    return (
        species.groupBy(*keys)
        .agg(F.sum("obs").alias("obs"), _n().alias("species"))
        .orderBy(*_asc(*keys))
    )


def by_native_status(species: DataFrame) -> DataFrame:
    return _totals(species, "is_sdm_species", "is_introduced", "native_status")


def unmodelled_by_taxonomic_status(species: DataFrame) -> DataFrame:
    return _totals(species.filter("is_sdm_species = 0"), C.STATUS)


def unmodelled_by_checklist(species: DataFrame, checklist: DataFrame) -> DataFrame:
    listed = status_ops.flag_listed(species.filter("is_sdm_species = 0"), checklist)
    return _totals(listed, "is_in_nsr", "native_status")


def countries_in_no_checklist(occ: DataFrame) -> DataFrame:
    """Observations and species per country whose status is unknown there."""
    per_species = (
        occ.filter(filters.known_country_unknown_status())
        .groupBy("country", C.SPECIES)
        .agg(_n().alias("n"))
    )
    return (
        per_species.groupBy("country")
        .agg(F.sum("n").alias("obs"), F.count(C.SPECIES).alias("species"))
        .orderBy(*_asc("country"))
    )


# --- Names with several rows in a species table ---


def repeated_species(species: DataFrame) -> DataFrame:
    return species.groupBy(C.SPECIES).agg(_n().alias("n")).filter("n > 1").select(C.SPECIES)


def multistatus_audit(occ: DataFrame, species: DataFrame, stage: Stage) -> tuple[DataFrame, DataFrame]:
    """Taxa, in the occurrences, of the names that repeat in ``species``.

    Returns those at species rank, and all taxa of the names that conflict even there.
    """
    names = stage.table(repeated_species(species), "repeated_species")
    taxa = stage.table(taxonomy.distinct_taxa(occ, names), "taxa")
    return taxonomy.species_rank_taxa(taxa), taxonomy.conflicting_taxa(taxa)


# --- Spot checks of place and name ---

Names = Sequence[str] | DataFrame


def with_names(df: DataFrame, names: Names, column: str = C.SPECIES) -> DataFrame:
    """Rows whose ``column`` is in a short list, or in the first column of a table."""
    if isinstance(names, DataFrame):
        lookup = names.select(F.col(names.columns[0]).alias(column))
        return df.join(lookup, column, "left_semi").select(*df.columns)
    return df.filter(F.col(column).isin(list(names)))


def _with_occurrence(raw: DataFrame, occ: DataFrame, *occ_columns: str) -> DataFrame:
    """Raw rows with columns of their occurrence, prefixed ``occ_``.

    An occurrence has the species of its raw row: whoever selects names or prefixes in
    ``raw`` does so in ``occ`` as well, and the rest of it is never shuffled.
    """
    source = occ.select(C.OBS_ID, *[F.col(c).alias(f"occ_{c}") for c in occ_columns])
    return raw.join(source, C.OBS_ID, "inner")


def species_counts(raw: DataFrame, names: Names) -> DataFrame:
    counts = raw.groupBy(F.col(C.SPECIES).alias("species")).agg(_n().alias("observations"))
    return with_names(counts, names, "species").orderBy(*_asc("species"))


def species_in_country(raw: DataFrame, occ: DataFrame, names: Names, country: str) -> DataFrame:
    listed = with_names(raw.select(C.OBS_ID, C.SPECIES, "latitude", "longitude"), names)
    located = with_names(occ.filter(F.col("country") == country).select(C.OBS_ID, C.SPECIES), names)
    return _with_occurrence(listed, located).select(
        C.OBS_ID, F.col(C.SPECIES).alias("species"), "latitude", "longitude"
    )


def _prefixed_in_continent(
    raw: DataFrame, occ: DataFrame, prefixes: Sequence[str], continent: str, *occ_columns: str
) -> DataFrame:
    listed = raw.filter(filters.any_prefix(F.col(C.SPECIES), prefixes)).select(
        C.OBS_ID, F.col(C.SPECIES).alias("species"), "latitude", "longitude"
    )
    located = occ.filter((F.col("continent") == continent) & filters.any_prefix(F.col(C.SPECIES), prefixes))
    return _with_occurrence(listed, located, *occ_columns)


def prefixed_in_continent(
    raw: DataFrame, occ: DataFrame, prefixes: Sequence[str], continent: str
) -> DataFrame:
    """Points of the prefixed species in a continent, with their quality flags."""
    return _prefixed_in_continent(
        raw, occ, prefixes, continent,
        "country", "is_geovalid", "is_cultivated_observation", "is_introduced",
    ).select(
        C.OBS_ID,
        "species",
        F.col("occ_country").alias("country"),
        "latitude",
        "longitude",
        F.col("occ_is_geovalid").alias("is_geovalid"),
        F.col("occ_is_cultivated_observation").alias("is_cult"),
        F.col("occ_is_introduced").alias("is_introduced"),
    )


def prefixed_localities(
    raw: DataFrame, occ: DataFrame, prefixes: Sequence[str], continent: str
) -> DataFrame:
    return _prefixed_in_continent(raw, occ, prefixes, continent, "country", "locality").select(
        C.OBS_ID,
        "species",
        F.col("occ_country").alias("country"),
        F.col("occ_locality").alias("locality"),
    )


def genera_in_country(occ: DataFrame, genera: Sequence[str], country: str) -> DataFrame:
    return occ.filter(
        (F.col("country") == country) & F.col("scrubbed_genus").isin(list(genera))
    ).select(
        "country",
        F.col(C.SPECIES).alias("species"),
        "latitude",
        "longitude",
        "is_geovalid",
        "is_centroid",
        F.col("is_cultivated_observation").alias("is_cult"),
        "is_introduced",
        F.substring("locality", 1, 50).alias("locality_description"),
    )


def genera_in_raw(
    raw: DataFrame, occ: DataFrame, genera: Sequence[str], country: str
) -> DataFrame:
    rows = occ.filter(
        (F.col("country") == country) & F.col("scrubbed_genus").isin(list(genera))
    )
    return rows.join(raw.select(C.OBS_ID), C.OBS_ID, "inner").select(
        "country",
        F.col(C.SPECIES).alias("species"),
        "is_geovalid",
        "is_centroid",
        F.col("is_cultivated_observation").alias("is_cult"),
        "is_introduced",
    )


def in_countries(occ: DataFrame, country: DataFrame, where: Column) -> DataFrame:
    """Occurrences in the countries that satisfy ``where``."""
    chosen = country.filter(where).select("country")
    return occ.join(chosen, "country", "inner").select(*occ.columns)


def species_in_territories(
    occ: DataFrame, country: DataFrame, names: Names, where: Column
) -> DataFrame:
    found = in_countries(with_names(occ.select(C.SPECIES, "country"), names), country, where)
    return found.select(F.col(C.SPECIES).alias("species")).distinct()


def rows_in_territories(
    occ: DataFrame, country: DataFrame, names: Names, where: Column
) -> DataFrame:
    rows = occ.select(
        C.OBS_ID, C.SPECIES, "country", "is_geovalid", "is_cultivated_observation", "is_introduced"
    )
    return in_countries(with_names(rows, names), country, where).select(
        C.OBS_ID,
        F.col(C.SPECIES).alias("species"),
        "country",
        "is_geovalid",
        F.col("is_cultivated_observation").alias("is_cult"),
        "is_introduced",
    )


def raw_species_by_country(
    raw: DataFrame,
    occ: DataFrame,
    country: DataFrame,
    names: Names,
    where: Column | None = None,
) -> DataFrame:
    """Points of listed species per country, within the countries ``where`` selects."""
    listed = with_names(occ.select(C.OBS_ID, C.SPECIES, "country"), names)
    located = in_countries(listed, country, F.lit(True) if where is None else where)
    return (
        located.join(with_names(raw.select(C.OBS_ID, C.SPECIES), names).select(C.OBS_ID), C.OBS_ID, "inner")
        .groupBy(F.col(C.SPECIES).alias("species"), "country")
        .agg(_n().alias("observations"))
        .orderBy(*_asc("species", "country"))
    )


def prefixed_in_country_table(
    table: DataFrame, prefixes: Sequence[str], country: str
) -> DataFrame:
    """Species of a country-level table, by name prefix and country."""
    return table.filter(
        (F.col("country") == country) & filters.any_prefix(F.col("species"), prefixes)
    ).orderBy(*_asc("species"))
