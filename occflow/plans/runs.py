"""Whole jobs: extract, clean, describe and export a run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occflow import constants as C
from occflow.functions import derive, filters
from occflow.operators import species as species_ops
from occflow.operators import stats as stats_ops
from occflow.operators import status as status_ops
from occflow.operators import taxonomy
from occflow.operators.limits import lowest
from occflow.operators.lookups import alike, drop_species, first_per_key, flag_matches, has_duplicates, update_from
from occflow.sources import run_tables, sinks
from occflow.sources.readers import read_species_list
from occflow.sources.staging import Stage
from occflow.spec import RunSpec


@dataclass(frozen=True)
class Run:
    """The tables of a run: observations, species, statistics, native status.

    ``profile`` is the species profile before conflicting names are removed, from which
    a main run can be extended.
    """

    rmd: DataFrame
    rms: DataFrame
    stats: DataFrame
    native_status: DataFrame | None = None
    profile: DataFrame | None = None


def extract(occ: DataFrame, spec: RunSpec) -> DataFrame:
    """Observations that pass the run's filters, with the derived columns."""
    selected = spec.limited(occ.filter(spec.predicate())).select(*spec.columns())
    return selected.transform(derive.with_run_columns)


def resolve_multistatus(observations: DataFrame, stage: Stage) -> DataFrame:
    """Remove observations of conflicting names.

    The list of names is staged, so that its size is known when the plan for the
    observations is made: normally they are not shuffled at all.
    """
    names = taxonomy.dropped_names(taxonomy.species_profile(observations))
    return taxonomy.drop_names(observations, stage.table(names, "dropped_names"))


def native_status(occ: DataFrame, spec: RunSpec) -> DataFrame:
    """Native-status sets of all species that pass the main filter."""
    observations = spec.limited(occ.filter(spec.main_predicate()))
    return status_ops.native_status_table(observations)


def species_rows(occ: DataFrame, growth_forms: DataFrame, spec: RunSpec) -> DataFrame:
    """Species table of a run, with ``obs``, without storing its observations."""
    kept = taxonomy.mark_dropped(taxonomy.species_profile(extract(occ, spec))).filter("not is_dropped")
    return species_ops.species_table(kept.drop("is_dropped"), growth_forms)


def main_run(occ: DataFrame, growth_forms: DataFrame, spec: RunSpec, stage: Stage) -> Run:
    """Extract, resolve conflicting names, build the species table and statistics.

    Occurrences are scanned once. After that only the last removal reads
    observations again; the rest comes from the staged species profile.
    """
    observations = stage.table(extract(occ, spec), "observations")
    profile = stage.table(taxonomy.species_profile(observations), "profile")
    names = stage.table(taxonomy.dropped_names(profile), "dropped_names")
    return _described(observations, profile, names, growth_forms)


def _described(observations: DataFrame, profile: DataFrame, names: DataFrame, growth_forms: DataFrame) -> Run:
    kept = taxonomy.drop_names(profile, names)
    return Run(
        rmd=taxonomy.drop_names(observations, names),
        rms=species_ops.species_table(kept, growth_forms).drop("obs"),
        stats=stats_ops.main_stats(profile),
        profile=profile,
    )


def extend_run(run: Run, batch: DataFrame, growth_forms: DataFrame, spec: RunSpec, stage: Stage) -> Run:
    """A main run as if ``batch`` had been among its occurrences; only the batch is scanned for its profile.

    Profiles add up, and a name that conflicts in a run conflicts in any larger one, so
    that removed observations never come back. Observations of the run are read once
    more, to remove the names that conflict only now.
    """
    if spec.limit is not None:
        raise ValueError("a run with a limit can't be extended")
    if run.profile is None:
        raise ValueError("the run has no profile")
    added = stage.table(extract(batch, spec), "observations")
    profile = stage.table(taxonomy.merge_profiles(run.profile, taxonomy.species_profile(added)), "profile")
    names = stage.table(taxonomy.dropped_names(profile), "dropped_names")
    return _described(run.rmd.unionByName(added), profile, names, growth_forms)


def supplemental_species(
    rows: DataFrame, previous: DataFrame, native_status_table: DataFrame
) -> DataFrame:
    """Flag species rows of an earlier run and those that a checklist has."""
    return rows.transform(status_ops.flag_shared, previous).transform(
        status_ops.flag_not_unlisted, native_status_table
    )


def without_shared(
    occ: DataFrame, growth_forms: DataFrame, previous: DataFrame, spec: RunSpec, stage: Stage
) -> tuple[DataFrame, DataFrame]:
    """Observations and species of a run, less the species of an earlier run."""
    observations = stage.table(extract(occ, spec), "observations")
    flagged = status_ops.flag_shared(species_rows(occ, growth_forms, spec), previous)
    return (
        drop_species(resolve_multistatus(observations, stage), previous),
        flagged.filter("is_in_run1 = 0").select(*species_ops.COLUMNS),
    )


def remaining(species: DataFrame) -> DataFrame:
    return species.filter((F.col("is_in_run1") == 0) & (F.col("is_in_nsr") == 0))


@dataclass(frozen=True)
class Scan:
    """What a supplemental run takes from the occurrences.

    ``combinations`` counts what passes the filter but for native status, of ``spec``'s quality;
    None where the scan had to be narrower.
    """

    spec: RunSpec
    observations: DataFrame
    profile: DataFrame
    statuses: DataFrame
    combinations: DataFrame | None = None


def scan(occ: DataFrame, spec: RunSpec, stage: Stage) -> Scan:
    """Observations of the run, their profile, and native status of all species passing the main filter.

    All come from one scan of the occurrences, and the last two from one count of
    combinations, when the extract has the columns for it: the presets of native
    status depend on two of them only. A limit applies to each on its own, so it
    needs two scans.
    """
    shared = spec.limit is None and spec.select == "standard" and spec.introduced in filters.INTRODUCED
    if not shared:
        observations = stage.table(extract(occ, spec), "observations")
        profile = stage.table(taxonomy.species_profile(observations), "profile")
        return Scan(spec, observations, profile, native_status(occ, spec))
    passing = stage.table(extract(occ, replace(spec, introduced="any")), "observations")
    own = filters.predicate(spec.introduced, filters.INTRODUCED)
    counted = taxonomy.species_profile(passing, ["is_introduced", "native_status"])
    counted = stage.table(counted, "combinations")
    profile = taxonomy.narrow_profile(counted.filter(own))
    return Scan(spec, passing.filter(own), profile, status_ops.status_sets(counted), counted)


def species_rows_from(scanned: Scan, growth_forms: DataFrame, spec: RunSpec) -> DataFrame:
    """``species_rows`` of another run over the same occurrences, from the counts of a scan of the same quality."""
    shared = spec.quality == scanned.spec.quality and spec.limit is None and spec.introduced in filters.INTRODUCED
    if scanned.combinations is None or not shared:
        raise ValueError("the scan has not counted what the run needs")
    profile = taxonomy.narrow_profile(scanned.combinations.filter(filters.predicate(spec.introduced, filters.INTRODUCED)))
    kept = taxonomy.mark_dropped(profile).filter("not is_dropped")
    return species_ops.species_table(kept.drop("is_dropped"), growth_forms)


def supplemental_run(
    occ: DataFrame,
    growth_forms: DataFrame,
    previous: DataFrame,
    spec: RunSpec,
    stage: Stage,
    scanned: Scan | None = None,
) -> Run:
    """A main run, less the species of an earlier run and those of any checklist.

    ``scanned`` is the scan of the occurrences for ``spec``, if it was made before.
    """
    scanned = scanned or scan(occ, spec, stage)
    observations, profile, statuses = scanned.observations, scanned.profile, scanned.statuses
    names = stage.table(taxonomy.dropped_names(profile), "dropped_names")
    kept = taxonomy.drop_names(profile, names)

    statuses = stage.table(statuses, "native_status")
    rows = species_ops.species_table(kept, growth_forms)
    flagged = stage.table(supplemental_species(rows, previous, statuses), "species")
    final = remaining(flagged)
    gone = stage.table(
        flagged.filter((F.col("is_in_run1") == 1) | (F.col("is_in_nsr") == 1))
        .select(C.SPECIES)
        .distinct(),
        "dropped_species",
    )
    return Run(
        rmd=drop_species(taxonomy.drop_names(observations, names), gone),
        rms=final.select(*species_ops.COLUMNS),
        stats=stats_ops.append_stats(
            stats_ops.main_stats(profile), stats_ops.supplemental_rows(flagged)
        ),
        native_status=status_ops.flag_modelled(statuses, previous),
    )


def run(
    occ: DataFrame,
    growth_forms: DataFrame,
    spec: RunSpec,
    stage: Stage,
    previous: DataFrame | None = None,
) -> Run:
    if not spec.missing_spp_run:
        return main_run(occ, growth_forms, spec, stage)
    if previous is None:
        raise ValueError(f"a supplemental run needs table {spec.prev_rms_table}")
    return supplemental_run(occ, growth_forms, previous, spec, stage)


def save_run(result: Run, base: str, spec: RunSpec) -> Run:
    """Store the run's tables and return them as stored."""
    native = result.native_status
    return replace(
        result,
        rmd=run_tables.save(result.rmd, base, spec.rmd_table, sinks.OBSERVATIONS),
        rms=sinks.save_run_table(result.rms, base, spec.rms_table),
        stats=sinks.save_run_table(result.stats, base, spec.stats_table),
        native_status=None
        if native is None
        else sinks.save_run_table(native, base, "species_native_status"),
        profile=None
        if result.profile is None
        else sinks.save_run_table(result.profile, base, spec.profile_table),
    )


def stored_run(spark: SparkSession, base: str, spec: RunSpec) -> Run | None:
    """The run's tables, if all of them are stored."""
    names = [spec.rmd_table, spec.rms_table, spec.stats_table]
    names += ["species_native_status"] if spec.missing_spp_run else []
    if not all(run_tables.exists(spark, base, n) for n in names):
        return None
    made = Run(*[_table(spark, base, n) for n in names])
    if run_tables.exists(spark, base, spec.profile_table):
        made = replace(made, profile=_table(spark, base, spec.profile_table))
    return made


def _table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return run_tables.read(spark, f"{base}/{name}") if "/" in base else spark.table(f"`{base}`.`{name}`")


def _stored(base: str, name: str, build: Callable[[], DataFrame], spark: SparkSession, resume: bool) -> DataFrame:
    """The table as stored; on ``resume`` not made again if it is there."""
    if resume and run_tables.exists(spark, base, name):
        return _table(spark, base, name)
    return sinks.save_run_table(build(), base, name)


def append_run_stats(rows: DataFrame, base: str, spec: RunSpec) -> DataFrame:
    """Add rows to the stored statistics of a run, in one step; those of the same id and label are replaced."""
    spark = rows.sparkSession
    if run_tables.exists(spark, base, spec.stats_table):
        rows = stats_ops.append_stats(_table(spark, base, spec.stats_table), rows)
    return sinks.save_run_table(rows, base, spec.stats_table)


def clear_run_stats(spark: SparkSession, text: str, base: str, spec: RunSpec) -> DataFrame:
    """Remove the stored rows whose label contains ``text``, in one step."""
    kept = stats_ops.clear_stats(_table(spark, base, spec.stats_table), text)
    return sinks.save_run_table(kept, base, spec.stats_table)


def export_run(result: Run, out_dir: str, spec: RunSpec, resume: bool = False) -> None:
    """Write the species list, the points of each species and the attributes."""
    if not spec.save:
        return
    folder = f"{out_dir}/{spec.data_dir}"
    if not resume:
        sinks.guard_output(result.rmd.sparkSession, folder)
    sinks.export_species_list(result.rmd, f"{folder}/range_model_species", resume=resume)
    sinks.export_by_species(result.rmd, f"{folder}/species", resume=resume)
    sinks.export_csv(sinks.species_attributes(result.rms), f"{folder}/{spec.attributes_file}", resume=resume)


def _prepare(spark: SparkSession, base: str, folder: str | None, resume: bool = False) -> None:
    """Before any work: refuse an output folder that is there, make the schema that ``base`` names."""
    if folder and not resume:
        sinks.guard_output(spark, folder)
    if "/" not in base:
        sinks.ensure_schema(spark, base)


def run_and_export(
    occ: DataFrame,
    growth_forms: DataFrame,
    spec: RunSpec,
    base: str,
    out_dir: str,
    previous: DataFrame | None = None,
    resume: bool = False,
) -> Run:
    """The complete job. Checks the output first and clears what it staged.

    ``resume`` takes up a job of this run that failed: tables that are all stored are
    used as they are, and only what the export lacks is written.
    """
    spark = occ.sparkSession
    _prepare(spark, base, f"{out_dir}/{spec.data_dir}" if spec.save else None, resume)
    stored = stored_run(spark, base, spec) if resume else None
    if stored is None:
        stage = Stage(spark)
        try:
            stored = save_run(run(occ, growth_forms, spec, stage, previous), base, spec)
        finally:
            stage.clear()
    export_run(stored, out_dir, spec, resume)
    return stored


def unfiltered_spec(run_code: str = "unfiltered", limit: int | None = None) -> RunSpec:
    return RunSpec(run_code, quality="none", introduced="any", select="unfiltered", limit=limit)


def unfiltered_run(occ: DataFrame, run_code: str = "unfiltered", limit: int | None = None) -> DataFrame:
    """Every observation with the wide selection and the derived columns."""
    return extract(occ, unfiltered_spec(run_code, limit))


def run_unfiltered(
    occ: DataFrame, base: str, out_dir: str, run_code: str = "unfiltered", limit: int | None = None, resume: bool = False
) -> DataFrame:
    """The complete unfiltered job: checks the output, stores the table, exports the stored one."""
    spark, spec = occ.sparkSession, unfiltered_spec(run_code, limit)
    folder = f"{out_dir}/{spec.data_dir}"
    _prepare(spark, base, folder, resume)
    stored = _stored(base, spec.rmd_table, lambda: extract(occ, spec), spark, resume)
    export_unfiltered(stored, folder, resume)
    return stored


def export_unfiltered(observations: DataFrame, path: str, resume: bool = False) -> None:
    sinks.export_species_list(observations, f"{path}/range_model_species", resume=resume)
    sinks.export_by_species(observations, f"{path}/species", columns=["*"], resume=resume)


def legacy_run(
    occ: DataFrame, growth_forms: DataFrame, spec: RunSpec
) -> tuple[DataFrame, DataFrame]:
    """Earlier one-filter run: no removal of conflicting names and no statistics."""
    observations = extract(occ, spec)
    return observations, species_ops.species_table_by_group(observations, growth_forms)


def export_legacy(observations: DataFrame, species: DataFrame, path: str, resume: bool = False) -> None:
    sinks.export_species_list(observations, f"{path}/species_list", resume=resume)
    sinks.export_by_species(observations, f"{path}/species", header=False, resume=resume)
    sinks.export_csv(sinks.species_attributes(species), f"{path}/species_attributes.csv", resume=resume)


def run_legacy(
    occ: DataFrame, growth_forms: DataFrame, spec: RunSpec, base: str, out_dir: str, resume: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The complete one-filter job; the species table comes from the stored observations."""
    spark, folder = occ.sparkSession, f"{out_dir}/{spec.data_dir}"
    _prepare(spark, base, folder if spec.save else None, resume)
    observations = _stored(base, spec.rmd_table, lambda: extract(occ, spec), spark, resume)
    species = _stored(
        base, spec.rms_table, lambda: species_ops.species_table_by_group(observations, growth_forms), spark, resume
    )
    if spec.save:
        export_legacy(observations, species, folder, resume)
    return observations, species


def import_species(species_list: DataFrame, occ: DataFrame) -> DataFrame:
    """Look up status and plant group of imported names in the occurrences.

    A name with several combinations gets the first, ascending with nulls last.
    """
    species = derive.with_species_from_underscore(species_list)
    names = species.select(F.col("species").alias(C.SPECIES))
    # Reduced first, so that occurrences never move row by row for the list.
    attributes = first_per_key(occ, C.SPECIES, ["scrubbed_taxonomic_status", C.GROUP]).join(
        names, C.SPECIES, "left_semi"
    )
    return update_from(
        species,
        attributes,
        "species",
        C.SPECIES,
        {C.STATUS: "scrubbed_taxonomic_status", "higher_taxon": C.GROUP},
        unique=True,
    )


def import_and_export(
    spark: SparkSession,
    list_path: str,
    occ: DataFrame,
    out_path: str,
    names_path: str | None = None,
) -> None:
    """Import a species list and write it with its attributes, and if asked its names."""
    species = read_species_list(spark, list_path)
    if names_path:
        names = derive.with_species_from_underscore(species).select("species")
        ordered = names.orderBy(F.col("species").asc_nulls_last())
        sinks.export_csv(ordered, names_path, header=False)
    sinks.export_csv(import_species(species, occ), out_path)


@dataclass(frozen=True)
class FlaggedRun:
    observations: DataFrame
    metadata: DataFrame


def flagging_run(
    raw: DataFrame, metadata: DataFrame, occ: DataFrame, run_code: str, stage: Stage
) -> FlaggedRun:
    """Earlier flagging run over an existing raw table.

    Attributes come from the metadata, native status from the occurrences by id.
    A raw row without an occurrence counts as introduced. No row of ``raw`` multiplies.
    """
    ob_flag = f"is_range_model_ob_{run_code}"
    reset = [C.STATUS, C.GROUP, C.IS_VASC, "native_status", "is_introduced", ob_flag]
    cleared = (
        raw.drop(*reset)
        .withColumn("native_status", F.lit(None).cast("string"))
        .withColumn("is_introduced", F.lit(1))
    )
    # By id first: rows move without the attributes then.
    with_status = update_native_status(cleared, occ, stage)
    described = update_attributes(with_status, metadata, stage).transform(derive.with_is_vasc)
    flagged = described.withColumn(ob_flag, F.when(filters.accepted_native(), 1).otherwise(0))
    return FlaggedRun(flagged, flag_metadata(metadata, flagged, run_code))


def flag_metadata(metadata: DataFrame, flagged: DataFrame, run_code: str) -> DataFrame:
    """The metadata with derived columns, and whether a species has flagged observations."""
    flag = f"is_range_model_species_{run_code}"
    described = (
        metadata.drop(C.IS_VASC, C.NOSPACE, flag)
        .transform(derive.with_species_nospace)
        .transform(derive.with_is_vasc)
    )
    used = flagged.filter(F.col(f"is_range_model_ob_{run_code}") == 1).select(C.SPECIES)
    return flag_matches(described, used, C.SPECIES, C.SPECIES, flag)


def run_flagging(
    raw: DataFrame, metadata: DataFrame, occ: DataFrame, run_code: str, base: str, out_dir: str, resume: bool = False
) -> FlaggedRun:
    """The complete flagging job: checks the output, stores both tables, exports the stored ones.

    The tables have names of their own, as ``raw`` and ``metadata`` are read while these are written.
    """
    spark = raw.sparkSession
    folder = f"{out_dir}/rm_data_{run_code}"
    _prepare(spark, base, folder, resume)
    stage = Stage(spark)
    try:
        observations = _stored(
            base,
            f"range_model_data_flagged_{run_code}",
            lambda: flagging_run(raw, metadata, occ, run_code, stage).observations,
            spark,
            resume,
        )
    finally:
        stage.clear()
    described = _stored(
        base,
        f"range_model_metadata_flagged_{run_code}",
        lambda: flag_metadata(metadata, observations, run_code),
        spark,
        resume,
    )
    stored = FlaggedRun(observations, described)
    export_flagged(stored, run_code, folder, resume)
    return stored


def update_attributes(raw: DataFrame, metadata: DataFrame, stage: Stage) -> DataFrame:
    """Fill taxonomic status and plant group by species from the metadata.

    The lookup is reduced to one row per species and staged before it meets the
    observations, as :func:`update_from` asks for targets with hot keys.
    """
    values = [C.STATUS, C.GROUP]
    attributes = stage.table(first_per_key(metadata, C.SPECIES, values), "attributes")
    return update_from(
        raw, attributes, C.SPECIES, C.SPECIES, {v: v for v in values}, unique=True
    )


def update_native_status(raw: DataFrame, occ: DataFrame, stage: Stage) -> DataFrame:
    """Fill native status by id from the occurrences of the species in ``raw``.

    Of several occurrences of one id the first counts, ascending with nulls last.
    """
    source = alike(occ.select(C.OBS_ID, C.SPECIES, "native_status", "is_introduced"), raw, stage)
    return update_from(
        raw,
        source,
        C.OBS_ID,
        C.OBS_ID,
        {"native_status": "native_status", "is_introduced": "is_introduced"},
    )


def export_flagged(result: FlaggedRun, run_code: str, path: str, resume: bool = False) -> None:
    used = result.observations.filter(F.col(f"is_range_model_ob_{run_code}") == 1)
    sinks.export_species_list(
        result.observations, f"{path}/species_list_all", column=C.SPECIES, resume=resume
    )
    sinks.export_species_list(used, f"{path}/species_list_{run_code}", column=C.SPECIES, resume=resume)
    sinks.export_by_species(used, f"{path}/species", header=False, resume=resume)
    sinks.export_csv(
        sinks.metadata_attributes(result.metadata, f"is_range_model_species_{run_code}"),
        f"{path}/species_attributes.csv",
        resume=resume,
    )


def export_introduced(
    all_species: DataFrame,
    growth_forms: DataFrame,
    metadata: DataFrame,
    crosstab: DataFrame,
    base: str,
    path: str,
    name: str = "modelled_species",
) -> DataFrame:
    """Store the summary of introduced observations, and write it ordered by species."""
    _prepare(all_species.sparkSession, base, path)
    summary = species_ops.introduced_summary(all_species, growth_forms, metadata, crosstab)
    stored = sinks.save_run_table(summary, base, name)
    sinks.export_csv(stored.orderBy(F.col("species").asc_nulls_last()), path)
    return stored


def combine_and_export(
    main: DataFrame, supplemental: DataFrame, base: str, path: str, name: str
) -> tuple[DataFrame, DataFrame]:
    """Store the species of two runs together and write them ordered by name.

    Returns the stored table, and one row that says if a species occurs more than once.
    """
    _prepare(main.sparkSession, base, path)
    stored = sinks.save_run_table(species_ops.combine(main, supplemental), base, name)
    sinks.export_csv(stored.orderBy(F.col(C.NOSPACE).asc_nulls_last()), path)
    return stored, has_duplicates(stored, [C.SPECIES], "has_non_unique_species")


def sample_tables(
    raw: DataFrame, metadata: DataFrame, rows: int = 100
) -> tuple[DataFrame, DataFrame]:
    """A small sample of raw, lowest ids first, and the metadata of its species."""
    sample = lowest(raw, C.OBS_ID, rows)
    matching = (
        metadata.join(sample.select(C.SPECIES), C.SPECIES, "left_semi")
        .select(*metadata.columns)
        .distinct()
    )
    return sample, matching
