"""Registered queries: every operator and job over the test tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from occflow import constants as C
from occflow.functions import derive, filters
from occflow.operators import limits, lookups, stats, status, taxonomy
from occflow.operators import species as species_ops
from occflow.plans import checks, runs
from occflow.sources import readers, sinks, species_export
from occflow.sources.staging import Stage, hadoop_path
from occflow.spec import RunSpec
from verification import fixtures

MAIN = RunSpec("main")
ANY = RunSpec("any", introduced="any")
LEGACY = RunSpec("legacy", introduced="native_or_unknown")
SUPPLEMENTAL = RunSpec(
    "extra", introduced="unknown_status", missing_spp_run=True, prev_run=MAIN.run
)
FLAG_RUN = "202209"
PREFIXES = ["hot", "blue"]
COUNTRY = "NATION_3"
CONTINENT = "EUROPE"


_roots: dict[str, str] = {}


def own_root(spark: SparkSession) -> str | None:
    """A temporary folder, removed at exit, for a local session without a checkpoint folder."""
    if spark.conf.get("spark.checkpoint.dir", None) or not spark.sparkContext.master.startswith("local["):
        return None
    application = spark.sparkContext.applicationId
    if application not in _roots:
        _roots[application] = tempfile.mkdtemp(prefix="occflow-")
        atexit.register(shutil.rmtree, _roots[application], ignore_errors=True)
    return _roots[application]


class Inputs:
    """Input views, and run tables made from them when a query asks for them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def lookup(self, name: str) -> DataFrame:
        return fixtures.lookup(self.spark, self.sf_dir, name)

    @cached_property
    def stage(self) -> Stage:
        return Stage(self.spark, own_root(self.spark))

    @cached_property
    def occ(self) -> DataFrame:
        return fixtures.occurrences(self.spark, self.sf_dir)

    @property
    def growth_forms(self) -> DataFrame:
        return self.lookup("species_growth_forms")

    @property
    def listed(self) -> DataFrame:
        return self.growth_forms.filter("gf_conf_flag = 'low'").select("species")

    @cached_property
    def main(self) -> runs.Run:
        return runs.main_run(self.occ, self.growth_forms, MAIN, self.stage)

    @cached_property
    def raw(self) -> DataFrame:
        return self.main.rmd

    @cached_property
    def profile(self) -> DataFrame:
        """Species profile of the main run, when its observations are not needed."""
        return taxonomy.species_profile(runs.extract(self.occ, MAIN))

    def species_rows(self, spec: RunSpec) -> DataFrame:
        return runs.species_rows(self.occ, self.growth_forms, spec)

    @cached_property
    def scan(self) -> runs.Scan:
        return runs.scan(self.occ, SUPPLEMENTAL, self.stage)

    @cached_property
    def rms(self) -> DataFrame:
        """Species of the main run; once a supplemental run has scanned the occurrences, from what it counted."""
        scanned = self.__dict__.get("scan")
        rows = runs.species_rows_from(scanned, self.growth_forms, MAIN) if scanned else self.species_rows(MAIN)
        return self.stage.table(rows.drop("obs"), "rms")

    @cached_property
    def supplemental_rows(self) -> DataFrame:
        return self.species_rows(SUPPLEMENTAL)

    @cached_property
    def native_status(self) -> DataFrame:
        return status.flag_modelled(runs.native_status(self.occ, SUPPLEMENTAL), self.rms)

    @cached_property
    def flagged_rows(self) -> DataFrame:
        statuses = runs.native_status(self.occ, SUPPLEMENTAL)
        return runs.supplemental_species(self.supplemental_rows, self.rms, statuses)

    @cached_property
    def supplemental(self) -> runs.Run:
        scanned = self.scan
        return runs.supplemental_run(
            self.occ, self.growth_forms, self.rms, SUPPLEMENTAL, self.stage, scanned
        )

    @cached_property
    def flagging(self) -> runs.FlaggedRun:
        raw = self.stage.table(runs.extract(self.occ, ANY), "raw")
        return runs.flagging_run(
            raw, self.lookup("range_model_data_metadata"), self.occ, FLAG_RUN, self.stage
        )

    @cached_property
    def test_data(self) -> DataFrame:
        return checks.filter_test_data(self.occ)

    @cached_property
    def status_profile(self) -> DataFrame:
        return checks.species_status_profile(self.occ, self.rms)

    @cached_property
    def audit(self) -> tuple[DataFrame, DataFrame]:
        return checks.multistatus_audit(self.occ, self.rms, self.stage)

    @cached_property
    def after_shared(self) -> tuple[DataFrame, DataFrame]:
        return runs.without_shared(self.occ, self.growth_forms, self.rms, SUPPLEMENTAL, self.stage)

    @cached_property
    def supplemental_stored(self) -> runs.Run:
        return runs.save_run(self.supplemental, self.stage.path("run"), SUPPLEMENTAL)

    def csv_schema(self, df: DataFrame) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _filtered(spec: RunSpec) -> Callable[[Inputs], DataFrame]:
    return lambda i: i.occ.filter(spec.predicate()).select(*spec.columns())


def _count(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("obs"))


def _by_species_roundtrip(
    i: Inputs, observations: DataFrame, columns: list[str] | None = None, header: bool = True
) -> DataFrame:
    """Export one file per species and read all of them back."""
    path = i.stage.path("by_species")
    chosen = list(columns or sinks.POINT_COLUMNS)
    sinks.export_by_species(observations, path, columns=chosen, header=header)
    return _species_files(i, path, observations.selectExpr(*chosen), header, columns is not None)


def _species_files(
    i: Inputs, path: str, like: DataFrame, header: bool = True, free_text: bool = False
) -> DataFrame:
    return species_export.read_back(i.spark, path, i.csv_schema(like), header, free_text)


def _csv_roundtrip(i: Inputs, df: DataFrame, header: bool = True) -> DataFrame:
    path = i.stage.path("csv")
    sinks.export_csv(df, path, header=header)
    return readers.read_csv(i.spark, path, i.csv_schema(df), header=header)


def _underscored(df: DataFrame) -> DataFrame:
    return df.select(F.replace(F.col("species"), F.lit(" "), F.lit("_")).alias("species_ul"))


def _species_list(i: Inputs) -> DataFrame:
    path = i.stage.path("list")
    sinks.export_csv(_underscored(i.growth_forms), path, header=False)
    return readers.read_species_list(i.spark, path)


def _checklist(i: Inputs) -> DataFrame:
    path = i.stage.path("checklist")
    sinks.export_csv(i.lookup("checklist_species"), path)
    return readers.read_checklist(i.spark, path)


def _import(i: Inputs) -> DataFrame:
    absent = i.spark.createDataFrame([("absent_one",), ("absent_two",)], "species_ul string")
    path = i.stage.path("list")
    sinks.export_csv(_underscored(i.growth_forms).union(absent), path, header=False)
    out = i.stage.path("imported")
    runs.import_and_export(i.spark, path, i.occ, out)
    return readers.read_csv(
        i.spark,
        out,
        "species_ul string, species string, taxonomic_status string, higher_taxon string",
        header=True,
    )


def _saved_run(i: Inputs) -> DataFrame:
    return sinks.save_run_table(
        runs.extract(i.occ, MAIN),
        i.stage.path("saved"),
        MAIN.rmd_table,
    )


def _points(df: DataFrame) -> DataFrame:
    return df.selectExpr(*sinks.POINT_COLUMNS)


def _main_files(i: Inputs) -> DataFrame:
    out = i.stage.path("out")
    stored = _stored_main(i)
    runs.export_run(stored, out, MAIN)
    return _species_files(i, f"{out}/{MAIN.data_dir}/species", _points(stored.rmd))


def _unfiltered_files(i: Inputs) -> DataFrame:
    out = i.stage.path("out")
    stored = runs.run_unfiltered(i.occ, i.stage.path("run"), out)
    return _species_files(i, f"{out}/rm_data_unfiltered/species", stored, free_text=True)


def _flagged_files(i: Inputs) -> DataFrame:
    raw = i.stage.table(runs.extract(i.occ, ANY), "raw")
    metadata, out = i.lookup("range_model_data_metadata"), i.stage.path("out")
    stored = runs.run_flagging(raw, metadata, i.occ, FLAG_RUN, i.stage.path("run"), out)
    path = f"{out}/rm_data_{FLAG_RUN}/species"
    return _species_files(i, path, _points(stored.observations), header=False)


def _legacy_files(i: Inputs) -> DataFrame:
    out = i.stage.path("out")
    stored, _ = runs.run_legacy(i.occ, i.growth_forms, LEGACY, i.stage.path("run"), out)
    return _species_files(i, f"{out}/{LEGACY.data_dir}/species", _points(stored), header=False)


def _introduced_file(i: Inputs) -> DataFrame:
    names = ("all_species", "species_growth_forms", "range_model_data_metadata", "species_observation_counts_crosstab")
    path = i.stage.path("csv")
    stored = runs.export_introduced(*[i.lookup(n) for n in names], i.stage.path("run"), path)
    return readers.read_csv(i.spark, path, i.csv_schema(stored), header=True)


def _combined_file(i: Inputs) -> DataFrame:
    path = i.stage.path("csv")
    added = i.supplemental_stored.rms
    stored, _ = runs.combine_and_export(i.rms, added, i.stage.path("run"), path, "species_all")
    return readers.read_csv(i.spark, path, i.csv_schema(stored), header=True)


def _in_order(i: Inputs, df: DataFrame) -> DataFrame:
    """``df`` with each row's ``position`` in its files, as a reader of them finds it."""
    name, place = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    rows = i.stage.table(df, "ordered").select("*", name.alias("file"), place.alias("place"))
    files = rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    return rows.join(files, "file").select(*df.columns, (F.col("before") + F.col("place") + 1).alias("position"))


def _in_catalog(i: Inputs) -> DataFrame:
    """A table stored in a schema that is made for it, read by name."""
    sinks.ensure_schema(i.spark, "occflow_check")
    sinks.ensure_schema(i.spark, "occflow_check")
    name = f"growth_{uuid.uuid4().hex[:8]}"
    sinks.save_run_table(i.growth_forms, "occflow_check", name)
    return i.spark.table(f"occflow_check.{name}")


def _refused(i: Inputs) -> DataFrame:
    """What an export left, after a second one to the same folder was refused."""
    path = i.stage.path("guarded")
    sinks.export_species_list(i.raw, path)
    try:
        sinks.guard_output(i.spark, path)
        refused = False
    except FileExistsError:
        refused = True
    return readers.read_species_list(i.spark, path).withColumn("refused", F.lit(refused))


def _manifest(i: Inputs) -> DataFrame:
    path = i.stage.path("by_species")
    sinks.export_by_species(i.raw, path)
    listed = species_export.manifest(i.spark, path)
    return listed.groupBy(F.col("file").alias(sinks.SPECIES_DIR)).agg(F.sum("rows").alias("rows"))


def _resumed(i: Inputs) -> DataFrame:
    """An export that lost its manifest and every file of one part, taken up again."""
    path = i.stage.path("by_species")
    sinks.export_by_species(i.raw, path)
    lost = [r["place"] for r in species_export._files(i.spark, path).where("place like '%part-00001-%'").collect()]
    for place in [f"{path}/{species_export.MANIFEST}", *lost]:
        target, fs = hadoop_path(i.spark, place)
        fs.delete(target, True)
    sinks.export_by_species(i.raw, path, resume=True)
    return _species_files(i, path, _points(i.raw))


def _appended_twice(i: Inputs) -> DataFrame:
    base, spec = i.stage.path("stats"), RunSpec("s")
    rows = i.stage.table(stats.main_stats(i.profile), "stats")
    for _ in range(2):
        stored = runs.append_run_stats(rows, base, spec)
    return stored


def _extended(i: Inputs) -> runs.Run:
    """A main run of two thirds of the occurrences, stored, and extended by the rest."""
    late = F.pmod(F.xxhash64(C.OBS_ID), F.lit(3)) == 0
    base = i.stage.path("run")
    early = runs.save_run(runs.main_run(i.occ.where(~late), i.growth_forms, MAIN, i.stage), base, MAIN)
    return runs.save_run(runs.extend_run(early, i.occ.where(late), i.growth_forms, MAIN, i.stage), base, MAIN)


def _large_limit(i: Inputs) -> DataFrame:
    rows = i.occ.filter(MAIN.predicate()).select(*MAIN.columns())
    return limits.lowest(rows, C.OBS_ID, 1000, merged=0)


def _iso(*codes: str):
    return F.col("iso_alpha3").isin(list(codes))


FRENCH = ["GLP", "MTQ", "BLM", "MAF"]

QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    # Sources and sinks
    "src1_occurrences": lambda i: i.occ,
    "src2_species_list": _species_list,
    "src3_checklist": _checklist,
    "src4_checklist_extract": lambda i: readers.extract_checklist(i.lookup("distribution")),
    "snk1_run_table": _saved_run,
    "snk2_catalog": _in_catalog,
    "snk3_refused": _refused,
    "snk4_species_list": lambda i: _csv_roundtrip(i, sinks.species_list(i.raw), header=False),
    "snk4_binomial_list": lambda i: sinks.species_list(i.raw, C.SPECIES),
    "snk5_roundtrip": lambda i: _by_species_roundtrip(i, i.raw),
    "snk6_headerless": lambda i: _by_species_roundtrip(
        i, runs.extract(i.occ, LEGACY), header=False
    ),
    "snk7_all_columns": lambda i: _by_species_roundtrip(i, runs.unfiltered_run(i.occ), ["*"]),
    "snk5_manifest": _manifest,
    "snk5_resumed": _resumed,
    "snk8_attributes": lambda i: _csv_roundtrip(i, sinks.species_attributes(i.rms)),
    "snk9_metadata_attributes": lambda i: _csv_roundtrip(
        i,
        sinks.metadata_attributes(i.flagging.metadata, f"is_range_model_species_{FLAG_RUN}"),
    ),
    "snk11_dated_native": lambda i: _csv_roundtrip(
        i, checks.dated_native(checks.backfill_dates(i.raw, i.occ, i.stage))
    ),
    "snk12_append_stats": lambda i: stats.append_stats(
        stats.main_stats(taxonomy.species_profile(runs.extract(i.occ, SUPPLEMENTAL))),
        stats.supplemental_rows(i.flagged_rows),
    ),
    "snk12_appended_twice": _appended_twice,
    # Order
    "srt1_species_list": lambda i: _in_order(i, sinks.species_list(i.raw)),
    "srt1_attributes": lambda i: _in_order(i, sinks.species_attributes(i.rms)).select("species", "position"),
    "srt2_decades": lambda i: _in_order(i, checks.obs_per_decade(checks.backfill_dates(i.raw, i.occ, i.stage))),
    "lim1_large": _large_limit,
    # Derived columns
    "prj1_standard": lambda i: i.occ.select(*ANY.columns()),
    "prj2_unfiltered": lambda i: i.occ.select(*RunSpec("u", select="unfiltered").columns()),
    "prj3_validation": lambda i: i.occ.select(*RunSpec("v", select="validation").columns()),
    "prj4_nospace": lambda i: derive.with_species_nospace(i.occ).select(C.OBS_ID, C.NOSPACE),
    "prj5_from_underscore": lambda i: derive.with_species_from_underscore(
        _underscored(i.growth_forms)
    ),
    "prj6_event_year": lambda i: derive.with_event_year(i.occ).select(C.OBS_ID, "event_year"),
    "prj7_decade": lambda i: _count(
        i.occ.transform(derive.with_event_year).transform(derive.with_decade), "decade"
    ),
    "prj8_is_vasc": lambda i: _count(derive.with_is_vasc(i.occ), C.GROUP, C.IS_VASC),
    "prj9_status": lambda i: _count(
        derive.normalize_status(i.occ.withColumnRenamed("scrubbed_taxonomic_status", C.STATUS)),
        C.STATUS,
    ),
    "prj10_obs_total": lambda i: i.lookup("all_species")
    .transform(species_ops.with_filter_group, i.lookup("range_model_data_metadata"))
    .transform(species_ops.with_filter_counts, i.lookup("species_observation_counts_crosstab"))
    .transform(derive.with_obs_total)
    .select("species", "filter_group", "obs_total"),
    "prj11_obs_introduced": lambda i: i.lookup("all_species")
    .transform(species_ops.with_filter_group, i.lookup("range_model_data_metadata"))
    .transform(species_ops.with_filter_counts, i.lookup("species_observation_counts_crosstab"))
    .transform(derive.with_obs_introduced)
    .select("species", "obs_introduced"),
    "prj12_caribbean": lambda i: derive.flag_regions(i.lookup("country")),
    "prj12_caribbean_fixed": lambda i: derive.flag_regions(
        i.lookup("country"), fix_french_west_indies=True
    ),
    # Filters
    "flt1_quality": _filtered(ANY),
    "flt2_native": _filtered(MAIN),
    "flt3_native_or_unknown": _filtered(LEGACY),
    "flt4_unknown_status": _filtered(RunSpec("u", introduced="unknown_status")),
    "flt5_introduced": _filtered(RunSpec("i", introduced="introduced")),
    "flt6_strict_date": _filtered(
        RunSpec("s", quality="strict_date", introduced="native_or_unknown")
    ),
    "flt7_dated_specimen": _filtered(
        RunSpec("d", quality="dated_specimen", introduced="native_or_unknown")
    ),
    "flt8_unfiltered": _filtered(RunSpec("n", quality="none", introduced="any")),
    "flt9_accepted_native": lambda i: i.raw.filter(filters.accepted_native()),
    "flt12_clear_shared": lambda i: stats.clear_stats(i.supplemental.stats, "shared"),
    "flt12_clear_checklist": lambda i: stats.clear_stats(i.supplemental.stats, "NSR"),
    "flt13_species_rank": lambda i: i.occ.filter(filters.taxon_is_species()).select(
        C.OBS_ID, "scrubbed_taxon_name_no_author"
    ),
    "flt14_country_unknown": lambda i: i.occ.filter(
        filters.known_country_unknown_status()
    ).select(C.OBS_ID, "country"),
    "flt15_in_no_checklist": lambda i: runs.native_status(i.occ, SUPPLEMENTAL)
    .filter(filters.in_no_checklist(F.col("native_status")))
    .select(C.SPECIES, "native_status"),
    # Joins
    "jn1_group_attributes": lambda i: i.species_rows(MAIN).select(
        C.SPECIES, C.STATUS, C.GROUP, C.IS_VASC
    ),
    "jn2_growth_forms": lambda i: i.species_rows(MAIN).select(
        C.SPECIES, C.STATUS, "family", "growth_form"
    ),
    "jn3_growth_form_confidence": lambda i: species_ops.with_growth_form_confidence(
        i.lookup("all_species"), i.growth_forms
    ).select("species", "growth_form", "growth_form_conf"),
    "jn4_filter_group": lambda i: species_ops.with_filter_group(
        i.lookup("all_species"), i.lookup("range_model_data_metadata")
    ).select("species", "filter_group", "is_modelled"),
    "jn5_filter_counts": lambda i: species_ops.with_filter_counts(
        i.lookup("all_species"), i.lookup("species_observation_counts_crosstab")
    ).select("species", "obs_common", "obs_rare", "obs_rare_native"),
    "jn6_metadata": lambda i: runs.update_attributes(
        i.raw.drop(C.STATUS, C.GROUP), i.lookup("range_model_data_metadata"), i.stage
    ).select(C.OBS_ID, C.STATUS, C.GROUP),
    "jn7_native_status": lambda i: i.flagging.observations.select(
        C.OBS_ID, "native_status", "is_introduced"
    ),
    "jn8_dates": lambda i: checks.backfill_dates(i.raw, i.occ, i.stage).select(C.OBS_ID, "event_date"),
    "jn9_species_attributes": lambda i: lookups.first_per_key(
        i.occ, C.SPECIES, ["scrubbed_taxonomic_status", C.GROUP]
    ).join(i.growth_forms.select(F.col("species").alias(C.SPECIES)), C.SPECIES, "left_semi"),
    "jn10_is_sdm": lambda i: i.native_status,
    "jn11_shared_flag": lambda i: status.flag_shared(i.supplemental_rows.drop("obs"), i.rms),
    "jn12_listed_flag": lambda i: status.flag_listed(
        i.status_profile, i.lookup("checklist_species")
    ),
    "jn13_checklist_flag": lambda i: status.flag_not_unlisted(
        i.supplemental_rows.drop("obs"), runs.native_status(i.occ, SUPPLEMENTAL)
    ),
    "jn14_metadata_flag": lambda i: i.flagging.metadata.select(
        C.SPECIES, f"is_range_model_species_{FLAG_RUN}"
    ),
    "jn15_resolved_rmd": lambda i: runs.resolve_multistatus(
        i.stage.table(runs.extract(i.occ, MAIN), "observations"), i.stage
    ),
    "jn18_multistatus_obs": lambda i: checks.with_names(
        i.occ.select(C.OBS_ID, C.SPECIES, "scrubbed_taxonomic_status"),
        i.stage.table(checks.repeated_species(i.rms), "repeated"),
    ),
    # Aggregations
    "agg1_species_status": lambda i: taxonomy.species_status(runs.extract(i.occ, MAIN)),
    "agg2_multistatus": lambda i: taxonomy.multistatus_species(runs.extract(i.occ, MAIN)),
    "agg3_species_groups": lambda i: taxonomy.species_groups(i.raw),
    "agg4_species_by_group": lambda i: runs.extract(i.occ, LEGACY)
    .select(*taxonomy.PROFILE_KEYS)
    .distinct(),
    "agg5_native_status": lambda i: runs.native_status(i.occ, SUPPLEMENTAL),
    "agg5_taxonomic_status": lambda i: i.status_profile.drop("is_sdm_species"),
    "agg6_counts": lambda i: (
        lambda observations: stats.counts_row(
            C.BEFORE_MULTISTATUS, observations, taxonomy.species_status(observations)
        )
    )(i.stage.table(runs.extract(i.occ, MAIN), "observations")),
    "agg7_difference": lambda i: stats.difference_row(
        stats.main_stats(i.profile).filter("id <= 2")
    ),
    "agg8_supplemental_rows": lambda i: stats.supplemental_rows(i.flagged_rows),
    "agg9_unique": lambda i: lookups.has_duplicates(
        species_ops.combine(
            i.rms, runs.remaining(i.flagged_rows).select(*species_ops.COLUMNS)
        ),
        [C.SPECIES],
        "has_non_unique_species",
    ),
    # Jobs
    "job1_extract_native": lambda i: runs.extract(i.occ, MAIN),
    "job1_limited": lambda i: runs.extract(i.occ, RunSpec("limited", limit=1000)),
    "job3_species_table": lambda i: i.species_rows(MAIN).drop("obs"),
    "stats_main": lambda i: stats.main_stats(i.profile),
    "job4_native_status": lambda i: i.native_status,
    "job4_limited": lambda i: runs.native_status(i.occ, RunSpec("limited", limit=1000)),
    "job5_after_shared_rmd": lambda i: i.after_shared[0],
    "job5_after_shared_rms": lambda i: i.after_shared[1],
    "job6_final_rmd": lambda i: i.supplemental.rmd,
    "job6_final_rms": lambda i: i.supplemental.rms,
    "stats_supplemental": lambda i: i.supplemental.stats,
    "job7_export": _main_files,
    "job8_main_rmd": lambda i: _stored_main(i).rmd,
    "job8_main_rms": lambda i: _stored_main(i).rms,
    "job8_extended_rmd": lambda i: _extended(i).rmd,
    "job8_extended_rms": lambda i: _extended(i).rms,
    "stats_extended": lambda i: _extended(i).stats,
    "job9_supplemental_rmd": lambda i: i.supplemental_stored.rmd,
    "job9_supplemental_rms": lambda i: i.supplemental_stored.rms,
    "job9_native_status": lambda i: i.supplemental_stored.native_status,
    "job10_export": _unfiltered_files,
    "job12_export": _flagged_files,
    "job13_export": _legacy_files,
    "job14_export": _introduced_file,
    "job15_export": _combined_file,
    "job10_unfiltered": lambda i: runs.unfiltered_run(i.occ),
    "job11_import": _import,
    "job12_flags": lambda i: i.flagging.observations,
    "job12_metadata": lambda i: i.flagging.metadata,
    "job13_legacy_rmd": lambda i: runs.legacy_run(i.occ, i.growth_forms, LEGACY)[0],
    "job13_legacy_rms": lambda i: runs.legacy_run(i.occ, i.growth_forms, LEGACY)[1],
    "job14_introduced": lambda i: species_ops.introduced_summary(
        i.lookup("all_species"),
        i.growth_forms,
        i.lookup("range_model_data_metadata"),
        i.lookup("species_observation_counts_crosstab"),
    ),
    "job15_combined": lambda i: species_ops.combine(
        i.rms, runs.remaining(i.flagged_rows).select(*species_ops.COLUMNS)
    ),
    "job16_sample": lambda i: runs.sample_tables(
        i.raw, i.lookup("range_model_data_metadata")
    )[0],
    "job16_sample_metadata": lambda i: runs.sample_tables(
        i.raw, i.lookup("range_model_data_metadata")
    )[1],
    # Validations
    "val1_decade": lambda i: checks.obs_per_decade(checks.backfill_dates(i.raw, i.occ, i.stage)),
    "val1_species_decade": lambda i: checks.obs_per_species_decade(
        checks.backfill_dates(i.raw, i.occ, i.stage)
    ),
    "val2_null_obs": lambda i: checks.null_rates_obs(i.test_data),
    "val2_null_spp": lambda i: checks.null_rates_species(i.test_data),
    "val2_country": lambda i: checks.null_introduced_by_country(i.test_data),
    "val2_dataset": lambda i: checks.undated_plots(i.test_data),
    "val2_obs_type": lambda i: checks.undated_by_type(i.test_data, 1_000_000),
    "val2_peek": lambda i: checks.peek_undated(i.test_data),
    "val3_region_flags": lambda i: derive.flag_regions(i.lookup("country")),
    "val4_overlap": lambda i: checks.overlap(
        i.stage.table(i.supplemental_rows, "species"), i.rms
    ),
    "val5_native": lambda i: checks.by_native_status(i.status_profile),
    "val5_taxonomic": lambda i: checks.unmodelled_by_taxonomic_status(i.status_profile),
    "val5_nsr": lambda i: checks.unmodelled_by_checklist(i.status_profile, _checklist(i)),
    "val5_country": lambda i: checks.countries_in_no_checklist(i.occ),
    "val6_species_rank": lambda i: i.audit[0],
    "val6_conflicting": lambda i: i.audit[1],
    "val7a_species_counts": lambda i: checks.species_counts(i.raw, i.listed),
    "val7b_country": lambda i: checks.species_in_country(i.raw, i.occ, i.listed, COUNTRY),
    "val7c_continent": lambda i: checks.prefixed_in_continent(i.raw, i.occ, PREFIXES, CONTINENT),
    "val7d_locality": lambda i: checks.prefixed_localities(i.raw, i.occ, PREFIXES, CONTINENT),
    "val7e_genus": lambda i: checks.genera_in_country(i.occ, PREFIXES, COUNTRY),
    "val7f_genus_in_raw": lambda i: checks.genera_in_raw(i.raw, i.occ, PREFIXES, COUNTRY),
    "val7g_territory_species": lambda i: checks.species_in_territories(
        i.occ, i.lookup("country"), i.listed, _iso(*FRENCH, "GUF")
    ),
    "val7h_region_flag": lambda i: checks.species_in_territories(
        i.occ,
        derive.flag_regions(i.lookup("country")),
        i.listed,
        (F.col("is_caribbean") == 1) | _iso("GUF"),
    ),
    "val7i_territory_rows": lambda i: checks.rows_in_territories(
        i.occ, i.lookup("country"), i.listed, _iso(*FRENCH)
    ),
    "val7j_species_country": lambda i: checks.raw_species_by_country(
        i.raw, i.occ, i.lookup("country"), i.listed, _iso(*FRENCH, "GUF")
    ),
    "val7j_wider": lambda i: checks.raw_species_by_country(
        i.raw, i.occ, i.lookup("country"), i.listed, _iso(*FRENCH, "GUF", "PYF", "ATF")
    ),
    "val7k_one_species": lambda i: checks.raw_species_by_country(
        i.raw, i.occ, i.lookup("country"), ["hot gear 3"]
    ),
    "val8_prefix": lambda i: checks.prefixed_in_country_table(
        fixtures.country_species(i.spark, i.sf_dir), PREFIXES, COUNTRY
    ),
    "val8_prefix_sdm": lambda i: checks.prefixed_in_country_table(
        fixtures.country_species_sdm(i.spark, i.sf_dir), PREFIXES, COUNTRY
    ),
}


def _stored_main(i: Inputs) -> runs.Run:
    return runs.save_run(i.main, i.stage.path("run"), MAIN)


def _query(build: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(Inputs(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(build) for name, build in QUERIES.items()}
