import glob

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows

from occflow import constants as C
from occflow.plans import runs
from occflow.sources import readers
from occflow.spec import RunSpec
from verification import fixtures

MAIN = RunSpec("20240101")
EXTRA = RunSpec(
    "20240101_extra", introduced="unknown_status", missing_spp_run=True, prev_run="20240101"
)


@pytest.fixture(scope="module")
def occ(spark, sf_dir, tmp_path_factory):
    """The occurrence view, stored as the table that a user would have."""
    path = str(tmp_path_factory.mktemp("occ") / "occ")
    fixtures.occurrences(spark, sf_dir).write.parquet(path)
    return readers.read_occurrences(spark, path)


@pytest.fixture(scope="module")
def growth_forms(spark, sf_dir):
    return fixtures.lookup(spark, sf_dir, "species_growth_forms")


@pytest.fixture(scope="module")
def stored(spark, occ, growth_forms, tmp_path_factory):
    """A main and a supplemental run with their exports."""
    root = tmp_path_factory.mktemp("runs")
    base, out = str(root / "tables"), str(root / "files")
    main = runs.run_and_export(occ, growth_forms, MAIN, base, out)
    previous = readers.read_table(spark, f"{base}/{EXTRA.prev_rms_table}")
    extra = runs.run_and_export(occ, growth_forms, EXTRA, base, out, previous)
    return main, extra, base, out


def test_schemas(stored):
    main, extra, _, _ = stored
    assert [f.simpleString() for f in main.rmd.schema] == [
        "taxonobservation_id:bigint",
        "scrubbed_species_binomial:string",
        "latitude:double",
        "longitude:double",
        "taxonomic_status:string",
        "higher_plant_group:string",
        "country:string",
        "native_status:string",
        "is_introduced:int",
        "observation_type:string",
        "event_date:date",
        "species_nospace:string",
        "is_vasc:int",
        "event_year:int",
        "decade:int",
    ]
    assert [f.simpleString() for f in main.rms.schema] == [
        "scrubbed_species_binomial:string",
        "species_nospace:string",
        "taxonomic_status:string",
        "higher_plant_group:string",
        "is_vasc:int",
        "family:string",
        "growth_form:string",
    ]
    assert [f.simpleString() for f in extra.native_status.schema] == [
        "scrubbed_species_binomial:string",
        "is_introduced:string",
        "native_status:string",
        "obs:bigint",
        "is_sdm_species:int",
    ]


def test_counts_of_the_main_run(stored):
    main = stored[0]
    assert main.rmd.count() == 398
    assert main.rms.count() == 112
    assert [tuple(r) for r in main.stats.orderBy("id").collect()] == [
        (1, C.BEFORE_MULTISTATUS, 420, 110, 119),
        (2, C.AFTER_MULTISTATUS, 398, 109, 112),
        (3, C.DIFFERENCE, 22, 1, 7),
    ]


def test_supplemental_run_repeats_no_species(stored):
    main, extra, _, _ = stored
    before = main.rms.select(C.SPECIES)
    assert extra.rmd.join(before, C.SPECIES, "left_semi").count() == 0
    assert extra.rms.join(before, C.SPECIES, "left_semi").count() == 0
    assert rows(extra.rmd.select(C.SPECIES).distinct()) == rows(
        extra.rms.select(C.SPECIES).distinct()
    )


def test_supplemental_statistics_add_up(stored):
    extra = stored[1]
    stats = {r.period: r for r in extra.stats.collect()}
    assert [r.id for r in extra.stats.orderBy("id").collect()] == [1, 2, 3, 4, 5, 6, 7]
    assert stats[C.SHARED_SPECIES].species == 114
    assert stats[C.AFTER_SHARED].species + 114 == stats[C.AFTER_MULTISTATUS].species_table_rows
    assert stats[C.CHECKLIST_SPECIES].species == 6
    assert stats[C.AFTER_CHECKLIST].species == stats[C.AFTER_SHARED].species - 6 == 54
    assert stats[C.AFTER_CHECKLIST].species == extra.rms.count()
    assert stats[C.AFTER_CHECKLIST].obs == extra.rmd.count()


def test_files_hold_the_observations_of_their_species(spark, stored):
    main, _, _, out = stored
    folder = f"{out}/{MAIN.data_dir}"
    points = readers.read_csv(
        spark,
        f"{folder}/species",
        "taxonobservation_id long, species string, latitude double, longitude double, species_file string",
        header=True,
    )
    assert rows(points, C.OBS_ID, "species_file", "latitude", "longitude") == rows(
        main.rmd, C.OBS_ID, C.NOSPACE, "latitude", "longitude"
    )
    directories = glob.glob(f"{folder}/species/species_file=*")
    names = readers.read_species_list(spark, f"{folder}/range_model_species")
    assert len(directories) == names.count() == 109
    attributes = readers.read_csv(
        spark,
        f"{folder}/{MAIN.attributes_file}",
        "species string, family string, taxonomic_status string, higher_plant_group string, is_vasc int, growth_form string",
        header=True,
    )
    assert attributes.count() == main.rms.count()


def test_a_second_run_into_the_same_folder_is_refused(occ, growth_forms, stored):
    _, _, base, out = stored
    with pytest.raises(FileExistsError):
        runs.run_and_export(occ, growth_forms, MAIN, base, out)


def test_a_supplemental_run_needs_its_previous_run(occ, growth_forms, stage):
    with pytest.raises(ValueError):
        runs.run(occ, growth_forms, EXTRA, stage)


def test_one_scan_and_two_scans_agree(occ, growth_forms, stored, stage):
    """The same filter given as SQL text cannot share the scan."""
    main, extra, _, _ = stored
    text = RunSpec(
        "text",
        introduced="native_status in ('A', 'UNK') or native_status is null",
        missing_spp_run=True,
        prev_run="20240101",
    )
    again = runs.run(occ, growth_forms, text, stage, main.rms)
    assert rows(again.rmd) == rows(extra.rmd)
    assert rows(again.rms) == rows(extra.rms)
    assert rows(again.stats) == rows(extra.stats)
    assert rows(again.native_status) == rows(extra.native_status)


def test_limits_repeat(occ, growth_forms, stage):
    limited = RunSpec("test", limit=50)
    first, second = (runs.run(occ, growth_forms, limited, stage) for _ in range(2))
    assert rows(first.rmd) == rows(second.rmd)
    assert first.stats.filter("id = 1").first().obs == 50


def test_a_limited_supplemental_run_limits_the_native_status_table(
    occ, growth_forms, stored, stage
):
    limited = RunSpec(
        "test", introduced="unknown_status", missing_spp_run=True, prev_run="p", limit=50
    )
    out = runs.run(occ, growth_forms, limited, stage, stored[0].rms)
    assert out.native_status.agg(F.sum("obs")).first()[0] == 50


def test_legacy_and_unfiltered_exports(spark, occ, growth_forms, sf_dir, tmp_path, stage):
    legacy = RunSpec("legacy", introduced="native_or_unknown")
    observations, species = runs.legacy_run(occ, growth_forms, legacy)
    runs.export_legacy(observations, species, str(tmp_path / "legacy"))
    files = glob.glob(f"{tmp_path}/legacy/species/*/*.csv")
    assert len(files) == observations.select(C.SPECIES).distinct().count()

    unfiltered = runs.unfiltered_run(occ.limit(500))
    runs.export_unfiltered(unfiltered, str(tmp_path / "unfiltered"))
    with open(glob.glob(f"{tmp_path}/unfiltered/species/*/*.csv")[0]) as f:
        assert f.readline().strip() == ",".join(unfiltered.columns)

    metadata = fixtures.lookup(spark, sf_dir, "range_model_data_metadata")
    raw = stage.table(runs.extract(occ, RunSpec("any", introduced="any")), "raw")
    flagged = runs.flagging_run(raw, metadata, occ, "202209", stage)
    runs.export_flagged(flagged, "202209", str(tmp_path / "flagged"))
    used = flagged.observations.filter("is_range_model_ob_202209 = 1")
    exported = glob.glob(f"{tmp_path}/flagged/species/species_file=*")
    assert len(exported) == used.select(C.SPECIES).distinct().count()


def test_import_keeps_every_listed_name(spark, occ, tmp_path):
    names = ["absent_one"] + [
        r[0].replace(" ", "_")
        for r in occ.select(C.SPECIES).distinct().orderBy(F.col(C.SPECIES).desc()).head(2)
    ]
    source = str(tmp_path / "list")
    spark.createDataFrame([(n,) for n in names], "species_ul string").write.csv(source)
    runs.import_and_export(spark, source, occ, f"{tmp_path}/out", f"{tmp_path}/names")
    back = readers.read_csv(
        spark,
        f"{tmp_path}/out",
        "species_ul string, species string, taxonomic_status string, higher_taxon string",
        header=True,
    )
    found = {r.species_ul: r for r in back.collect()}
    assert set(found) == set(names)
    assert found["absent_one"].higher_taxon is None
    assert all(found[n].higher_taxon is not None for n in names[1:])
    listed = readers.read_csv(spark, f"{tmp_path}/names", "species string", header=False)
    assert rows(listed) == sorted((n.replace("_", " "),) for n in names)


def test_staged_tables_are_cleared(spark, occ, growth_forms, tmp_path):
    staged = f"{spark.conf.get('spark.checkpoint.dir')}/occflow-*"
    before = set(glob.glob(staged))
    limited = RunSpec("cleared", limit=20)
    runs.run_and_export(occ, growth_forms, limited, f"{tmp_path}/base", f"{tmp_path}/out")
    assert set(glob.glob(staged)) == before
    assert glob.glob(f"{tmp_path}/out/rm_data_cleared/species/*/*.csv")


def test_an_extended_run_equals_a_whole_one(spark, occ, growth_forms, tmp_path, stage):
    whole = runs.main_run(occ, growth_forms, MAIN, stage)
    thirds = [occ.filter(F.col(C.OBS_ID) % 3 == k) for k in range(3)]
    base = str(tmp_path)
    run = runs.save_run(runs.main_run(thirds[0], growth_forms, MAIN, stage), base, MAIN)
    for batch in thirds[1:]:
        run = runs.save_run(runs.extend_run(run, batch, growth_forms, MAIN, stage), base, MAIN)
    assert rows(run.rmd) == rows(whole.rmd)
    assert rows(run.rms) == rows(whole.rms)
    assert rows(run.stats) == rows(whole.stats)
    again = runs.stored_run(spark, base, MAIN)
    assert rows(again.profile) == rows(whole.profile)
    with pytest.raises(ValueError):
        runs.extend_run(run, occ, growth_forms, RunSpec("l", limit=5), stage)


def test_columns_of_an_input_are_checked_before_any_work(spark, occ, tmp_path):
    def stored(df, name):
        df.limit(1).write.parquet(f"{tmp_path}/{name}")
        return f"{tmp_path}/{name}"

    assert "locality" in readers.read_occurrences(spark, stored(occ, "good")).columns
    wrong = occ.drop("country", "event_date").withColumn("latitude", F.lit("1.5")).withColumn(C.OBS_ID, F.lit(1))
    with pytest.raises(readers.SchemaError) as error:
        readers.read_occurrences(spark, stored(wrong, "wrong"))
    for part in ("missing: country string", "missing: event_date date", "retyped: latitude string, declared double", f"retyped: {C.OBS_ID} int"):
        assert part in str(error.value)
    assert "extra" not in str(error.value)
    with pytest.raises(readers.SchemaError, match="extra: locality string"):
        readers.check_schema(occ, C.OCCURRENCE_SCHEMA, "occ", extra=False)
    own = occ.select(F.col(C.OBS_ID), F.col("country").alias("Country"))
    with pytest.raises(readers.SchemaError, match="missing: country string"):
        readers.check_schema(own, f"{C.OBS_ID} bigint, country string", "own")


def test_the_header_of_a_checklist_is_checked(spark, tmp_path):
    for name, df in (("other", spark.createDataFrame([("A a",)], "name string")), ("two", spark.createDataFrame([("A a", "x")], "species string, x string"))):
        df.write.csv(f"{tmp_path}/{name}", header=True)
        with pytest.raises(readers.SchemaError, match="missing: species|extra: x"):
            readers.read_checklist(spark, f"{tmp_path}/{name}")
