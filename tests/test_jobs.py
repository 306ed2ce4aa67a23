"""Whole jobs: they refuse an existing output, store first, and keep their order."""

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows
from verification import registry

from occflow import constants as C
from occflow.plans import checks, runs
from occflow.spec import RunSpec


@pytest.fixture
def inputs(spark, sf_dir):
    made = registry.Inputs(spark, sf_dir)
    yield made
    made.stage.clear()


@pytest.mark.parametrize("job", ["unfiltered", "legacy", "flagging", "introduced"])
def test_an_existing_output_is_refused_before_any_table_is_stored(spark, inputs, tmp_path, job):
    base, out = f"{tmp_path}/base", f"{tmp_path}/out"
    calls = {
        "unfiltered": (lambda: runs.run_unfiltered(inputs.occ, base, out, "u"), f"{out}/rm_data_u"),
        "legacy": (
            lambda: runs.run_legacy(inputs.occ, inputs.growth_forms, RunSpec("l"), base, out),
            f"{out}/rm_data_l",
        ),
        "flagging": (
            lambda: runs.run_flagging(
                inputs.raw, inputs.lookup("range_model_data_metadata"), inputs.occ, "f", base, out
            ),
            f"{out}/rm_data_f",
        ),
        "introduced": (
            lambda: runs.export_introduced(*[inputs.growth_forms] * 4, base, f"{out}/i"),
            f"{out}/i",
        ),
    }
    call, folder = calls[job]
    spark.range(1).write.csv(folder)
    with pytest.raises(FileExistsError):
        call()
    assert not (tmp_path / "base").exists()


def test_combined_species_are_ordered_and_checked(spark, tmp_path):
    schema = f"{C.SPECIES} string, {C.NOSPACE} string"
    first = spark.createDataFrame([("b b", "b_b"), ("c c", "c_c")], schema)
    second = spark.createDataFrame([("a a", "a_a"), ("c c", "c_c")], schema)
    stored, repeated = runs.combine_and_export(first, second, f"{tmp_path}/base", f"{tmp_path}/out", "all")
    assert stored.count() == 4 and repeated.first()[0] is True
    lines = [r[0] for r in spark.read.text(f"{tmp_path}/out").collect()]
    assert [line for line in lines if not line.startswith(C.SPECIES)] == ["a a,a_a", "b b,b_b", "c c,c_c", "c c,c_c"]


def test_orders_of_results(spark):
    data = [("a", "Accepted", d, 0) for d in (None, 1950, 2000, 1950)] + [(None, "Accepted", 1990, 0)]
    df = spark.createDataFrame(data, f"{C.SPECIES} string, {C.STATUS} string, decade int, is_introduced int")
    assert [r.decade for r in checks.obs_per_decade(df).collect()] == [None, 2000, 1990, 1950]
    found = [(r.species, r.decade) for r in checks.obs_per_species_decade(df).collect()]
    assert found == [("a", None), ("a", 2000), ("a", 1950), (None, 1990)]


def test_any_selection_can_be_extracted(inputs):
    extracted = runs.extract(inputs.occ, RunSpec("v", select="validation"))
    assert {C.NOSPACE, "event_year", "decade"} <= set(extracted.columns)
    assert C.IS_VASC not in extracted.columns
    assert extracted.count() == runs.extract(inputs.occ, RunSpec("s")).count()
    own = runs.extract(inputs.occ, RunSpec("o", select={C.OBS_ID: "id"}, introduced="any"))
    assert own.columns == ["id"]


def test_metadata_of_a_flagging_job_comes_from_its_stored_observations(inputs, tmp_path):
    metadata = inputs.lookup("range_model_data_metadata")
    stored = runs.run_flagging(inputs.raw, metadata, inputs.occ, "f", f"{tmp_path}/base", f"{tmp_path}/out")
    used = stored.observations.filter("is_range_model_ob_f = 1").select(C.SPECIES).distinct()
    flagged = stored.metadata.filter("is_range_model_species_f = 1").select(C.SPECIES)
    assert rows(flagged) == rows(metadata.select(C.SPECIES).join(used, C.SPECIES, "left_semi"))
    assert stored.observations.filter(F.input_file_name().contains("base")).count() == inputs.raw.count()
