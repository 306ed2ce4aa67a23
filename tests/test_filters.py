from datetime import date

import pytest
from pyspark.sql import functions as F

from occflow.functions import filters
from occflow.spec import RunSpec

GOOD = {
    "scrubbed_species_binomial": "Aus bus",
    "higher_plant_group": "bryophytes",
    "is_invalid_latlong": 0,
    "is_geovalid": 1,
    "georef_protocol": None,
    "is_centroid": None,
    "is_location_cultivated": None,
    "is_cultivated_observation": None,
    "observation_type": "plot",
    "event_date": date(1999, 5, 1),
}
SCHEMA = """scrubbed_species_binomial string, higher_plant_group string, is_invalid_latlong int,
    is_geovalid int, georef_protocol string, is_centroid int, is_location_cultivated int,
    is_cultivated_observation int, observation_type string, event_date date"""

CASES = [
    ("scrubbed_species_binomial", None, False),
    ("higher_plant_group", "flowering plants", True),
    ("higher_plant_group", "algae", False),
    ("higher_plant_group", None, False),
    ("is_invalid_latlong", 1, False),
    ("is_invalid_latlong", None, False),
    ("is_geovalid", 0, False),
    ("is_geovalid", None, False),
    ("georef_protocol", "gps", True),
    ("georef_protocol", "county_centroid", False),
    ("is_centroid", 0, True),
    ("is_centroid", 1, False),
    ("is_location_cultivated", 0, False),
    ("is_location_cultivated", 1, False),
    ("is_cultivated_observation", 0, True),
    ("is_cultivated_observation", 1, False),
    ("observation_type", "checklist", True),
    ("observation_type", "human observation", False),
    ("observation_type", None, False),
    ("event_date", None, True),
    ("event_date", date(1950, 1, 1), True),
    ("event_date", date(1949, 12, 31), False),
]


def passing(spark, rows, predicate, schema=SCHEMA):
    data = [(i, *row.values()) for i, row in enumerate(rows)]
    df = spark.createDataFrame(data, f"i int, {schema}")
    return {r.i for r in df.filter(predicate).select("i").collect()}


def test_every_branch_of_the_main_filter(spark):
    rows = [GOOD] + [{**GOOD, column: value} for column, value, _ in CASES]
    expected = {0} | {i + 1 for i, (_, _, ok) in enumerate(CASES) if ok}
    assert passing(spark, rows, filters.quality_filter()) == expected


def test_date_rules(spark):
    rows = [
        {**GOOD, "event_date": None},
        {**GOOD, "event_date": None, "observation_type": "specimen"},
        {**GOOD, "event_date": date(1950, 1, 1)},
    ]
    assert passing(spark, rows, RunSpec("r", introduced="any").predicate()) == {0, 1, 2}
    strict = RunSpec("r", quality="strict_date", introduced="any")
    assert passing(spark, rows, strict.predicate()) == {2}
    dated = RunSpec("r", quality="dated_specimen", introduced="any")
    assert passing(spark, rows, dated.predicate()) == {0, 2}


@pytest.mark.parametrize(
    "name, expected",
    [
        ("native", {0}),
        ("native_or_unknown", {0, 2}),
        ("introduced", {1, 3}),
        ("unknown_status", {2, 3}),
        ("any", {0, 1, 2, 3}),
        ("is_introduced = 1 OR native_status = 'N'", {0, 1, 3}),
    ],
)
def test_native_status_filters(spark, name, expected):
    rows = [
        {"is_introduced": 0, "native_status": "N"},
        {"is_introduced": 1, "native_status": "I"},
        {"is_introduced": None, "native_status": None},
        {"is_introduced": 1, "native_status": "UNK"},
    ]
    predicate = RunSpec("r", quality="none", introduced=name).predicate()
    assert passing(spark, rows, predicate, "is_introduced int, native_status string") == expected


def test_status_sets_of_species_in_no_checklist(spark):
    sets = ["A", "A,UNK", "UNK", None, "A,N", "I", "UNK,Ne"]
    df = spark.createDataFrame([(s,) for s in sets], "s string")
    kept = [r.s for r in df.filter(filters.in_no_checklist(F.col("s"))).collect()]
    assert kept == ["A", "A,UNK", "UNK", None]


def test_spec_is_checked():
    with pytest.raises(ValueError):
        RunSpec("with space")
    with pytest.raises(ValueError):
        RunSpec("r", missing_spp_run=True)
    with pytest.raises(ValueError):
        RunSpec("r", select="nothing")
    with pytest.raises(ValueError):
        RunSpec("r", limit=-1)
    spec = RunSpec("20240101_extra", missing_spp_run=True, prev_run="20240101")
    assert spec.rmd_table == "range_model_data_raw_20240101_extra"
    assert spec.prev_rms_table == "range_model_species_20240101"
    assert spec.stats_table == "range_model_data_stats_20240101_extra"
    assert spec.data_dir == "rm_data_20240101_extra"
