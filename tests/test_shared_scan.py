"""A supplemental run and the earlier run before it scan the occurrences once."""

import pytest

from occflow.plans import runs
from occflow.spec import RunSpec
from verification import registry


def test_species_of_an_earlier_run_come_from_the_scan_of_a_supplemental_one(spark, sf_dir, stage, monkeypatch):
    inputs = registry.Inputs(spark, sf_dir)
    scanned = runs.scan(inputs.occ, registry.SUPPLEMENTAL, stage)
    again = runs.species_rows(inputs.occ, inputs.growth_forms, registry.MAIN).collect()
    made = runs.species_rows_from(scanned, inputs.growth_forms, registry.MAIN)
    assert sorted(map(str, made.collect())) == sorted(map(str, again)) != []
    with pytest.raises(ValueError, match="not counted"):
        runs.species_rows_from(scanned, inputs.growth_forms, RunSpec("s", quality="strict_date"))
    seen = []
    extract = runs.extract
    monkeypatch.setattr(runs, "extract", lambda *a: seen.append(1) or extract(*a))
    assert inputs.supplemental.native_status.count() > 0
    assert len(seen) == 1
