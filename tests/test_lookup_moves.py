"""What look-ups by id and the occurrence view move."""

from occflow import constants as C
from occflow.operators import lookups
from occflow.sources.staging import Stage
from verification import fixtures


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_names_to_look_up_move_without_ids(spark, stage, monkeypatch):
    kept, table = {}, Stage.table
    monkeypatch.setattr(Stage, "table", lambda self, df, name: kept.setdefault(name, table(self, df, name)))
    raw = spark.createDataFrame([(5, "a"), (9, "a"), (None, None)], f"{C.OBS_ID} long, {C.SPECIES} string")
    occ = spark.createDataFrame([(5, "a"), (9, "b"), (9, None), (7, "a"), (10, "a")], f"{C.OBS_ID} long, {C.SPECIES} string")
    near = {tuple(r) for r in lookups.alike(occ, raw, stage).collect()}
    assert {(5, "a"), (9, None)} <= near <= {(5, "a"), (9, None), (7, "a")}
    assert kept["raw_species"].columns == [C.SPECIES] and kept["raw_species"].count() == 2


def test_ids_are_put_together_after_the_joins(spark, sf_dir):
    text = plan_of(fixtures.occurrences(spark, sf_dir).select(C.OBS_ID, "georef_protocol"))
    assert text.index(f"AS {C.OBS_ID}") < text.index("Join Inner")
