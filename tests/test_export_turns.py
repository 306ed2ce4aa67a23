"""An export is written in turns from lines that are stored once; what was shuffled goes with the step that needed it."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from occflow import constants as C
from occflow.sources import layout, run_tables, sinks, species_export


def named(spark, species=60, rows=2400):
    """Rows of many species with a text that no codec shortens; one species has no name, ids repeat."""
    name = F.when(F.col("id") % species == 0, "").otherwise(F.concat(F.lit("Name "), (F.col("id") * 7919 % species).cast("string")))
    note = F.concat(*[F.sha2(F.concat("id", F.lit(n)), 256) for n in "abcd"])
    return spark.range(rows).select((F.col("id") % 700).alias(C.OBS_ID), name.alias(C.NOSPACE), note.alias("note"))


def content(path):
    """Lines of every file by folder and part number."""
    names = glob.glob(f"{path}/species_file=*/part-*.csv")
    found = {(os.path.basename(os.path.dirname(n)), os.path.basename(n).split("-")[1]): open(n, newline="").read() for n in names}
    assert len(found) == len(names)
    return found


def shuffled(spark):
    """Bytes of shuffle files on the disk."""
    top = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(os.path.getsize(n) for d in top for n in glob.glob(f"{d}/*/shuffle_*.data"))


@pytest.fixture
def many_turns(monkeypatch):
    monkeypatch.setattr(layout, "FILE_COST", 64)
    monkeypatch.setattr(layout, "PART_WEIGHT", 1 << 12)
    monkeypatch.setattr(species_export, "TURN", 1)


@pytest.mark.parametrize("hot", [False, True])
def test_lines_go_turn_by_turn(spark, tmp_path, monkeypatch, many_turns, hot):
    df = named(spark, rows=600)
    if hot:
        df = df.union(named(spark, rows=200).withColumn(C.NOSPACE, F.lit("Name 7")))
    path, other = str(tmp_path / "species"), str(tmp_path / "by_spark")
    seen = []

    def delete(spark, place, own=species_export._delete):
        if "/stretch=" in place:
            seen.append((len(os.listdir(f"{path}/{species_export.LINES}")), len(content(path))))
        own(spark, place)

    monkeypatch.setattr(species_export, "_delete", delete)
    sinks.export_by_species(df, path, columns=["*"])
    assert len({files for _, files in seen}) >= 6 and [n for n, _ in seen] == sorted((n for n, _ in seen), reverse=True)
    assert not os.path.exists(f"{path}/{species_export.LINES}")
    export = species_export.Export(df, ["*"])
    plan = species_export._plan(export, path)
    assert plan.cut == hot
    species_export._write(export, plan, None, other, True)
    assert content(path) == content(other) != {}


@pytest.mark.parametrize("hot", [0, 9000])
def test_turns_hold_every_part_once(spark, stage, many_turns, hot):
    df = named(spark, rows=300).union(named(spark, rows=hot).withColumn(C.NOSPACE, F.lit("Name 7")))
    plan = species_export.Export(df, ["*"]).plan(stage.table)
    where = {}
    for r in plan.parts.withColumn("stretch", layout.stretch_of(F.col("file"))).collect():
        where.setdefault(r["part"], set()).add(r["stretch"])
    for least in (1, 7, 40, 10**6):
        turns = layout.turns(plan, least)
        assert all(first <= last for first, last, _, _ in turns)
        assert [p for first, last, _, _ in turns for p in range(first, last + 1)] == list(range(max(where) + 1))
        assert all(where.get(p, set()) <= set(stretches) for first, last, stretches, _ in turns for p in range(first, last + 1))
        assert sorted(s for *_, ended in turns for s in ended) == sorted(set.union(*where.values()))
        assert least < 10**6 or len(turns) == 1
        # None is read once it is gone.
        assert not any(set(a[3]) & set(b[2]) for i, a in enumerate(turns) for b in turns[i + 1 :])
    empty = species_export.Export(named(spark).where("false"), ["*"]).plan(stage.table)
    assert layout.turns(empty, 1) == []


def test_an_export_without_rows(spark, tmp_path):
    path = str(tmp_path / "species")
    sinks.export_by_species(named(spark).where("false"), path, columns=["*"])
    assert species_export.manifest(spark, path).count() == 0 and os.path.exists(f"{path}/_SUCCESS") and not content(path)


def test_nothing_shuffled_outlasts_an_export(spark, tmp_path):
    path, before = str(tmp_path / "species"), shuffled(spark)
    sinks.export_by_species(named(spark).repartition(5, "note"), path, columns=["*"])
    assert sum(map(len, content(path).values())) > 2400 * 256
    # Half of the text in either of two shuffles would be more.
    assert shuffled(spark) - before < 2400 * 64


def test_nothing_shuffled_outlasts_a_run_table(spark, tmp_path):
    kept = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    before = shuffled(spark)
    stored = run_tables.save(named(spark).repartition(5, "note"), str(tmp_path), "t")
    assert shuffled(spark) - before < 2400 * 64
    assert stored.count() == stored.count() == 2400
    assert all(n.endswith(".zstd.parquet") for n in map(os.path.basename, stored.inputFiles()))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == kept


def test_a_failed_export_leaves_no_lines(spark, tmp_path, many_turns):
    df, path = named(spark, rows=300), str(tmp_path / "species")
    sinks.export_by_species(df, path, columns=["*"])
    whole = content(path)
    # As after a failure, with a file where a folder has to be.
    for name in glob.glob(f"{path}/_manifest/*") + glob.glob(f"{path}/_manifest/.*") + glob.glob(f"{path}/species_file=Name 1*/*"):
        os.remove(name)
    blocked = f"{path}/species_file=Name 11"
    os.rmdir(blocked)
    open(blocked, "w").close()
    with pytest.raises(Exception, match="Name 11"):
        sinks.export_by_species(df, path, columns=["*"], resume=True)
    assert not os.path.exists(f"{path}/{species_export.LINES}")
    os.remove(blocked)
    sinks.export_by_species(df, path, columns=["*"], resume=True)
    assert content(path) == whole and species_export.manifest(spark, path).count() == len(whole)
