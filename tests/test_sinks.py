import glob
import os

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows

from occflow.sources import layout, readers, sinks, species_export


def points(spark, hot=4000, others=40):
    """One species with most of the rows, ids out of order, and one null species."""
    hot_rows = spark.range(hot).select(
        ((F.col("id") * 7919) % 1_000_003).alias("taxonobservation_id"),
        F.lit("Hot_one").alias("species_nospace"),
    )
    other = spark.range(others * 10).select(
        (F.col("id") + 2_000_000).alias("taxonobservation_id"),
        F.concat(F.lit("Cold_"), (F.col("id") % others).cast("string")).alias("species_nospace"),
    )
    none = spark.range(3).select(
        (F.col("id") + 9_000_000).alias("taxonobservation_id"),
        F.lit(None).cast("string").alias("species_nospace"),
    )
    return (
        hot_rows.union(other)
        .union(none)
        .withColumn("latitude", F.lit(1.5))
        .withColumn("longitude", F.lit(-2.25))
    )


def files_of(path, species):
    return sorted(glob.glob(f"{path}/species_file={species}/*.csv"))


def ids_in(files, header=True):
    ids = []
    for name in files:
        with open(name) as f:
            lines = f.read().splitlines()[1 if header else 0 :]
        ids += [int(line.split(",")[0]) for line in lines]
    return ids


def test_each_species_has_ordered_parts(spark, tmp_path):
    df = points(spark)
    path = str(tmp_path / "species")
    sinks.export_by_species(df, path)
    directories = glob.glob(f"{path}/species_file=*")
    assert len(directories) == 41
    for directory in directories:
        ids = ids_in(sorted(glob.glob(f"{directory}/*.csv")))
        assert ids == sorted(ids) and len(ids) in (10, 4000)
    with open(files_of(path, "Cold_1")[0]) as f:
        assert f.readline().strip() == "taxonobservation_id,species,latitude,longitude"
        assert f.readline().strip() == "2000001,Cold_1,1.5,-2.25"


def test_a_large_species_is_divided_in_id_order(spark, tmp_path, monkeypatch):
    # As if files cost nothing, so that these few rows weigh more than all the files.
    monkeypatch.setattr(layout, "FILE_COST", 1)
    df = points(spark)
    path = str(tmp_path / "species")
    sinks.export_by_species(df, path, header=False)
    files = files_of(path, "Hot_one")
    assert len(files) >= 3
    ids = ids_in(files, header=False)
    assert len(ids) == 4000 and ids == sorted(ids)
    assert max(len(ids_in([f], header=False)) for f in files) < 2000


def test_all_columns_of_all_species_come_back(spark, tmp_path):
    df = points(spark, hot=50)
    path = str(tmp_path / "species")
    sinks.export_by_species(df, path, columns=["*"])
    schema = "taxonobservation_id long, species_nospace string, latitude double, longitude double"
    back = readers.read_csv(spark, path, f"{schema}, species_file string", header=True)
    assert rows(back.drop("species_file")) == rows(df.filter("species_nospace is not null"))


def test_flat_names(spark, tmp_path):
    df = points(spark, hot=2000, others=4)
    path = str(tmp_path / "species")
    sinks.export_by_species(df, path)
    sinks.flatten_by_species(spark, path)
    names = [n for n in os.listdir(path) if n.endswith(".csv")]
    assert "Cold_0-00000.csv" in names
    hot = sorted(n for n in names if n.startswith("Hot_one-"))
    assert hot
    ids = ids_in([f"{path}/{n}" for n in hot])
    assert len(ids) == 2000 and ids == sorted(ids)
    assert not glob.glob(f"{path}/species_file=*")


def test_exporting_no_rows(spark, tmp_path):
    path = str(tmp_path / "none")
    sinks.export_by_species(points(spark).limit(0), path)
    assert species_export.manifest(spark, path).count() == 0
    sinks.export_by_species(points(spark).limit(0), path, resume=True)


def test_csv_dialect(spark, tmp_path):
    data = [(1, 'say "hi", ok'), (2, ""), (3, None), (4, "  padded "), (5, "back\\slash")]
    df = spark.createDataFrame(data, "i int, s string")
    path = str(tmp_path / "csv")
    sinks.export_csv(df.coalesce(1).sort("i"), path)
    with open(glob.glob(f"{path}/*.csv")[0]) as f:
        assert f.read().splitlines() == [
            "i,s",
            '1,"say ""hi"", ok"',
            '2,""',
            "3,",
            "4,  padded ",
            "5,back\\slash",
        ]
    back = readers.read_csv(spark, path, "i int, s string", header=True)
    assert rows(back) == rows(df)


def test_free_text_comes_back_as_written(spark, tmp_path):
    texts = ["", None, "a\nb", 'a "b",\nc', "x\r\ny", " "]
    made = [(i, "Some_one", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(made, "taxonobservation_id long, species_nospace string, locality string")
    path = str(tmp_path / "species")
    sinks.export_by_species(df, path, columns=["*"])
    schema = "taxonobservation_id long, species_nospace string, locality string, species_file string"
    back = readers.read_csv(spark, path, schema, header=True, free_text=True)
    found = {r[0]: r[2] for r in back.collect()}
    assert len(found) == len(texts)
    assert found == dict(enumerate(texts))


def test_existing_output_is_refused(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.guard_output(spark, path)
    df = spark.range(3)
    sinks.export_csv(df, path)
    with pytest.raises(FileExistsError):
        sinks.guard_output(spark, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.export_csv(df, path)


def test_run_tables_in_folders_and_in_the_catalog(spark, tmp_path):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    for base in (str(tmp_path), "occ_tables"):
        if "/" not in base:
            sinks.ensure_schema(spark, base)
            sinks.ensure_schema(spark, base)
        sinks.save_run_table(df.limit(1), base, "t")
        stored = sinks.save_run_table(df, base, "t", cluster_by=["k", "id"])
        assert rows(stored) == rows(df)


def test_species_lists_and_checklists(spark, tmp_path):
    df = points(spark, hot=5, others=3)
    path = str(tmp_path / "list")
    sinks.export_species_list(df.filter("species_nospace is not null"), path)
    assert rows(readers.read_species_list(spark, path)) == [
        ("Cold_0",), ("Cold_1",), ("Cold_2",), ("Hot_one",),
    ]

    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    names = spark.createDataFrame([("A a",), ("B b",)], "species string")
    sinks.export_csv(names, good)
    assert rows(readers.read_checklist(spark, good)) == [("A a",), ("B b",)]
    sinks.export_csv(names.union(names), bad)
    with pytest.raises(ValueError):
        readers.read_checklist(spark, bad)


def test_checklist_extract(spark):
    df = spark.createDataFrame(
        [("B b", "species"), ("A a", "species"), ("A a", "species"), ("A a x", "variety")],
        "taxon string, taxon_rank string",
    )
    assert [r.species for r in readers.extract_checklist(df).collect()] == ["A a", "B b"]
