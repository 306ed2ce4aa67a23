"""What the physical plans must look like for large inputs."""

import re

import pytest
from pyspark.sql import functions as F

from occflow import constants as C
from occflow.functions import derive
from occflow.operators import lookups, taxonomy
from occflow.plans import checks, runs
from occflow.sources import layout, sinks, species_export
from occflow.spec import RunSpec
from verification import fixtures, registry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scan_details(spark, df):
    """The formatted plan, which shows pushed filters and columns in full."""
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    """Set configuration for one test."""
    before = {}

    def apply(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield apply
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture(scope="module")
def occ(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("occ") / "occ")
    fixtures.occurrences(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def test_the_whole_filter_reaches_the_scan(spark, occ, settings):
    settings(spark__sql__maxMetadataStringLength="10000")
    text = scan_details(spark, runs.extract(occ, RunSpec("r")))
    pushed = re.search(r"PushedFilters: .*", text).group(0)
    for part in (
        "IsNotNull(scrubbed_species_binomial)",
        "In(higher_plant_group",
        "EqualTo(is_invalid_latlong,0)",
        "EqualTo(is_geovalid,1)",
        "Not(EqualTo(georef_protocol,county_centroid))",
        "EqualTo(is_centroid,0)",
        "IsNull(is_location_cultivated)",
        "EqualTo(is_cultivated_observation,0)",
        "In(observation_type",
        "GreaterThanOrEqual(event_date,1950-01-01)",
        "EqualTo(is_introduced,0)",
    ):
        assert part in pushed, part
    assert "Exchange" not in text


def test_generated_methods_are_small_enough_to_be_compiled(spark, occ, sf_dir, settings):
    """The JVM interprets methods above 8000 bytes of code, many times slower."""
    settings(spark__sql__adaptive__enabled="false")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    view = fixtures.occurrences(spark, sf_dir)
    for df in (
        runs.extract(occ, RunSpec("r")),
        runs.unfiltered_run(occ),
        runs.extract(view, RunSpec("r")),
        runs.unfiltered_run(view),
    ):
        text = df._jdf.queryExecution().explainString(mode)
        assert 0 < max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)) < 8000


def test_only_needed_columns_are_read(spark, occ, settings):
    settings(spark__sql__maxMetadataStringLength="10000")
    text = scan_details(spark, taxonomy.species_profile(runs.extract(occ, RunSpec("r"))))
    read = re.search(r"ReadSchema: .*", text).group(0)
    assert "scrubbed_species_binomial" in read
    for column in ("latitude", "country", "locality", "scrubbed_author"):
        assert column not in read


def test_observations_are_not_shuffled_to_drop_names(occ, stage):
    observations = stage.table(runs.extract(occ, RunSpec("r")), "observations")
    text = plan(runs.resolve_multistatus(observations, stage))
    assert "BroadcastHashJoin" in text and "LeftAnti" in text
    assert "hashpartitioning" not in text


def test_counts_combine_before_the_shuffle(occ):
    for df in (
        taxonomy.species_profile(runs.extract(occ, RunSpec("r"))),
        runs.native_status(occ, RunSpec("r")),
        checks.countries_in_no_checklist(occ),
        checks.null_rates_species(checks.filter_test_data(occ)),
    ):
        text = plan(df)
        lowest = text[text.rindex("Exchange") :]
        assert "HashAggregate" in lowest and "partial_" in lowest


def hot_observations(spark, rows=200_000):
    """A third of the rows belong to one species."""
    return spark.range(rows, numPartitions=8).select(
        F.col("id").alias("taxonobservation_id"),
        F.when(F.col("id") % 3 == 0, "Hot one")
        .otherwise(F.concat(F.lit("Cold "), (F.col("id") % 997).cast("string")))
        .alias(C.SPECIES),
        F.when(F.col("id") % 10 == 0, "Unresolved").otherwise("Accepted").alias(C.STATUS),
        F.lit("flowering plants").alias(C.GROUP),
        F.lit(1).alias(C.IS_VASC),
        F.rand(1).alias("latitude"),
        F.rand(2).alias("longitude"),
    ).transform(derive.with_species_nospace)


def _removal(observations, stage, spark):
    names = spark.createDataFrame([("Hot one", "Unresolved")], f"{C.SPECIES} string, {C.STATUS} string")
    return taxonomy.drop_names(observations, stage.table(names, "names")), 200_000 - 6_667


def _species_removal(observations, stage, spark):
    names = spark.createDataFrame([("Cold 1",)], f"{C.SPECIES} string")
    return lookups.drop_species(observations, stage.table(names, "names")), None


def _selection(observations, stage, spark):
    names = spark.createDataFrame([("Hot one",)], "s string")
    return checks.with_names(observations, stage.table(names, "names")), 66_667


def _attributes(observations, stage, spark):
    metadata = spark.createDataFrame(
        [("Hot one", "Accepted", "bryophytes")],
        f"{C.SPECIES} string, {C.STATUS} string, {C.GROUP} string",
    )
    return runs.update_attributes(observations, metadata, stage), 200_000


@pytest.mark.parametrize("build", [_removal, _species_removal, _selection, _attributes])
def test_a_hot_species_is_split_when_nothing_can_be_broadcast(spark, stage, settings, build):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="200KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
    )
    observations = stage.table(hot_observations(spark), "observations")
    df, expected = build(observations, stage, spark)
    text = final_plan(df)
    assert "SortMergeJoin" in text and "skew=true" in text
    if expected is not None:
        assert df.count() == expected


def test_a_hot_species_is_divided_on_export(spark, stage, monkeypatch):
    observations = stage.table(hot_observations(spark), "observations")
    monkeypatch.setattr(layout, "PART_WEIGHT", 1 << 19)
    export = species_export.Export(observations, sinks.POINT_COLUMNS)
    dealt = export.dealt(export.plan(stage.table))
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 200_000
    assert max(sizes) < 20_000


@pytest.mark.parametrize("build", [
    lambda observations, names: checks.species_counts(observations, names),
    lambda observations, names: runs.import_species(names.withColumnRenamed("species", "species_ul"), observations),
    lambda observations, names: taxonomy.distinct_taxa(
        observations, names.withColumnRenamed("species", "scrubbed_species_binomial")
    ),
])
def test_observations_are_reduced_before_a_list_of_names(spark, stage, settings, build):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    observations = stage.table(_described(hot_observations(spark)), "observations")
    names = stage.table(observations.select(F.col("scrubbed_species_binomial").alias("species")).distinct(), "names")
    text = build(observations, names)._jdf.queryExecution().optimizedPlan().toString()
    join, aggregate = text.index("Join LeftSemi"), text.index("Aggregate")
    assert join < aggregate  # the join stands above what reduces the rows


def _described(df):
    for name in ("scrubbed_family", "scrubbed_taxon_name_no_author", "scrubbed_author", "scrubbed_taxonomic_status", "higher_plant_group"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit("x"))
    return df


@pytest.mark.parametrize(
    "name", sorted(n for n in registry.QUERIES if n.startswith(("jn", "agg", "job", "stats", "val")))
)
def test_no_query_uses_python_rows_or_a_cross_join(spark, sf_dir, name, monkeypatch):
    """Plans only: what is staged or stored is the frame itself, and files are neither written nor read."""
    monkeypatch.setattr("occflow.sources.staging.Stage.table", lambda self, df, name: df)
    monkeypatch.setattr("occflow.sources.run_tables.save", lambda df, *a, **b: df)
    monkeypatch.setattr("occflow.sources.sinks.export_csv", lambda *a, **b: None)
    monkeypatch.setattr("occflow.sources.sinks.export_by_species", lambda *a, **b: None)
    empty = lambda spark, path, schema, *a, **b: spark.createDataFrame([], schema)
    monkeypatch.setattr("occflow.sources.readers.read_csv", empty)
    monkeypatch.setattr("occflow.sources.readers.csv_header", lambda spark, path: spark.createDataFrame([], "species string"))
    text = plan(registry.queries()[name](spark, sf_dir))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert banned not in text
