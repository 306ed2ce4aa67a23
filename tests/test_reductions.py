"""What keeps rows out of shuffles and scans, and limits and statistics of stored tables."""

import uuid

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows

from occflow import constants as C
from occflow.operators import limits, lookups, stats
from occflow.plans import checks, runs
from occflow.sources import readers, sinks
from occflow.spec import RunSpec


@pytest.fixture
def settings(spark):
    before = {}

    def apply(values):
        for key, value in values.items():
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield apply
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def occurrences(spark, n=120_000, species=400):
    return spark.range(n, numPartitions=4).select(
        F.col("id").alias(C.OBS_ID),
        F.when(F.col("id") % 100 == 0, None).otherwise(F.concat(F.lit("Some "), (F.col("id") * 7 % species).cast("string"))).alias(C.SPECIES),
        F.date_add(F.lit("1990-01-01").cast("date"), (F.col("id") % 9000).cast("int")).alias("event_date"),
        F.lit("X").alias("continent"),
        F.lit("Y").alias("country"),
        F.lit("here").alias("locality"),
        F.lit(1.0).alias("latitude"),
        F.lit(2.0).alias("longitude"),
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def scanned(df):
    """Rows that a plan without a shuffle has read."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(k).metrics().get("numOutputRows").get().value() for k in range(leaves.size()))


def test_occurrences_are_cut_to_what_raw_can_hold(spark, stage):
    occ = stage.table(occurrences(spark), "occ")
    raw = occ.where(f"{C.OBS_ID} between 2000 and 4000 and ({C.SPECIES} like 'Some 1%' or {C.SPECIES} is null)").drop("event_date")
    near = lookups.alike(occ.select(C.OBS_ID, C.SPECIES, "event_date"), raw, stage)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThanOrEqual({C.OBS_ID},2000)" in plan
    assert near.count() == raw.count() < 1000
    dated = checks.backfill_dates(raw, occ, stage)
    expected = raw.join(occ.select(C.OBS_ID, "event_date"), C.OBS_ID)
    assert rows(dated, C.OBS_ID, "event_date") == rows(expected, C.OBS_ID, "event_date")
    assert checks.backfill_dates(raw.where("false"), occ, stage).count() == 0


def test_a_bloom_filter_of_ids_stands_below_the_exchange(spark, stage, settings):
    occ, raw = (stage.table(occurrences(spark, n), n_) for n, n_ in ((120_000, "occ"), (30_000, "raw")))
    settings(
        {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
        }
    )
    found = checks.prefixed_localities(raw, occ, ["Some 11"], "X")
    plan = final_plan(found)
    assert "might_contain" in plan
    # Between the exchange by id and the filter there is nothing but columns.
    above = plan[: plan.index("might_contain")].split("\n")
    nearest = max(k for k, text in enumerate(above) if "Exchange hashpartitioning" in text)
    assert not any("Join" in text for text in above[nearest:])
    assert plan.count("StartsWith") >= 2
    assert found.count() == raw.where(f"{C.SPECIES} like 'Some 11%'").count()


def test_tables_in_buckets_join_by_id_without_a_shuffle(spark, settings):
    base = f"occ_buckets_{uuid.uuid4().hex[:6]}"
    sinks.ensure_schema(spark, base)
    occ = sinks.save_run_table(occurrences(spark), base, "occ", buckets=(C.OBS_ID, 8))
    raw = sinks.save_run_table(occurrences(spark, 60_000).drop("event_date"), base, "raw", buckets=(C.OBS_ID, 8))
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    joined = lookups.update_from(raw, occ.select(C.OBS_ID, "event_date"), C.OBS_ID, C.OBS_ID, {"event_date": "event_date"})
    assert "Exchange" not in final_plan(joined)
    assert joined.where("event_date is not null").count() == 60_000
    # A new version keeps its buckets.
    sinks.save_run_table(readers.read_table(spark, f"{base}.raw"), base, "raw", buckets=(C.OBS_ID, 8))
    again = lookups.update_from(spark.table(f"{base}.raw"), occ.select(C.OBS_ID, "event_date"), C.OBS_ID, C.OBS_ID, {"event_date": "event_date"})
    assert "Exchange" not in final_plan(again)
    with pytest.raises(ValueError):
        sinks.save_run_table(occ, "/tmp/nowhere", "t", buckets=(C.OBS_ID, 8))


def test_a_name_query_reads_a_fraction_of_a_stored_run(spark, tmp_path):
    made = occurrences(spark, 300_000)
    plain = sinks.save_run_table(made, str(tmp_path), "plain")
    stored = sinks.save_run_table(made, str(tmp_path), "clustered", cluster_by=(C.SPECIES, C.OBS_ID), bloom=(C.OBS_ID,))
    one = F.col(C.SPECIES) == "Some 119"
    assert stored.where(one).count() == plain.where(one).count() > 0
    assert scanned(stored.where(one).select("latitude")) < 0.3 * 300_000
    assert scanned(plain.where(one).select("latitude")) == 300_000
    assert stored.where(F.col(C.OBS_ID) == 77_777).count() == 1


def test_observations_of_a_run_are_stored_by_species(spark, tmp_path):
    made = occurrences(spark, 20_000)
    run = runs.Run(made, spark.range(1), spark.range(1))
    stored = runs.save_run(run, str(tmp_path), RunSpec("r"))
    assert sinks.OBSERVATIONS.cluster_by == (C.SPECIES, C.OBS_ID)
    files = stored.rmd.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.min(C.SPECIES).alias("low"), F.max(C.SPECIES).alias("high")).orderBy("f").collect()
    assert all(a["high"] <= b["low"] for a, b in zip(files, files[1:]))


@pytest.mark.parametrize("n", [0, 1, 7, 100, 499, 500, 501, 540, 541, 10_000])
def test_lowest_rows_of_any_number(spark, n):
    ids = [None] * 41 + [k * k * 10**12 - 5 for k in range(250)] + [3] * 100 + list(range(-150, 0))
    df = spark.createDataFrame([(i, str(k)) for k, i in enumerate(ids)], "id long, x string")
    expected = sorted(ids, key=lambda i: (i is None, i or 0))[:n]
    for merged in (-1, 100_000):
        assert [r["id"] for r in limits.lowest(df, "id", n, merged=merged).collect()] == expected


def test_a_large_limit_has_no_stage_of_one_task(spark, stage):
    df = stage.table(occurrences(spark), "occ")
    plan = limits.lowest(df, C.OBS_ID, 50_000, merged=1000)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan
    assert f"LessThan({C.OBS_ID}," in plan
    assert plan.count("GlobalLimit") <= 1  # of the rows that share the last key


def test_statistics_are_appended_once(spark, tmp_path):
    base, spec = str(tmp_path), RunSpec("r")
    kind = "id int, period string, obs long, species long, species_table_rows long"
    main = spark.createDataFrame([(1, "Before", 5, 2, 2), (2, "After", 4, 2, 2), (3, "Difference", 1, 0, 0)], kind)
    more = spark.createDataFrame([(4, "shared a", 1, 1, 1), (5, "shared b", 1, 1, 1), (6, "NSR a", 1, 1, 1), (7, "NSR b", None, 1, 1)], kind)
    runs.append_run_stats(main, base, spec)
    for _ in range(2):
        stored = runs.append_run_stats(more, base, spec)
    assert stored.count() == 7
    changed = runs.append_run_stats(more.withColumn("obs", F.lit(9).cast("long")), base, spec)
    assert sorted(r["obs"] for r in changed.collect()) == [1, 4, 5, 9, 9, 9, 9]
    assert runs.clear_run_stats(spark, "NSR", base, spec).count() == 5
    assert readers.read_table(spark, f"{base}/{spec.stats_table}").count() == 5
    assert stats.append_stats(main, main).count() == 3


def test_bits_of_ids_cut_occurrences_below_their_joins(spark, stage, settings):
    made = occurrences(spark, 40_000)
    raw = stage.table(made.where(f"{C.OBS_ID} % 7 = 0").drop("event_date"), "raw")
    side = stage.table(spark.range(40_000).selectExpr("id AS other", "'x' AS more"), "side")
    occ = stage.table(made, "occ").join(side, F.col(C.OBS_ID) == F.col("other")).select(C.OBS_ID, C.SPECIES, "event_date", "more")
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    near = lookups.alike(occ, raw, stage)
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    joins, bits = ([k for k, text in enumerate(plan.split("\n")) if word in text] for word in ("Join Inner", "getbit"))
    assert joins and bits and min(bits) > min(joins)
    ids = raw.select(C.OBS_ID)
    assert near.join(ids, C.OBS_ID, "left_semi").count() == occ.join(ids, C.OBS_ID, "left_semi").count() == raw.count()
    # Of the others a few pass.
    cut = occ.where(lookups.may_be_among(F.col(C.OBS_ID), ids, raw.count()))
    assert raw.count() <= cut.count() < raw.count() + 40_000 / 5


def test_bits_lose_no_key(spark):
    keys = spark.sql("SELECT explode(array(-9223372036854775808L, 9223372036854775807L, -1L, 0L, 0L, null)) AS k").where("k is not null")
    values = keys.union(spark.range(1, 3000))
    for count in (1, 10**5):
        found = [r[0] for r in values.where(lookups.may_be_among(F.col("k"), keys, count)).collect()]
        assert {r[0] for r in keys.collect()} <= set(found) and len(found) < 400


def test_native_status_by_id_with_repeated_and_foreign_ids(spark, stage):
    raw = spark.createDataFrame([(1, "A"), (2, "A"), (2, "B"), (3, None), (None, "A"), (5, "B")], f"{C.OBS_ID} long, {C.SPECIES} string")
    occ = spark.createDataFrame(
        [(1, "Z", "N", 0), (1, "B", "Ne", 1), (2, "A", None, 0), (2, "A", "I", 1), (3, None, "N", 0), (None, "A", "N", 0), (5, "Z", "N", 0), (9, "A", "N", 0)],
        f"{C.OBS_ID} long, {C.SPECIES} string, native_status string, is_introduced int",
    )
    for kind in ("long", "int"):
        target = raw.withColumn(C.OBS_ID, F.col(C.OBS_ID).cast(kind)).withColumn("native_status", F.lit("old")).withColumn("is_introduced", F.lit(7))
        out = runs.update_native_status(stage.table(target, "raw"), stage.table(occ, "occ"), stage)
        assert rows(out) == sorted(
            [(1, "A", "Ne", 1), (2, "A", "I", 1), (2, "B", "I", 1), (3, None, "N", 0), (None, "A", "old", 7), (5, "B", "old", 7)], key=repr
        )
