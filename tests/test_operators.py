from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows

from occflow import constants as C
from occflow.functions import derive
from occflow.operators import lookups, species, stats, status, taxonomy
from occflow.plans import checks, runs
from verification import fixtures

OBS = """scrubbed_species_binomial string, taxonomic_status string,
    higher_plant_group string, is_vasc int, taxonobservation_id long"""


def observations(spark, data):
    """Rows of (species, status, group)."""
    full = [(s, t, g, 0 if g == "bryophytes" else 1, i) for i, (s, t, g) in enumerate(data)]
    return spark.createDataFrame(full, OBS).transform(derive.with_species_nospace)


MULTI = [
    ("A a", "Accepted", "flowering plants"),
    ("A a", "Accepted", "bryophytes"),
    ("A a", "Unresolved", "flowering plants"),
    ("B b", "Accepted", "bryophytes"),
    ("B b", None, "bryophytes"),
    ("C c", "Unresolved", "bryophytes"),
    ("C c", "Synonym", "bryophytes"),
    ("D d", "Unresolved", "bryophytes"),
    ("D d", "Unresolved", "bryophytes"),
    ("E e", None, "bryophytes"),
]


def test_decade_is_a_text_rule(spark):
    dates = [date(1957, 1, 1), date(2024, 1, 1), date(987, 1, 1), None]
    df = spark.createDataFrame([(d,) for d in dates], "event_date date")
    out = df.transform(derive.with_event_year).transform(derive.with_decade).collect()
    assert [(r.event_year, r.decade) for r in out] == [
        (1957, 1950),
        (2024, 2020),
        (987, 9870),
        (None, None),
    ]


def test_vascular_flag_and_status(spark):
    df = spark.createDataFrame(
        [("bryophytes", "No opinion"), ("ferns and allies", None), (None, "Accepted")],
        "higher_plant_group string, taxonomic_status string",
    )
    out = df.transform(derive.with_is_vasc).transform(derive.normalize_status).collect()
    assert [(r.is_vasc, r.taxonomic_status) for r in out] == [
        (0, "Unresolved"),
        (1, None),
        (0, "Accepted"),
    ]


def test_names_with_and_without_spaces(spark):
    df = spark.createDataFrame([("Aus bus var. cus",)], "scrubbed_species_binomial string")
    out = derive.with_species_nospace(df)
    assert out.first().species_nospace == "Aus_bus_var._cus"
    back = derive.with_species_from_underscore(out, "species_nospace", "species")
    assert back.first().species == "Aus bus var. cus"


def test_region_flags(spark):
    df = spark.createDataFrame([("GLP",), ("CUB",), ("FRA",), (None,)], "iso_alpha3 string")
    flags = ["is_caribbean", "is_lesser_antilles", "is_french_westindies"]
    assert [tuple(r) for r in derive.flag_regions(df).select(*flags).collect()] == [
        (1, 1, 0), (1, 0, 0), (0, 0, 0), (0, 0, 0),
    ]
    fixed = derive.flag_regions(df, fix_french_west_indies=True)
    assert [r.is_french_westindies for r in fixed.collect()] == [1, 0, 0, 0]


def test_percent_rounds_half_up_and_fails_on_nothing(spark):
    df = spark.createDataFrame([(2, 3), (1, 400), (1, 1)], "n long, t long")
    out = df.select(derive.percent_of(F.col("n"), F.col("t")).alias("p")).collect()
    assert [r.p for r in out] == [Decimal("66.7"), Decimal("0.3"), Decimal("100.0")]
    empty = spark.createDataFrame([(0, 0)], "n long, t long")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        empty.select(derive.percent_of(F.col("n"), F.col("t"))).collect()


def test_a_null_status_counts_and_survives(spark, stage):
    obs = observations(spark, MULTI)
    assert rows(taxonomy.multistatus_species(obs)) == [("A a",), ("B b",), ("C c",)]
    resolved = runs.resolve_multistatus(obs, stage)
    assert rows(resolved, C.SPECIES, C.STATUS) == sorted(
        [
            ("A a", "Accepted"), ("A a", "Accepted"), ("B b", "Accepted"), ("B b", None),
            ("D d", "Unresolved"), ("D d", "Unresolved"), ("E e", None),
        ],
        key=repr,
    )


def test_resolving_twice_changes_nothing(spark, stage):
    once = stage.table(runs.resolve_multistatus(observations(spark, MULTI), stage), "once")
    twice = runs.resolve_multistatus(once, stage)
    assert rows(twice) == rows(once)
    assert twice.columns == once.columns


def test_statistics_from_the_profile(spark):
    obs = observations(spark, MULTI)
    profile = taxonomy.species_profile(obs)
    main = stats.main_stats(profile).collect()
    assert [tuple(r) for r in main] == [
        (1, C.BEFORE_MULTISTATUS, 10, 5, 8),
        (2, C.AFTER_MULTISTATUS, 7, 4, 5),
        (3, C.DIFFERENCE, 3, 1, 3),
    ]
    counted = stats.counts_row(C.BEFORE_MULTISTATUS, obs, taxonomy.species_status(obs))
    assert tuple(counted.first()) == tuple(main[0])
    both = spark.createDataFrame(main[:2], stats.main_stats(profile).schema)
    assert tuple(stats.difference_row(both).first()) == tuple(main[2])


def test_statistics_of_nothing(spark):
    empty = taxonomy.species_profile(observations(spark, MULTI).limit(0))
    assert [tuple(r)[2:] for r in stats.main_stats(empty).collect()] == [(0, 0, 0)] * 3


def test_clearing_labels_is_case_sensitive(spark):
    labels = [C.SHARED_SPECIES, C.AFTER_SHARED, C.CHECKLIST_SPECIES, C.DIFFERENCE]
    df = spark.createDataFrame([(p,) for p in labels], "period string")
    assert [r.period for r in stats.clear_stats(df, "shared").collect()] == [
        C.SHARED_SPECIES,
        C.CHECKLIST_SPECIES,
        C.DIFFERENCE,
    ]


def growth_forms(spark, data):
    return spark.createDataFrame(data, "species string, family string, gf string")


def test_species_table_takes_the_first_group_of_a_species(spark):
    profile = taxonomy.species_profile(observations(spark, MULTI))
    forms = growth_forms(spark, [("A a", "Fam", "tree"), ("A a", None, "herb")])
    out = species.species_table(profile, forms)
    assert out.columns == [*species.COLUMNS, "obs"]
    got = rows(out.filter("scrubbed_species_binomial = 'A a'"))
    assert got == [
        ("A a", "A_a", "Accepted", "bryophytes", 0, "Fam", "tree", 2),
        ("A a", "A_a", "Unresolved", "bryophytes", 0, "Fam", "tree", 1),
    ]
    assert out.count() == 8


def test_update_assigns_nulls_to_matches_and_keeps_the_rest(spark):
    target = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "id int, flag int")
    lookup = spark.createDataFrame([(1, None), (2, 0), (None, 5)], "k int, v int")
    out = lookups.update_from(target, lookup, "id", "k", {"flag": "v", "extra": "v"})
    assert rows(out) == [(1, None, None), (2, 0, 0), (3, 1, None)]


def test_update_never_multiplies_rows(spark):
    target = spark.createDataFrame([(1,), (1,)], "id int")
    lookup = spark.createDataFrame([(1, "b"), (1, "a"), (1, None)], "k int, v string")
    assert rows(lookups.update_from(target, lookup, "id", "k", {"v": "v"})) == [(1, "a")] * 2


def test_first_values_put_nulls_last(spark):
    df = spark.createDataFrame(
        [("x", None, "z"), ("x", "b", None), ("x", "b", "c"), ("y", None, None)],
        "k string, a string, b string",
    )
    assert rows(lookups.first_per_key(df, "k", ["a", "b"])) == [("x", "b", "c"), ("y", None, None)]


def test_joined_sets_skip_nulls(spark):
    df = spark.createDataFrame(
        [
            ("A a", 1, "I"), ("A a", 0, "N"), ("A a", 0, "N"), ("A a", None, None),
            ("B b", None, None), (None, 1, "I"),
        ],
        "scrubbed_species_binomial string, is_introduced int, native_status string",
    )
    out = status.native_status_table(df)
    assert rows(out) == [("A a", "0,1", "I,N", 4), ("B b", None, None, 1)]


def test_checklist_flag_defaults_to_listed(spark):
    names = spark.createDataFrame(
        [("A a",), ("B b",), ("C c",), ("absent",)], "scrubbed_species_binomial string"
    )
    statuses = spark.createDataFrame(
        [("A a", "A,UNK"), ("B b", None), ("C c", "A,I")],
        "scrubbed_species_binomial string, native_status string",
    )
    assert rows(status.flag_not_unlisted(names, statuses)) == [
        ("A a", 0),
        ("B b", 0),
        ("C c", 1),
        ("absent", 1),
    ]


def test_overlap_is_gone_after_removal(spark):
    rows2 = spark.createDataFrame(
        [("A a", 3), ("A a", 1), ("B b", 2)], "scrubbed_species_binomial string, obs long"
    )
    previous = spark.createDataFrame([("A a",), ("Z z",)], "scrubbed_species_binomial string")
    assert [tuple(r)[1:4] for r in checks.overlap(rows2, previous).collect()] == [
        (C.OVERLAP_BEFORE, None, 2),
        (C.OVERLAP_BEFORE_FILTER, 6, 3),
        (C.OVERLAP_AFTER, None, 0),
        (C.AFTER_SHARED, 2, 1),
    ]


def test_null_rates_of_species(spark):
    df = spark.createDataFrame(
        [("A a", None, date(2000, 1, 1)), ("A a", 0, None), ("B b", 0, date(2000, 1, 1))],
        "scrubbed_species_binomial string, is_introduced int, event_date date",
    )
    assert rows(checks.null_rates_species(df)) == [
        ("event_date_null", 1, Decimal("50.0")),
        ("is_introduced_null", 1, Decimal("50.0")),
        ("total_spp", 2, Decimal("100.0")),
    ]


def test_conflicting_taxa_ignore_author_spelling(spark):
    df = spark.createDataFrame(
        [
            ("F", "A a", "A a", "L.", "Accepted"),
            ("F", "A a", "A a", "Linn.", "Accepted"),
            ("F", "B b", "B b", "L.", "Accepted"),
            ("F", "B b", "B b", "L.", "Synonym"),
            ("F", "B b", "B b var. x", "L.", None),
        ],
        """scrubbed_family string, scrubbed_species_binomial string,
        scrubbed_taxon_name_no_author string, scrubbed_author string,
        scrubbed_taxonomic_status string""",
    )
    assert [r[1] for r in rows(taxonomy.conflicting_taxa(df))] == ["B b"] * 3


def test_flagging_run_keeps_defaults_where_nothing_matches(spark, stage):
    raw = spark.createDataFrame(
        [(1, "A a", 1.0), (2, "A a", 1.0), (3, "B b", 1.0)],
        "taxonobservation_id long, scrubbed_species_binomial string, latitude double",
    )
    metadata = spark.createDataFrame(
        [("A a", "Accepted", "flowering plants"), ("C c", "Accepted", "bryophytes")],
        "scrubbed_species_binomial string, taxonomic_status string, higher_plant_group string",
    )
    occ = spark.createDataFrame(
        [(1, "A a", "N", 0), (2, "other", "N", 0), (3, "B b", None, None)],
        """taxonobservation_id long, scrubbed_species_binomial string,
        native_status string, is_introduced int""",
    )
    result = runs.flagging_run(raw, metadata, occ, "x", stage)
    # Id 2 belongs to a species that raw does not have, so it counts as unmatched.
    assert rows(
        result.observations,
        C.OBS_ID, C.STATUS, C.IS_VASC, "native_status", "is_introduced", "is_range_model_ob_x",
    ) == [
        (1, "Accepted", 1, "N", 0, 1),
        (2, "Accepted", 1, None, 1, 0),
        (3, None, 0, None, None, 0),
    ]
    assert rows(result.metadata, C.SPECIES, C.IS_VASC, "is_range_model_species_x") == [
        ("A a", 1, 1),
        ("C c", 0, 0),
    ]


def test_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert lookups.has_duplicates(df, ["k"], "d").first().d is True
    assert lookups.has_duplicates(df.distinct(), ["k"], "d").first().d is False


def test_updates_by_id_keep_the_row_count(spark, sf_dir, stage):
    """The ids of the smallest test tables repeat."""

    occ = fixtures.occurrences(spark, sf_dir)
    raw = stage.table(runs.unfiltered_run(occ), "raw")
    assert raw.select("taxonobservation_id").distinct().count() < raw.count()
    assert checks.backfill_dates(raw, occ).count() == raw.count()
    metadata = fixtures.lookup(spark, sf_dir, "range_model_data_metadata")
    assert runs.flagging_run(raw, metadata, occ, "x", stage).observations.count() == raw.count()


def test_undated_share_of_any_size(spark):
    data = spark.range(12_000_000).select(
        F.lit(None).cast("date").alias("event_date"), F.lit("plot").alias("observation_type")
    )
    assert float(checks.undated_by_type(data).first()["prop_rows"]) == 100.0
    assert float(checks.undated_by_type(data, 1_000_000).first()["prop_rows"]) == 1200.0
