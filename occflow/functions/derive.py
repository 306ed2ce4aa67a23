"""Derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occflow import constants as C


def with_species_nospace(df: DataFrame, source: str = C.SPECIES, target: str = C.NOSPACE) -> DataFrame:
    return df.withColumn(target, F.replace(F.col(source), F.lit(" "), F.lit("_")))


def with_species_from_underscore(
    df: DataFrame, source: str = "species_ul", target: str = "species"
) -> DataFrame:
    return df.withColumn(target, F.replace(F.col(source), F.lit("_"), F.lit(" ")))


def with_event_year(df: DataFrame) -> DataFrame:
    return df.withColumn("event_year", F.year("event_date"))


def decade_of(year: Column) -> Column:
    """First three digits of the year, then 0. A text rule: 987 gives 9870."""
    return F.concat(F.substring(year.cast("string"), 1, 3), F.lit("0")).cast("int")


def with_decade(df: DataFrame) -> DataFrame:
    return df.withColumn("decade", decade_of(F.col("event_year")))


def with_is_vasc(df: DataFrame) -> DataFrame:
    vascular = F.col(C.GROUP).isin(C.VASCULAR_GROUPS)
    return df.withColumn(C.IS_VASC, F.when(vascular, 1).otherwise(0))


def normalize_status(df: DataFrame) -> DataFrame:
    status = F.col(C.STATUS)
    return df.withColumn(C.STATUS, F.when(status == C.NO_OPINION, C.UNRESOLVED).otherwise(status))


# Each step with the column it needs.
RUN_STEPS = (
    (with_species_nospace, C.SPECIES),
    (with_is_vasc, C.GROUP),
    (with_event_year, "event_date"),
    (with_decade, "event_year"),
    (normalize_status, C.STATUS),
)


def with_run_columns(df: DataFrame) -> DataFrame:
    """The derived columns of an extract, as far as its selection holds what they come from."""
    for step, needed in RUN_STEPS:
        if needed in df.columns:
            df = df.transform(step)
    return df


def with_obs_introduced(df: DataFrame) -> DataFrame:
    """Introduced observations of modelled species; common species count none."""
    modelled = F.col("is_modelled") == 1
    return df.withColumn(
        "obs_introduced",
        F.when(modelled & (F.col("filter_group") == "common"), 0).when(
            modelled, F.col("obs_rare") - F.col("obs_rare_native")
        ),
    )


def with_obs_total(df: DataFrame) -> DataFrame:
    group = F.col("filter_group")
    return df.withColumn(
        "obs_total",
        F.when(group == "common", F.col("obs_common")).when(
            group == "rare", F.col("obs_rare")
        ),
    )


def flag_regions(country: DataFrame, fix_french_west_indies: bool = False) -> DataFrame:
    """Caribbean flags from ISO codes.

    The established tables never fill ``is_french_westindies``: its rule sets the
    Lesser Antilles flag a second time. The default keeps those results.
    """
    iso = F.col("iso_alpha3")

    def flag(codes: list[str]) -> Column:
        return F.when(iso.isin(codes), 1).otherwise(0)

    french = flag(C.FRENCH_WEST_INDIES) if fix_french_west_indies else F.lit(0)
    return (
        country.withColumn("is_caribbean", flag(C.CARIBBEAN))
        .withColumn("is_lesser_antilles", flag(C.LESSER_ANTILLES + C.FRENCH_WEST_INDIES))
        .withColumn("is_french_westindies", french)
    )


def percent_of(part: Column, whole: Column, kind: str = "decimal(4,1)") -> Column:
    """Share in percent with one decimal, rounded half up. Fails when ``whole`` is 0."""
    ratio = part.cast("decimal(20,0)") / whole.cast("decimal(20,0)")
    return (ratio * F.lit(100).cast("decimal(3,0)")).cast(kind)
