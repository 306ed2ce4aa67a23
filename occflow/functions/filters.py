"""Predicates over occurrence columns.

Each returns a plain Column, so Catalyst splits the conjunction and pushes
every part that the scan can evaluate into Parquet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from occflow import constants as C


def has_species() -> Column:
    return F.col(C.SPECIES).isNotNull()


def in_plant_group() -> Column:
    return F.col(C.GROUP).isin(C.PLANT_GROUPS)


def valid_coordinates() -> Column:
    return F.col("is_invalid_latlong") == 0


def valid_political_division() -> Column:
    return F.col("is_geovalid") == 1


def not_county_centroid() -> Column:
    protocol = F.col("georef_protocol")
    return protocol.isNull() | (protocol != C.EXCLUDED_GEOREF_PROTOCOL)


def not_centroid() -> Column:
    return F.col("is_centroid").isNull() | (F.col("is_centroid") == 0)


def location_not_cultivated() -> Column:
    """Only an absent value passes: a stored 0 is rejected as well."""
    return F.col("is_location_cultivated").isNull()


def observation_not_cultivated() -> Column:
    cultivated = F.col("is_cultivated_observation")
    return (cultivated == 0) | cultivated.isNull()


def in_observation_types() -> Column:
    return F.col("observation_type").isin(C.OBSERVATION_TYPES)


def _recent() -> Column:
    # Compares the date itself: a function of it could not be pushed to the scan.
    return F.col("event_date") >= F.lit(C.FIRST_YEAR_START).cast("date")


def recent_or_undated() -> Column:
    return _recent() | F.col("event_date").isNull()


def recent_dated() -> Column:
    return _recent()


def recent_or_undated_nonspecimen() -> Column:
    """Undated rows pass unless they are specimens."""
    undated = F.col("event_date").isNull() & (F.col("observation_type") != "specimen")
    return _recent() | undated


def all_of(parts: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts)


def quality_filter(date_rule: Callable[[], Column] = recent_or_undated) -> Column:
    return all_of(
        [
            has_species(),
            in_plant_group(),
            valid_coordinates(),
            valid_political_division(),
            not_county_centroid(),
            not_centroid(),
            location_not_cultivated(),
            observation_not_cultivated(),
            in_observation_types(),
            date_rule(),
        ]
    )


def everything() -> Column:
    return F.lit(True)


def native() -> Column:
    return F.col("is_introduced") == 0


def native_or_unknown() -> Column:
    return (F.col("is_introduced") == 0) | F.col("is_introduced").isNull()


def unknown_status() -> Column:
    status = F.col("native_status")
    return status.isin(C.UNKNOWN_STATUSES) | status.isNull()


def introduced() -> Column:
    return F.col("is_introduced") == 1


def accepted_native() -> Column:
    return (F.col(C.STATUS) == C.ACCEPTED) & (F.col("is_introduced") == 0)


def in_no_checklist(status_set: Column) -> Column:
    """Whether a species' joined native-status set shows that no checklist has it."""
    return status_set.isin(C.UNLISTED_STATUS_SETS) | status_set.isNull()


def any_prefix(column: Column, prefixes: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [column.startswith(p) for p in prefixes])


def taxon_is_species() -> Column:
    return F.col(C.SPECIES) == F.col("scrubbed_taxon_name_no_author")


def known_country_unknown_status() -> Column:
    return F.col("country").isNotNull() & (F.col("native_status") == "UNK")


QUALITY: Mapping[str, Callable[[], Column]] = {
    "main": quality_filter,
    "strict_date": lambda: quality_filter(recent_dated),
    "dated_specimen": lambda: quality_filter(recent_or_undated_nonspecimen),
    "none": everything,
}

INTRODUCED: Mapping[str, Callable[[], Column]] = {
    "native": native,
    "native_or_unknown": native_or_unknown,
    "unknown_status": unknown_status,
    "introduced": introduced,
    "any": everything,
}


def predicate(name: str, presets: Mapping[str, Callable[[], Column]]) -> Column:
    """A preset by name, or else the text as a SQL predicate."""
    return presets[name]() if name in presets else F.expr(name)
