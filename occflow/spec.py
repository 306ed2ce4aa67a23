"""Parameters of one run."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occflow import constants as C
from occflow.functions import filters
from occflow.operators.limits import lowest

SELECTIONS: dict[str, Mapping[str, str]] = {
    "standard": C.STANDARD_COLUMNS,
    "unfiltered": C.UNFILTERED_COLUMNS,
    "validation": C.VALIDATION_COLUMNS,
}


@dataclass(frozen=True)
class RunSpec:
    """One named, parameterised run.

    ``quality`` and ``introduced`` name a preset of :mod:`occflow.functions.filters`
    or hold any SQL predicate over the occurrence columns. ``select`` names a
    preset selection or maps source columns to output columns.
    """

    run: str
    quality: str = "main"
    introduced: str = "native"
    select: str | Mapping[str, str] = "standard"
    limit: int | None = None
    save: bool = True
    missing_spp_run: bool = False
    prev_run: str | None = None

    def __post_init__(self) -> None:
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", self.run):
            raise ValueError(f"run code must be usable as a file name: {self.run!r}")
        if self.limit is not None and self.limit < 0:
            raise ValueError("limit must not be negative")
        if self.missing_spp_run and not self.prev_run:
            raise ValueError("a supplemental run needs prev_run")
        if isinstance(self.select, str) and self.select not in SELECTIONS:
            raise ValueError(f"unknown selection: {self.select!r}")

    @property
    def rmd_table(self) -> str:
        return f"range_model_data_raw_{self.run}"

    @property
    def rms_table(self) -> str:
        return f"range_model_species_{self.run}"

    @property
    def stats_table(self) -> str:
        return f"range_model_data_stats_{self.run}"

    @property
    def profile_table(self) -> str:
        return f"range_model_profile_{self.run}"

    @property
    def prev_rms_table(self) -> str | None:
        return f"range_model_species_{self.prev_run}" if self.prev_run else None

    @property
    def data_dir(self) -> str:
        return f"rm_data_{self.run}"

    @property
    def attributes_file(self) -> str:
        return f"range_model_species_attributes_{self.run}.csv"

    def columns(self) -> list[Column]:
        selection = SELECTIONS[self.select] if isinstance(self.select, str) else self.select
        return [F.col(src).alias(dst) for src, dst in selection.items()]

    def main_predicate(self) -> Column:
        """The filter without its native-status part."""
        return filters.predicate(self.quality, filters.QUALITY)

    def predicate(self) -> Column:
        return self.main_predicate() & filters.predicate(self.introduced, filters.INTRODUCED)

    def limited(self, df: DataFrame) -> DataFrame:
        """Cut to ``limit`` rows, lowest ids first so that a test run repeats."""
        if self.limit is None:
            return df
        return lowest(df, C.OBS_ID, self.limit)
