"""Run statistics: a few labelled counts per step.

Counts are 64 bit, as a large run has more rows than a 32-bit integer holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occflow import constants as C
from occflow.operators.taxonomy import mark_dropped

COLUMNS = ["id", "period", "obs", "species", "species_table_rows"]

Row = tuple[str, Column | None, Column | None, Column | None]


def _rows(totals: DataFrame, rows: Sequence[Row], first_id: int = 1) -> DataFrame:
    """Turn one row of totals into labelled rows of (label, obs, species, table rows)."""

    def long(value: Column | None) -> Column:
        return (F.lit(None) if value is None else value).cast("bigint")

    structs = [
        F.struct(
            F.lit(first_id + i).alias("id"),
            F.lit(label).alias("period"),
            long(obs).alias("obs"),
            long(species).alias("species"),
            long(table_rows).alias("species_table_rows"),
        )
        for i, (label, obs, species, table_rows) in enumerate(rows)
    ]
    return totals.select(F.inline(F.array(*structs)))


def _one_row(left: DataFrame, right: DataFrame) -> DataFrame:
    """Put the columns of two one-row frames side by side."""
    both = left.unionByName(right, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def _total(column: str, where: Column | None = None) -> Column:
    value = F.col(column) if where is None else F.when(where, F.col(column))
    return F.coalesce(F.sum(value), F.lit(0))


def _count(where: Column) -> Column:
    return F.count(F.when(where, F.lit(1)))


def counts_row(label: str, observations: DataFrame, species: DataFrame, row_id: int = 1) -> DataFrame:
    """Row of total observations, rows of the species table, and distinct species."""
    obs = observations.agg(F.count(F.lit(1)).alias("obs"))
    table = species.agg(
        F.count(F.lit(1)).alias("table_rows"), F.count_distinct(C.SPECIES).alias("species")
    )
    return _rows(
        _one_row(obs, table),
        [(label, F.col("obs"), F.col("species"), F.col("table_rows"))],
        row_id,
    )


def difference_row(stats: DataFrame, row_id: int = 3) -> DataFrame:
    """Before minus after, for each measure."""

    def change(measure: str) -> Column:
        def at(label: str) -> Column:
            return F.max(F.when(F.col("period") == label, F.col(measure)))

        return at(C.BEFORE_MULTISTATUS) - at(C.AFTER_MULTISTATUS)

    totals = stats.agg(*[change(m).alias(m) for m in ("obs", "species", "species_table_rows")])
    return _rows(
        totals,
        [(C.DIFFERENCE, F.col("obs"), F.col("species"), F.col("species_table_rows"))],
        row_id,
    )


def main_stats(profile: DataFrame) -> DataFrame:
    """Counts before and after the removal of conflicting names, from the profile alone."""
    names = (
        mark_dropped(profile)
        .groupBy(C.SPECIES, C.NOSPACE, C.STATUS, "is_dropped")
        .agg(F.sum("obs").alias("obs"))
    )
    kept = ~F.col("is_dropped")
    per_species = names.groupBy(C.SPECIES).agg(
        F.sum("obs").alias("obs"),
        F.count(F.lit(1)).alias("names"),
        _total("obs", kept).alias("kept_obs"),
        _count(kept).alias("kept_names"),
    )
    totals = per_species.agg(
        _total("obs").alias("b_obs"),
        _total("names").alias("b_rows"),
        F.count(C.SPECIES).alias("b_species"),
        _total("kept_obs").alias("a_obs"),
        _total("kept_names").alias("a_rows"),
        _count((F.col("kept_names") > 0) & F.col(C.SPECIES).isNotNull()).alias("a_species"),
    )
    b = [F.col("b_obs"), F.col("b_species"), F.col("b_rows")]
    a = [F.col("a_obs"), F.col("a_species"), F.col("a_rows")]
    return _rows(
        totals,
        [
            (C.BEFORE_MULTISTATUS, *b),
            (C.AFTER_MULTISTATUS, *a),
            (C.DIFFERENCE, *[x - y for x, y in zip(b, a)]),
        ],
    )


def supplemental_rows(species: DataFrame) -> DataFrame:
    """Rows 4 to 7 from species rows with ``obs``, ``is_in_run1`` and ``is_in_nsr``.

    Species are counted as rows of the species table, so one with two statuses
    counts twice.
    """
    shared = F.col("is_in_run1") == 1
    listed = ~shared & (F.col("is_in_nsr") == 1)
    final = ~shared & (F.col("is_in_nsr") == 0)
    totals = species.agg(
        _count(shared).alias("shared"),
        _total("obs", ~shared).alias("unshared_obs"),
        _count(~shared).alias("unshared"),
        _count(listed).alias("listed"),
        _total("obs", final).alias("final_obs"),
        _count(final).alias("final"),
    )
    return _rows(
        totals,
        [
            (C.SHARED_SPECIES, None, F.col("shared"), None),
            (C.AFTER_SHARED, F.col("unshared_obs"), F.col("unshared"), None),
            (C.CHECKLIST_SPECIES, None, F.col("listed"), None),
            (C.AFTER_CHECKLIST, F.col("final_obs"), F.col("final"), None),
        ],
        first_id=4,
    )


def overlap_rows(species: DataFrame, reflagged: DataFrame) -> DataFrame:
    """Four counts around the removal of shared species, from species rows with ``obs``.

    ``reflagged`` holds the remaining rows, compared again with the earlier run.
    """
    shared = F.col("is_in_run1") == 1
    before = species.agg(
        _count(shared).alias("shared"), _total("obs").alias("obs"), F.count(F.lit(1)).alias("rows")
    )
    after = reflagged.agg(
        _count(shared).alias("a_shared"),
        _total("obs").alias("a_obs"),
        F.count(F.lit(1)).alias("a_rows"),
    )
    return _rows(
        _one_row(before, after),
        [
            (C.OVERLAP_BEFORE, None, F.col("shared"), None),
            (C.OVERLAP_BEFORE_FILTER, F.col("obs"), F.col("rows"), None),
            (C.OVERLAP_AFTER, None, F.col("a_shared"), None),
            (C.AFTER_SHARED, F.col("a_obs"), F.col("a_rows"), None),
        ],
    )


def append_stats(stats: DataFrame, rows: DataFrame) -> DataFrame:
    """``stats`` with ``rows``, in place of rows that have the same id and label: appending twice changes nothing."""
    same = [stats[c].eqNullSafe(rows[c]) for c in ("id", "period")]
    return stats.join(rows.select("id", "period"), same, "left_anti").unionByName(rows)


def clear_stats(stats: DataFrame, text: str) -> DataFrame:
    """Drop the rows whose label contains ``text``, case-sensitively."""
    return stats.filter(~F.col("period").contains(text))
