"""Runs of consecutive units (lines, sentences) that occur more than once.

Shared by the removal of repeated line windows and of repeated sentence spans.
Only hashes travel: two independent 64-bit hashes identify a run, so that different
runs don't meet even among 10 ** 12. A run held by a third of all documents is
counted with map-side combine. What joins back to its places is stored first: adaptive
execution splits the partition of a hot key only where both sides of a join are
shuffled for it, which the result of an aggregation is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import Stage
from .common import boxed


def unit_hashes(units: Column) -> list[Column]:
    """The arrays ``h1`` and ``h2`` that runs are made of."""
    return [
        F.transform(units, lambda x: F.xxhash64(x)).alias("h1"),
        F.transform(units, lambda x: F.xxhash64(F.lit(7), x)).alias("h2"),
    ]


def windows(docs: DataFrame, k: int) -> DataFrame:
    """From (doc, version, h1, h2): doc, version, place, units and the hashes a and b of every run of ``k`` units."""
    hashed = lambda name, i: F.xxhash64(*[F.col(name)[i + F.lit(j)] for j in range(k)])
    runs = F.transform(
        F.sequence(F.lit(0), F.size("h1") - k),
        lambda i: F.struct(i.alias("place"), F.lit(k).alias("units"), hashed("h1", i).alias("a"), hashed("h2", i).alias("b")),
    )
    nothing = F.array().cast("array<struct<place:int,units:int,a:bigint,b:bigint>>")
    return docs.select("doc", "version", F.inline(F.when(F.size("h1") >= k, runs).otherwise(nothing)))


def later_places(runs: DataFrame, stage: Stage) -> DataFrame:
    """From (doc, version, place, units, a, b): where a run of units is not the first of its kind.

    Runs are ordered by doc (null first), version and place. Rows equal in doc and
    version are one document. Returns doc, version and ``starts``, an array of (place,
    units).
    """
    runs = runs.select("a", "b", "units", F.struct("doc", "version", "place").alias("at"))
    first = (
        runs.groupBy("a", "b", "units")
        .agg(F.min("at").alias("first"), F.max("at").alias("last"))
        .where(F.col("last") > F.col("first"))
        .select("a", "b", "units", "first")
    )
    # Joined by sorting at every size: a small table would be broadcast, a larger one not, and
    # the plan would depend on the input.
    return (
        runs.join(stage.table(first, "first_runs").hint("merge"), ["a", "b", "units"])
        .where(F.col("at") > F.col("first"))
        .groupBy(F.col("at.doc").alias("doc"), F.col("at.version").alias("version"))
        .agg(F.collect_set(F.struct(F.col("at.place").alias("place"), "units")).alias("starts"))
    )


def kept_units(units: Column, starts: Column) -> Column:
    """``units`` without those that a run of ``starts`` covers, in order."""
    covered = F.flatten(F.transform(starts, lambda s: F.sequence(s["place"], s["place"] + s["units"] - 1)))
    kept = F.array_except(F.sequence(F.lit(0), F.size(units) - 1), covered)
    return F.transform(kept, lambda i: units[i])


def with_starts(docs: DataFrame, doc: str, text: str, starts: DataFrame, stage: Stage) -> DataFrame:
    """``row`` (all columns but the text), ``text`` and ``starts``, null where nothing repeats."""
    found = stage.table(starts, "starts").select(F.col("doc").alias("at"), F.col("version").alias("at_version"), "starts")
    left = boxed(docs, without=[text], doc=F.col(doc), version=F.xxhash64(text), text=F.col(text))
    on = F.col("doc").eqNullSafe(F.col("at")) & (F.col("version") == F.col("at_version"))
    return left.join(found.hint("merge"), on, "left").select("row", "text", "starts")
