"""The lowest rows by a key, of any number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Up to so many rows each task keeps its own lowest ones and one task merges them.
MERGED = 100_000
BINS = 4096


def lowest(df: DataFrame, key: str, rows: int, merged: int = MERGED) -> DataFrame:
    """The ``rows`` rows of ``df`` with the lowest integer ``key``, nulls last, in order.

    More than ``merged`` rows don't pass through one task: the exact key up to which rows
    are taken is found first, and the rows below it are filtered and sorted like any
    others. Of rows that share the last key, as many as are needed are taken.
    """
    ascending = F.col(key).asc_nulls_last()
    if rows <= merged:
        return df.orderBy(ascending).limit(rows)
    ends = df.agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count(key).alias("known"), F.count(F.lit(1)).alias("all")
    ).first()
    if ends["all"] <= rows:
        return df.orderBy(ascending)
    if ends["known"] <= rows:
        known, rest = df.where(F.col(key).isNotNull()), df.where(F.col(key).isNull())
        return known.unionByName(rest.limit(rows - ends["known"])).orderBy(ascending)
    last, below = _last_key(df.select(key), key, rows, ends["low"], ends["high"])
    return df.where(F.col(key) < last).unionByName(df.where(F.col(key) == last).limit(rows - below)).orderBy(ascending)


def _last_key(df: DataFrame, key: str, rows: int, low: int, high: int) -> tuple[int, int]:
    """The key of row number ``rows`` in order, and how many rows have a lower one.

    Counts of ``BINS`` equal intervals reach the driver; the interval that holds the row is
    divided again until it is one key, after six rounds at most.
    """
    below = 0
    while low < high:
        width = -(-(high - low + 1) // BINS)
        inside = df.where(F.col(key).between(low, high))
        # As decimals, since the distance of two keys may exceed a long.
        place = F.floor((F.col(key).cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)")).cast("int")
        counts = {r["bin"]: r["n"] for r in inside.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()}
        for at in sorted(counts):
            if below + counts[at] >= rows:
                low, high = low + at * width, min(high, low + (at + 1) * width - 1)
                break
            below += counts[at]
    return low, below
