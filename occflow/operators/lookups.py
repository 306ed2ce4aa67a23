"""Joins that fill, flag or remove rows of a table.

None carries a broadcast hint. Lookups are read from files, so Spark knows their
size and broadcasts those under ``spark.sql.autoBroadcastJoinThreshold``; larger
ones take a shuffled join, where adaptive execution splits a hot key of the
large side into several tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from occflow import constants as C
from occflow.sources.staging import Stage

# Bits for each key of ``may_be_among`` (the next power of two), how many it has at most, and 64-bit words in a row of its table.
BITS_FOR_KEY, MOST_BITS, WORDS_IN_ROW = 8, 1 << 28, 1 << 12

def nulls_last_struct(columns: Sequence[str]) -> Column:
    """A struct that orders by ``columns`` ascending with nulls last."""
    fields = []
    for name in columns:
        fields += [F.col(name).isNull().alias(f"{name}__null"), F.col(name).alias(name)]
    return F.struct(*fields)


def first_per_key(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """The first distinct ``values`` of each key, ascending with nulls last.

    ``distinct`` comes first: it combines on the map side, so what is compared
    per key is a handful of rows no matter how many the input holds.
    """
    return (
        df.select(key, *values)
        .distinct()
        .groupBy(key)
        .agg(F.min(nulls_last_struct(values)).alias("first"))
        .select(key, *[F.col(f"first.{v}").alias(v) for v in values])
    )


def update_from(
    target: DataFrame,
    lookup: DataFrame,
    target_key: str,
    lookup_key: str,
    assign: Mapping[str, str | Column],
    unique: bool = False,
) -> DataFrame:
    """Set ``assign`` columns of matched rows and keep every other row as it is.

    A match assigns nulls too. A column that ``target`` lacks is added, null where
    nothing matches. Unless ``unique`` says that the lookup has one row per key,
    the first row per key is taken, so a target row never multiplies.

    For a target of observations, pass a lookup read from a table, with ``unique``:
    adaptive execution divides a hot key only when both sides of a shuffled join
    are shuffled for it, which the result of an aggregation is not.
    """
    source = lookup.select(
        F.col(lookup_key).alias("__key"),
        *[(F.col(v) if isinstance(v, str) else v).alias(f"__{t}") for t, v in assign.items()],
    ).filter(F.col("__key").isNotNull())
    if not unique:
        source = first_per_key(source, "__key", [f"__{t}" for t in assign])
    source = source.withColumn("__matched", F.lit(True))

    joined = target.join(source, F.col(target_key) == F.col("__key"), "left")
    kept = [c for c in target.columns if c not in assign]
    updated = {
        t: F.when(F.col("__matched"), F.col(f"__{t}"))
        if t not in target.columns
        else F.when(F.col("__matched"), F.col(f"__{t}")).otherwise(F.col(t))
        for t in assign
    }
    order = [*target.columns, *[t for t in assign if t not in target.columns]]
    return joined.select(*[F.col(c) if c in kept else updated[c].alias(c) for c in order])


def flag_matches(
    target: DataFrame,
    keys: DataFrame,
    target_key: str,
    keys_key: str,
    flag: str,
    matched: int = 1,
    default: int = 0,
) -> DataFrame:
    """Add ``flag``: ``matched`` where ``keys`` has the row's key, else ``default``."""
    lookup = keys.select(F.col(keys_key).alias("__key")).distinct()
    return (
        target.join(lookup, F.col(target_key) == F.col("__key"), "left")
        .withColumn(flag, F.when(F.col("__key").isNotNull(), matched).otherwise(default))
        .drop("__key")
    )


def may_be_among(value: Column, keys: DataFrame, count: int) -> Column:
    """False only for a value that is not in the one column of ``keys``, a number of the same type; ``count`` is about their number.

    Keys set a bit of a table of bits by their hash. The predicate reads no row of ``keys``, so Spark moves
    it below the joins and exchanges of the table that it is put on. The bits grow with ``count``
    up to ``MOST_BITS`` and are less sparse beyond.
    """
    bits = min(max(1 << (count * BITS_FOR_KEY).bit_length(), 64 * WORDS_IN_ROW), MOST_BITS)

    def place(c: Column) -> Column:
        return F.xxhash64(c).bitwiseAND(F.lit(bits - 1))

    marks = keys.select(place(F.col(f"`{keys.columns[0]}`")).alias("at")).selectExpr(
        "shiftright(at, 6) AS word", "shiftleft(1L, cast(at & 63 AS int)) AS bits"
    )
    every = keys.sparkSession.range(bits // 64).selectExpr("id AS word", "0L AS bits")
    words = marks.union(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    row = F.floor(F.col("word") / WORDS_IN_ROW).alias("row")
    rows = words.groupBy(row).agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).getField("bits").alias("words"))
    table = rows.agg(F.array_sort(F.collect_list(F.struct("row", "words"))).getField("words")).scalar()
    at, width = place(value), (64 * WORDS_IN_ROW).bit_length() - 1
    word = F.shiftright(at, 6).bitwiseAND(F.lit(WORDS_IN_ROW - 1))
    found = F.get(F.get(table, F.shiftright(at, width).cast("int")), word.cast("int"))
    return F.getbit(found, at.bitwiseAND(F.lit(63)).cast("int")) == 1


def alike(occ: DataFrame, raw: DataFrame, stage: Stage | None = None) -> DataFrame:
    """Occurrences that can be those of rows in ``raw``: of its species, and within its range of ids.

    A reduction before a join by id, which stays exact: an occurrence has the species of
    its row. The range reaches the scan as a filter, where row groups outside it are
    skipped; it also is what lets Spark build a Bloom filter of the ids at run time and
    apply it below the exchange (``spark.sql.optimizer.runtime.bloomFilter``), for as
    long as that filter's size is within its limits. The species are staged, so that
    their size is known: few are broadcast. Where Spark finds no such filter worth while,
    bits of the ids cut the occurrences all the same, see ``may_be_among``.
    """
    # The ends are not taken with the names, as ids would move with each of these then, more than the names themselves.
    ends = raw.agg(F.min(C.OBS_ID).alias("low"), F.max(C.OBS_ID).alias("high"), F.count(C.OBS_ID).alias("ids")).first()
    names = raw.select(C.SPECIES).distinct()
    names = names if stage is None else stage.table(names, "raw_species")
    near = occ.filter(F.col(C.OBS_ID).between(ends["low"], ends["high"]))
    kind = raw.schema[C.OBS_ID].dataType
    if ends["ids"] and isinstance(kind, IntegralType) and kind == occ.schema[C.OBS_ID].dataType:
        near = near.filter(may_be_among(F.col(C.OBS_ID), raw.select(C.OBS_ID).filter(F.col(C.OBS_ID).isNotNull()), ends["ids"]))
    lookup = names.select(F.col(C.SPECIES).alias("__species"))
    return near.join(lookup, F.col(C.SPECIES).eqNullSafe(F.col("__species")), "left_semi")


def drop_species(observations: DataFrame, species: DataFrame) -> DataFrame:
    """Remove the observations of the given species."""
    return observations.join(species.select(C.SPECIES), C.SPECIES, "left_anti").select(
        *observations.columns
    )


def has_duplicates(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """One row, one boolean: does any value of ``keys`` occur more than once?"""
    repeated = df.groupBy(*keys).count().filter(F.col("count") > 1)
    return repeated.agg((F.count(F.lit(1)) > 0).alias(name))
