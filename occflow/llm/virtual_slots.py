"""Sharding by fixed virtual slots.

A record hashes into one of a fixed number of slots; bytes are aggregated by slot; a
versioned table maps slots to shards. A new version edits the last one: each shard
keeps its largest slots while they fit the mean, and what is over is dealt, largest
first, to the shard with the fewest bytes. Only slots in excess move.

Slots are made of finer buckets, so that places within a shard come from a window
over one bucket and prefix sums over the bucket table, never from a whole shard.

Defined results: a null text has size 1 (no bytes plus 1), and a null id hashes like
any value. Rows equal in id and text are counted before they move; the first is hashed
by id and text, each further one by its number as well, so that they spread like other
rows. An empty table leaves every slot
where version 0 has it. With fewer filled slots than shards some shards stay empty.
All other columns are dropped by ``place_records``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import numbered

SLOTS = 4096
BUCKETS_PER_SLOT = 16


def describe(docs: DataFrame, doc: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, hash and bucket of each record."""
    crc = F.crc32(F.col(text).cast("binary"))
    hashed = F.xxhash64(F.col(doc), F.col(text))
    rows = docs.select(
        F.col(doc).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        crc.alias("text_crc32"),
        hashed.alias("hash"),
    )
    rows = numbered(rows)
    salted = F.when(F.col("copy") == 0, F.col("hash")).otherwise(F.xxhash64("hash", "copy"))
    bucket = F.pmod(salted, F.lit(slots * BUCKETS_PER_SLOT)).alias("bucket")
    return rows.select("doc_id", "size", "text_crc32", "hash", bucket)


def bucket_loads(records: DataFrame) -> DataFrame:
    return records.groupBy("bucket").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def slot_loads(buckets: DataFrame) -> DataFrame:
    return buckets.groupBy(F.floor(F.col("bucket") / BUCKETS_PER_SLOT).alias("slot")).agg(F.sum("bytes").alias("bytes"))


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 0: slots dealt in turn."""
    return spark.range(slots).select(F.col("id").alias("slot"), (F.col("id") % shards).cast("int").alias("shard"))


def rebalance(current: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """The next version of the map. All its rows, one for each slot, fit one task."""
    held = current.join(loads, "slot", "left").select("slot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes"))
    largest = Window.partitionBy("shard").orderBy(F.col("bytes").desc(), "slot")
    slots = held.withColumn("running", F.sum("bytes").over(largest))
    whole = slots.groupBy().agg(
        F.collect_list(F.struct("bytes", "slot", "shard", "running")).alias("slots"),
        F.ceil(F.sum("bytes") / shards).alias("mean"),
    )
    stays = lambda x: x["running"] <= F.col("mean")
    whole = whole.select(
        F.filter("slots", lambda x: stays(x)).alias("kept"),
        # Largest first, the lower slot first among equals.
        F.array_sort(
            F.transform(
                F.filter("slots", lambda x: ~stays(x)),
                lambda x: F.struct((-x["bytes"]).alias("minus"), x["slot"].alias("slot")),
            )
        ).alias("excess"),
    )
    loads_now = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.aggregate(
            F.filter("kept", lambda x: x["shard"] == s), F.lit(0).cast("long"), lambda a, x: a + x["bytes"]
        ),
    )
    moves = F.array().cast("array<struct<slot:bigint,shard:int>>")

    def deal(state: Column, x: Column) -> Column:
        to = (F.array_position(state["loads"], F.array_min(state["loads"])) - 1).cast("int")
        return F.struct(
            F.transform(state["loads"], lambda load, s: load - F.when(s == to, x["minus"]).otherwise(0)).alias("loads"),
            F.concat(state["moves"], F.array(F.struct(x["slot"].alias("slot"), to.alias("shard")))).alias("moves"),
        )

    dealt = whole.withColumn("loads", loads_now).select(
        "kept", F.aggregate("excess", F.struct("loads", moves.alias("moves")), deal)["moves"].alias("moves")
    )
    kept = F.transform("kept", lambda x: F.struct(x["slot"].alias("slot"), x["shard"].alias("shard")))
    return dealt.select(F.inline(F.concat(kept, "moves")))


def save_map(slot_map: DataFrame, path: str, version: int) -> None:
    slot_map.coalesce(1).write.parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/version={version}")


def place_records(records: DataFrame, buckets: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Each record's shard and its place there, gapless from 0."""
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        buckets.withColumn("vslot", F.floor(F.col("bucket") / BUCKETS_PER_SLOT))
        .join(slot_map.withColumnRenamed("slot", "vslot"), "vslot")
        .select("bucket", "vslot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    within = Window.partitionBy("bucket").orderBy("hash", "doc_id", "text_crc32", "size")
    return records.join(offsets, "bucket").select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("offset") + F.row_number().over(within) - 1).alias("slot"),
        F.col("vslot").alias("virtual_slot"),
    )


def shard(docs: DataFrame, stage, shards: int = 16, doc: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """Describe, aggregate, store map versions 0 and 1, and place every record."""
    spark = docs.sparkSession
    records = stage.table(describe(docs, doc, text, slots), "records")
    buckets = stage.table(bucket_loads(records), "buckets")
    path = stage.path("slot_map")
    save_map(first_map(spark, shards, slots), path, 0)
    save_map(rebalance(load_map(spark, path, 0), slot_loads(buckets), shards), path, 1)
    return place_records(records, buckets, load_map(spark, path, 1))
