"""Shards of near equal bytes by fixed virtual slots, in DataFrame functions alone.

A record's digest (of doc_id and text) puts it into one of SLOTS virtual slots for good. Bytes are added up by slot, and a map says which shard has
which slot: the largest slot first, each to the shard with the fewest bytes. The map is a small table (a row a slot) that is stored by version. Rebalancing writes
another version: of each shard's slots, largest first, as many stay as its share permits, and only the rest move, so records move by whole
slots and old versions still tell where they were. A new shard takes its share out of those that others give up.

Positions within a shard are gapless without one task that sees a shard: the map holds each slot's first position, and a record's place is found within its slot.

The law is that of bytes: sizes near equal. Groups of equal texts aren't kept together, as one group may be larger than a shard's share.
A null text has no bytes and a null doc_id is a key like any other. Rows alike in doc_id and text are one record with a count until the very end; their
positions follow each other. Records of equal digest don't exist otherwise. Columns other than doc_id and text are ignored by `assign` and kept by `write`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labharm.llm.common import cut

#: Virtual slots, and bytes that a record takes besides its text.
SLOTS, RECORD_BYTES = 8192, 16
#: The part of a share that a shard may exceed it by before slots move.
SLACK = 0.0


def digest(doc_id: str = "doc_id", text: str = "text"):
    return F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col(text), F.lit("")))))


def slot_of(digest, slots: int = SLOTS):
    """The first 32 bits of a digest, modulo the slots."""
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(slots)).cast("int")


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, digest, virtual_slot and copies, how many rows are alike: a short row a record, without its text."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), digest().alias("digest"))
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("copies")).withColumn("virtual_slot", slot_of(F.col("digest"), slots))


def totals(found: DataFrame) -> DataFrame:
    """virtual_slot, bytes, rows."""
    return found.groupBy("virtual_slot").agg(F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("rows"))


def _pack(loose: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """virtual_slot, shard: each loose slot (virtual_slot, bytes), largest first, to the shard with the least load; loads: shard, load.

    One row holds all slots, of which there are a fixed number. A slot counts a byte more, so that empty ones are dealt out, too.
    """
    slot, had = F.struct("bytes", "virtual_slot"), F.struct("shard", "load")
    both = loose.select(slot.alias("slot"), F.lit(None).alias("had")).unionByName(loads.select(F.lit(None).alias("slot"), had.alias("had")))
    all_ = both.agg(F.sort_array(F.collect_list("slot"), asc=False).alias("slots"), F.map_from_entries(F.collect_list("had")).alias("had"))
    start = F.struct(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda i: F.coalesce(F.try_element_at("had", i), F.lit(0).cast("long"))).alias("loads"), F.array().cast("array<int>").alias("to"))

    def put(so_far, slot):
        at = F.array_position(so_far["loads"], F.array_min(so_far["loads"])).cast("int") - 1
        loads = F.transform(so_far["loads"], lambda n, i: n + F.when(i == at, slot["bytes"] + 1).otherwise(0))
        return F.struct(loads.alias("loads"), F.concat(so_far["to"], F.array(at)).alias("to"))

    to = F.aggregate("slots", start, put, lambda x: x["to"])
    return all_.select(F.inline(F.arrays_zip(F.col("slots.virtual_slot").alias("virtual_slot"), to.alias("shard"))))


def plan(spark: SparkSession, sums: DataFrame, shards: int, slots: int = SLOTS, known: DataFrame | None = None, slack: float = SLACK) -> DataFrame:
    """virtual_slot, shard, bytes, rows and start, the position of the slot's first record in its shard. sums: as totals gives them.

    known is the map as it was (virtual_slot, shard): its slots move only where their shard has more than its share, or is no more.
    """
    every = spark.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    now = every.join(sums, "virtual_slot", "left").na.fill(0, ["bytes", "rows"])
    if known is None:
        stays, loose = now.limit(0).withColumn("shard", F.lit(0)), now
    else:
        share = F.sum("bytes").over(W.partitionBy(F.lit(0))) * (1 + slack) / shards  # over the slots
        at = W.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot").rowsBetween(W.unboundedPreceding, W.currentRow)
        now = now.withColumn("share", share).join(known.select("virtual_slot", "shard"), "virtual_slot", "left")
        now = now.withColumn("stays", F.coalesce((F.col("shard") < shards) & ((F.sum("bytes").over(at) <= F.col("share")) | (F.col("bytes") == 0)), F.lit(False)))
        stays, loose = now.filter("stays"), now.filter("not stays")
    moved = _pack(loose.select("virtual_slot", "bytes"), stays.groupBy("shard").agg(F.sum(F.col("bytes") + 1).alias("load")), shards)
    placed = stays.select("virtual_slot", "shard").unionByName(moved).join(now.select("virtual_slot", "bytes", "rows"), "virtual_slot")
    before = W.partitionBy("shard").orderBy("virtual_slot").rowsBetween(W.unboundedPreceding, -1)
    return placed.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0)))


def store(found: DataFrame, folder: str, version: int) -> None:
    """Writes a version of the map; there must be none of that number."""
    found.coalesce(1).write.parquet(f"{folder}/version={version}")


def stored(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The map of a version (the last), with the version as a column."""
    maps = spark.read.parquet(folder)
    return maps.filter(F.col("version") == (F.lit(version) if version is not None else F.lit(maps.agg(F.max("version")).first()[0])))


def rebalance(docs: DataFrame, folder: str, shards: int, slots: int = SLOTS, slack: float = SLACK) -> DataFrame:
    """Adds up the documents' bytes by slot again, stores the edited map as the next version, and returns it."""
    spark = docs.sparkSession
    last = stored(spark, folder)
    version = last.first().version
    store(plan(spark, totals(records(docs, slots)), shards, slots, last, slack), folder, version + 1)
    return stored(spark, folder, version + 1)


def assign(found: DataFrame, shard_map: DataFrame) -> DataFrame:
    """A row a document: doc_id, size, text_crc32, virtual_slot, shard and slot, its position in the shard (gapless from 0). found: as records gives them, those that the map was made for."""
    before = W.partitionBy("virtual_slot").orderBy("digest", "doc_id").rowsBetween(W.unboundedPreceding, -1)
    placed = found.withColumn("before", F.coalesce(F.sum("copies").over(before), F.lit(0)))
    placed = placed.join(F.broadcast(shard_map.select("virtual_slot", "shard", "start")), "virtual_slot")  # a row a slot
    return placed.select("doc_id", "size", "text_crc32", "virtual_slot", "shard", (F.col("start") + F.col("before")).alias("__first"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("__copy")).withColumn("slot", F.col("__first") + F.col("__copy")).drop("__first", "__copy")


def write(docs: DataFrame, shard_map: DataFrame, folder: str, slots: int = SLOTS, files: int = 8) -> None:
    """The documents with all their columns as Parquet, a folder a shard (shard=0, ...) with some files each. Columns named shard or virtual_slot are refused."""
    taken = {"shard", "virtual_slot"} & set(docs.columns)
    if taken:
        raise ValueError(f"columns that write adds are there already: {sorted(taken)}")
    placed = docs.withColumn("virtual_slot", slot_of(digest(), slots)).join(F.broadcast(shard_map.select("virtual_slot", "shard")), "virtual_slot")
    placed.repartition("shard", F.pmod("virtual_slot", F.lit(files))).write.partitionBy("shard").parquet(folder)


def shard(docs: DataFrame, shards: int, folder: str, slots: int = SLOTS) -> DataFrame:
    """First version of the map, stored in folder, and what assign says by it."""
    found = cut(records(docs, slots), "shard-records")
    store(plan(docs.sparkSession, totals(found), shards, slots), folder, 0)
    return assign(found, stored(docs.sparkSession, folder, 0))
