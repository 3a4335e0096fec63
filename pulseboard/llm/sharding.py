"""Sharding by fixed virtual slots.

A record's id, size and checksum hash to one of thousands of slots, whatever the number of shards.  Bytes and records are summed
per slot, and a stored, versioned map says which shard a slot belongs to.  Version 1 deals slots out in turn; rebalancing
edits the map by the summed bytes: a slot stays in its shard while the shard has room up to an equal share, and moves to the
emptiest shard otherwise.  Finding a record's shard needs its own columns and the map, nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulseboard.llm.common import shared_folder, stored

SLOTS = 8192
SHARDS = 24
#: Equal records (one id, size and checksum) that share a slot; more of them go on to further slots.
TOGETHER = 256


def slot_of(doc_id: Column, size: Column, crc: Column, chunk: Column, slots: int = SLOTS) -> Column:
    """The slot of a record: 32 bits of an md5 of its id, size, checksum and the number of its chunk of equal records."""
    key = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), size.cast("string"), crc.cast("string"), chunk.cast("string"))
    return F.pmod(F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(slots)).cast("int")


def record_chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, chunk, copies, virtual_slot: the records of ``docs``, up to ``TOGETHER`` equal ones per row.

    Equal records are counted before the shuffle, so an id or a text that holds most rows is a few rows from there on."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    records = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), (F.octet_length(t) + 8).cast("long").alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"))
    records = records.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("all"))
    chunks = records.select("doc_id", "size", "text_crc32", "all", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("all") - 1) / TOGETHER))).alias("chunk"))
    return chunks.select("doc_id", "size", "text_crc32", "chunk", F.least(F.lit(TOGETHER).cast("long"), F.col("all") - F.col("chunk") * TOGETHER).alias("copies"),
                         slot_of(F.col("doc_id"), F.col("size"), F.col("text_crc32"), F.col("chunk"), slots).alias("virtual_slot"))


def first_map(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """virtual_slot, shard: slots dealt out in turn."""
    return spark.range(0, slots, 1, 1).select(F.col("id").cast("int").alias("virtual_slot"), (F.col("id") % shards).cast("int").alias("shard"))


def save_map(slot_map: DataFrame, folder: str, version: int) -> None:
    """Store a version of the map; earlier ones stay.  A version that exists is an error."""
    slot_map.coalesce(1).write.mode("error").parquet(f"{folder.rstrip('/')}/version={version}")


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """version, virtual_slot, shard, bytes, records of a stored version (default: the latest)."""
    every = spark.read.schema("virtual_slot int, shard int, bytes long, records long, version int").parquet(folder)
    if version is not None:
        return every.where(F.col("version") == version)
    return every.where(F.col("version") == every.agg(F.max("version")).first()[0])


def slot_loads(chunks: DataFrame) -> DataFrame:
    """virtual_slot, bytes, records of the slots that hold records."""
    return chunks.groupBy("virtual_slot").agg(F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("records"))


def rebalance(slot_map: DataFrame, loads: DataFrame, shards: int = SHARDS) -> DataFrame:
    """virtual_slot, shard, bytes, records: the map edited for ``loads``.

    Slots are taken by falling bytes (ties: by number); one stays while its shard's bytes remain within total / shards, rounded up, and else goes to
    the shard with the fewest bytes so far (ties: the lowest).  Works on the slots in one row: their number is fixed, and does not grow with the records."""
    rows = slot_map.select("virtual_slot", "shard").join(F.broadcast(loads), "virtual_slot", "left").select(
        "virtual_slot", "shard", F.coalesce("bytes", F.lit(0).cast("long")).alias("bytes"), F.coalesce("records", F.lit(0).cast("long")).alias("records"))
    one = rows.agg(F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("order"), "virtual_slot", "shard", "bytes", "records"))).alias("slots"),
                   F.ceil(F.sum("bytes") / shards).alias("share"))

    def place(state: Column, slot: Column) -> Column:
        used = state["used"]
        stays = (slot["shard"] < shards) & (F.coalesce(F.get(used, slot["shard"]), F.lit(0)) + slot["bytes"] <= F.col("share"))
        to = F.when(stays, slot["shard"]).otherwise((F.array_position(used, F.array_min(used)) - 1).cast("int"))
        with_to = F.transform(F.array(to), lambda t: F.struct(
            F.transform(used, lambda u, i: F.when(i == t, u + slot["bytes"]).otherwise(u)).alias("used"), F.concat(state["shard"], F.array(t)).alias("shard")))
        return F.get(with_to, 0)

    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("used"), F.array().cast("array<int>").alias("shard"))
    placed = one.select("slots", F.aggregate("slots", start, place, lambda s: s["shard"]).alias("shard"))
    return placed.select(F.inline(F.arrays_zip(F.col("slots"), F.col("shard").alias("to")))).select(
        "slots.virtual_slot", F.col("to").alias("shard"), "slots.bytes", "slots.records")


def shard_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, slots: int = SLOTS, folder: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, virtual_slot, map_version: one row per input row.

    ``size`` is the text's UTF-8 bytes plus 8; shards are near equal in bytes: apart by less than a small slot, unless one slot (so one document) alone
    exceeds a share.  ``slot`` numbers a shard's rows gapless from 0, by virtual slot, id (nulls first), checksum and size.  The map
    is kept in ``folder`` (default: a new one in the shared folder): version 1 as dealt, and one version more for the balance of these documents;
    with a folder that holds versions the latest is edited, so most records stay where they were.
    A null text counts as empty; null ids, and repeated rows, are records like others; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    kept = folder is not None and _has_map(spark, folder)
    folder = folder or shared_folder(spark, "slot-map")
    if not kept:
        empty = F.lit(0).cast("long")
        save_map(first_map(spark, shards, slots).withColumns({"bytes": empty, "records": empty}), folder, 1)
    chunks = stored(record_chunks(docs, doc_id, text, slots), "record-chunks")
    before = load_map(spark, folder)
    version = before.agg(F.max("version")).first()[0] + 1
    save_map(rebalance(before, slot_loads(chunks), shards), folder, version)
    places = load_map(spark, folder, version).withColumn("base", F.coalesce(
        F.sum("records").over(Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    rows = chunks.withColumn("before", F.coalesce(F.sum("copies").over(inside), F.lit(0).cast("long")))
    # the map has a row per slot, a fixed number
    rows = rows.join(F.broadcast(places.select("virtual_slot", "shard", "base", "version")), "virtual_slot")
    start = F.col("base") + F.col("before")
    return rows.select("doc_id", "size", "text_crc32", "shard", F.explode(F.sequence(start, start + F.col("copies") - 1)).alias("slot"), "virtual_slot",
                       F.col("version").alias("map_version"))


def _has_map(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
