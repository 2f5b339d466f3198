"""Sharding by fixed virtual slots (operator 2).

Records are hashed into ``SLOTS`` virtual slots.  Bytes and rows per slot are
aggregated (at most SLOTS rows), the slot-to-shard map is made from them on the
driver and stored as a versioned table; rebalancing edits the map, never the
hash.  The law held is ``bytes``: shards have nearly equal bytes.

A record's key is its id and text, so rows of one id spread.  Of rows equal in
both, those past the first ``REPEATS`` or so are spread over ``SPREAD`` slots by
their place in the records' table, so that no virtual slot is heavy.  Equal texts
with different ids are groups of copies: the law asks for equal bytes, not for
copies to stay together, so they are placed by their own keys.

Defined results: a null text has no bytes (size 16); an empty table gives an empty
result; other columns of the input are not read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmuration.llm.common import small_side, stored
from murmuration.session import scratch_path

SLOTS = 8192
REPEATS = 64     # equal rows of one slot
SPREAD = 1024
RECORD_BYTES = 16  # fixed part of a record
MAP_SCHEMA = "vslot int, shard int, bytes long, n long"

Row = tuple[int, int, int, int]  # vslot, shard, bytes, rows


def records(documents: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.xxhash64("doc_id", text)
    return documents.select(
        "doc_id", (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.pmod(key, F.lit(slots)).cast("int").alias("vslot"), key.alias("key"))


def spread_repeats(spark: SparkSession, recs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The records (a stored table) with the many copies of a row spread over slots."""
    many = stored(spark, recs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") > REPEATS).select("key"), "repeats")
    if many.isEmpty():
        return recs.drop("key")
    place = F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD))  # as the table's files have it
    placed = recs.withColumn("place", place).join(small_side(many.withColumn("many", F.lit(True)), 16),
                                                  "key", "left")
    vslot = F.when(F.col("many"), F.pmod(F.xxhash64("key", "place"), F.lit(slots)).cast("int"))
    return placed.withColumn("vslot", F.coalesce(vslot, "vslot")).drop("key", "place", "many")


def slot_loads(recs: DataFrame) -> list[tuple[int, int, int]]:
    """(slot, bytes, rows), at most one row for each of the fixed slots."""
    loads = recs.groupBy("vslot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    return sorted((r["vslot"], r["b"], r["n"]) for r in loads.collect())


def first_map(loads: list[tuple[int, int, int]], shards: int) -> list[Row]:
    """Heaviest slot first, each to the shard with the fewest bytes so far."""
    heap = [(0, s) for s in range(shards)]
    out = []
    for slot, size, n in sorted(loads, key=lambda x: (-x[1], x[0])):
        used, shard = heapq.heappop(heap)
        out.append((slot, shard, size, n))
        heapq.heappush(heap, (used + size, shard))
    return sorted(out)


def rebalanced(old: list[Row], loads: list[tuple[int, int, int]], shards: int,
               tolerance: float = 0.01) -> list[Row]:
    """Edit a map for new loads or another shard count, moving few slots.

    A slot leaves its shard only if the shard is gone or holds more than the
    mean by ``tolerance``; it goes to the shard with the fewest bytes.
    """
    home = {slot: shard for slot, shard, _, _ in old}
    at: list[list[tuple[int, int, int]]] = [[] for _ in range(shards)]
    free = []
    for slot, size, n in loads:
        shard = home.get(slot, -1)
        (at[shard] if 0 <= shard < shards else free).append((size, slot, n))
    used = [sum(x[0] for x in s) for s in at]
    limit = (1 + tolerance) * sum(x[1] for x in loads) / shards
    for shard, own in enumerate(at):
        for load in sorted(own):  # small slots first: the least is moved past the limit
            if used[shard] <= limit:
                break
            own.remove(load)
            used[shard] -= load[0]
            free.append(load)
    heap = [(b, s) for s, b in enumerate(used)]
    heapq.heapify(heap)
    for load in sorted(free, reverse=True):
        b, shard = heapq.heappop(heap)
        at[shard].append(load)
        heapq.heappush(heap, (b + load[0], shard))
    return sorted((slot, shard, size, n) for shard, own in enumerate(at) for size, slot, n in own)


def write_map(spark: SparkSession, rows: list[Row], path: str, version: int) -> DataFrame:
    """Store one version of the map (at most SLOTS rows) and read it back."""
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.parquet(f"{path}/version={version}")
    return read_map(spark, path, version)


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{path}/version={version}")


def place(recs: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Shard and gapless position of every record.  Positions stack the virtual
    slots of a shard; rows are ranked inside a virtual slot only, so no task
    holds a shard.  The map has at most SLOTS rows and is broadcast."""
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = slot_map.select("vslot", "shard",
                             F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(
        Window.partitionBy("vslot").orderBy("doc_id", "size", "text_crc32"))
    return recs.join(F.broadcast(starts), "vslot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("start") + inside - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "vslot")


def shard(spark: SparkSession, documents: DataFrame, shards: int = 40,
          map_path: str | None = None) -> DataFrame:
    """Put every document into one of ``shards`` shards under version 1 of a new map."""
    recs = stored(spark, spread_repeats(spark, stored(spark, records(documents), "keys")), "records")
    rows = first_map(slot_loads(recs), shards)
    path = map_path or scratch_path(spark, "slot-map")
    return place(recs, write_map(spark, rows, path, 1))
