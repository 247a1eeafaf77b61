"""Sharding by fixed virtual slots.

A record's slot is a hash of its id and its text's checksum modulo a fixed
number of slots (thousands, far more than shards) and never changes.  Bytes
are summed per slot, and a versioned table maps slots to shards: the first
version gives each slot, largest first, to the shard with the fewest bytes;
later versions are edits of the one before, which move as few slots as balance
needs.  Records move only if their slot does.

Distributed: one narrow aggregate per slot (map-side partial).  Only the map,
one row a slot, reaches the driver or is broadcast.  A record's place in its
shard is the number of rows in earlier slots of the shard plus its place in
its slot, so that no task sorts more than a slot.

Edge cases: a null text has no bytes and size 1; null ids are hashed like
others (with the text's checksum); repeated rows are records of their own and
share a slot; an empty table gives no rows, and a map with empty slots.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from notelab.llm.common import written

SLOTS = 4096


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """Per document: doc_id, size (UTF-8 bytes and 1), text_crc32, virtual_slot."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"))
    return narrow.withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)))


def slot_sizes(records_: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and rows of each slot in use (at most one row a slot)."""
    rows = records_.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
    return {r.virtual_slot: (r.bytes, r.rows) for r in rows}


def first_map(bytes_of: dict[int, int], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """Slots, largest first, each to the shard with the fewest bytes."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for slot in sorted(range(slots), key=lambda x: (-bytes_of.get(x, 0), x)):
        load, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + bytes_of.get(slot, 0), shard))
    return out


def edit_map(old: dict[int, int], bytes_of: dict[int, int], shards: int, tolerance: float = 0.01) -> dict[int, int]:
    """A new version for other sizes or another number of shards: slots of
    shards that are gone move, then slots move from the fullest to the emptiest
    shard until both are within ``tolerance`` of the mean or no move helps."""
    out = {k: v for k, v in old.items() if v < shards}
    load = [0] * shards
    own: list[set[int]] = [set() for _ in range(shards)]
    for slot, shard in out.items():
        load[shard] += bytes_of.get(slot, 0)
        own[shard].add(slot)

    def move(slot: int, shard: int) -> None:
        if slot in out:
            own[out[slot]].discard(slot)
            load[out[slot]] -= bytes_of.get(slot, 0)
        out[slot] = shard
        own[shard].add(slot)
        load[shard] += bytes_of.get(slot, 0)

    for slot in sorted((k for k in old if k not in out), key=lambda x: (-bytes_of.get(x, 0), x)):
        move(slot, min(range(shards), key=lambda s: (load[s], s)))
    mean = sum(load) / shards
    while True:
        full, empty = max(range(shards), key=lambda s: (load[s], -s)), min(range(shards), key=lambda s: (load[s], s))
        if load[full] <= mean * (1 + tolerance) and load[empty] >= mean * (1 - tolerance):
            return out
        gap = load[full] - load[empty]
        fits = [x for x in own[full] if 0 < bytes_of.get(x, 0) < gap]
        if not fits:
            return out
        move(min(fits, key=lambda x: (abs(bytes_of[x] - gap / 2), x)), empty)


def write_map(spark: SparkSession, path: str, version: int, slot_map: dict[int, int],
              sizes: dict[int, tuple[int, int]]) -> None:
    """Append a version of the map to the table at ``path``; earlier versions
    stay.  Writing the same version again replaces it."""
    rows = [(s, d, *sizes.get(s, (0, 0))) for s, d in sorted(slot_map.items())]
    (spark.createDataFrame(rows, "virtual_slot long, shard int, bytes long, rows long").coalesce(1)
     .write.mode("overwrite").parquet(f"{path.rstrip('/')}/version={version}"))


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of the map, the latest by default."""
    table = spark.read.schema("virtual_slot long, shard int, bytes long, rows long, version int").parquet(path)
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    return table.filter(F.col("version") == version)


def place(records_: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Records with shard and slot, the place in the shard from 0 on without
    gaps.  ``slot_map`` has one row a slot: that bounds the broadcast."""
    earlier = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.select("virtual_slot", "shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        records_.withColumn("inside", F.row_number().over(inside))
        .join(F.broadcast(starts), "virtual_slot")
        .withColumn("slot", F.col("before") + F.col("inside") - 1).drop("before", "inside"))


def shard(docs: DataFrame, path: str, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
          slots: int = SLOTS) -> DataFrame:
    """Place ``docs`` with a new map, version 1, written to ``path``."""
    own = written(records(docs, id_col, text_col, slots), "records")
    sizes = slot_sizes(own)
    write_map(docs.sparkSession, path, 1, first_map({k: v[0] for k, v in sizes.items()}, shards, slots), sizes)
    return place(own, read_map(docs.sparkSession, path, 1))
