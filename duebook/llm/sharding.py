"""Shards of near equal size by way of fixed virtual slots.

A record is hashed to one of SLOTS slots, which never changes. Bytes are summed per slot; a map from slots to shards is
made of these sums, kept with a version, and edited when shards are added, removed or out of balance. Only the slots that
an edit names move.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duebook.llm.common import free_name, without

SLOTS = 8192
#: Bytes a record takes besides its text.
RECORD_BYTES = 16
MAP_SCHEMA = "version int, slots int, shards int, virtual_slot int, shard int, bytes long, records long"


@dataclass(frozen=True)
class SlotLoads:
    """Bytes and records of each slot; at most SLOTS numbers, however many records there are."""

    bytes: tuple[int, ...]
    records: tuple[int, ...]


@dataclass(frozen=True)
class ShardMap:
    version: int
    shards: int
    shard_of: tuple[int, ...]
    loads: SlotLoads

    def shard_bytes(self) -> list[int]:
        total = [0] * self.shards
        for slot, shard in enumerate(self.shard_of):
            total[shard] += self.loads.bytes[slot]
        return total


def with_size(df: DataFrame, id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """The table less its text, with `size`, `text_crc32` and `virtual_slot`; columns of these names are replaced.

    A null text has RECORD_BYTES and the checksum of an empty one. The slot depends on id and text, so that records
    without an id, or that share one, are spread; equal records share a slot.
    """
    df = without(df, "size", "text_crc32", "virtual_slot")
    names = [f"`{c}`" for c in df.columns if c != text]
    crc = F.crc32(F.coalesce(df[f"`{text}`"], F.lit("")).cast("binary"))
    size = (F.coalesce(F.octet_length(df[f"`{text}`"]), F.lit(0)) + RECORD_BYTES).cast("long")
    sized = df.select(*names, size.alias("size"), crc.alias("text_crc32"))
    slot = F.pmod(F.xxhash64(f"`{id}`", "text_crc32"), F.lit(slots)).cast("int")
    return sized.withColumn("virtual_slot", slot)


def slot_loads(sized: DataFrame, slots: int = SLOTS) -> SlotLoads:
    """Sums per slot, combined before the shuffle; one row per slot comes to the driver."""
    rows = sized.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("records")).collect()
    size, records = [0] * slots, [0] * slots
    for r in rows:
        size[r["virtual_slot"]], records[r["virtual_slot"]] = r["bytes"], r["records"]
    return SlotLoads(tuple(size), tuple(records))


def new_map(loads: SlotLoads, shards: int) -> ShardMap:
    """Version 1: the largest slot first, each to the shard that has least."""
    heap = [(0, s) for s in range(shards)]
    shard_of = [0] * len(loads.bytes)
    for slot in sorted(range(len(shard_of)), key=lambda s: (-loads.bytes[s], s)):
        total, shard = heapq.heappop(heap)
        shard_of[slot] = shard
        heapq.heappush(heap, (total + loads.bytes[slot], shard))
    return ShardMap(1, shards, tuple(shard_of), loads)


def rebalanced(old: ShardMap, loads: SlotLoads | None = None, shards: int | None = None) -> ShardMap:
    """The next version for new loads or another number of shards; slots move only to even out bytes.

    Slots of removed shards go first; then the fullest shard gives its largest slot that fits to the emptiest, as long
    as that lessens the difference between the two.
    """
    loads, shards = loads or old.loads, shards or old.shards
    shard_of = list(old.shard_of)
    held: list[list[int]] = [[] for _ in range(shards)]
    total = [0] * shards
    for slot, shard in enumerate(shard_of):
        if shard < shards:
            held[shard].append(slot)
            total[shard] += loads.bytes[slot]
    for own in held:
        own.sort(key=lambda s: (loads.bytes[s], s))
    for slot in sorted((s for s, x in enumerate(shard_of) if x >= shards), key=lambda s: (-loads.bytes[s], s)):
        shard = min(range(shards), key=lambda x: (total[x], x))
        shard_of[slot] = shard
        total[shard] += loads.bytes[slot]
    while True:
        most, least = max(range(shards), key=lambda x: (total[x], -x)), min(range(shards), key=lambda x: (total[x], x))
        gap = total[most] - total[least]
        fitting = [s for s in held[most] if 0 < loads.bytes[s] < gap and shard_of[s] == most]
        if not fitting:
            break
        slot = min(fitting, key=lambda s: (abs(gap - 2 * loads.bytes[s]), s))
        held[most].remove(slot)
        held[least].append(slot)
        shard_of[slot] = least
        total[most] -= loads.bytes[slot]
        total[least] += loads.bytes[slot]
    return replace(old, version=old.version + 1, shards=shards, shard_of=tuple(shard_of), loads=loads)


def map_table(spark: SparkSession, shards: ShardMap) -> DataFrame:
    """One row per slot."""
    rows = [
        (shards.version, len(shards.shard_of), shards.shards, slot, shard, shards.loads.bytes[slot], shards.loads.records[slot])
        for slot, shard in enumerate(shards.shard_of)
    ]
    return spark.createDataFrame(rows, MAP_SCHEMA)


def save_map(spark: SparkSession, shards: ShardMap, path: str) -> None:
    """Store a version beside those before it; a version that is there already is an error."""
    map_table(spark, shards).drop("version").coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={shards.version}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> ShardMap:
    """A version of the map, or the newest."""
    stored = spark.read.parquet(path)
    version = version or stored.agg(F.max("version")).first()[0]
    rows = stored.filter(F.col("version") == version).orderBy("virtual_slot").collect()
    loads = SlotLoads(tuple(r["bytes"] for r in rows), tuple(r["records"] for r in rows))
    return ShardMap(version, rows[0]["shards"], tuple(r["shard"] for r in rows), loads)


def placed(sized: DataFrame, shards: ShardMap, id: str = "doc_id") -> DataFrame:
    """The records with `shard`, `place` (gapless from 0 in the shard) and the map's `version`; replaces such columns.

    Records are numbered within their slot only; where a slot's numbers begin in its shard follows from the map.
    """
    begin, upto = [0] * len(shards.shard_of), [0] * shards.shards
    for slot, shard in enumerate(shards.shard_of):
        begin[slot] = upto[shard]
        upto[shard] += shards.loads.records[slot]
    sized = without(sized, "shard", "place", "version")
    nth, first, slot = (free_name(sized, x) for x in ("_nth", "_first", "_slot"))
    rows = [(s, shard, begin[s]) for s, shard in enumerate(shards.shard_of)]
    # Small by construction: one row per slot.
    where = F.broadcast(sized.sparkSession.createDataFrame(rows, f"{slot} int, shard int, {first} long"))
    number = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(f"`{id}`", "text_crc32", "size")) - 1
    joined = sized.withColumn(nth, number).join(where, F.col("virtual_slot") == F.col(slot))
    return joined.select(
        *[f"`{c}`" for c in sized.columns],
        "shard",
        (F.col(first) + F.col(nth)).alias("place"),
        F.lit(shards.version).alias("version"),
    )
