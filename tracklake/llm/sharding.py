"""Sharding by fixed virtual slots (operator 5).

Records hash into a fixed number of virtual slots. The bytes of each slot are
summed, and a versioned map assigns slots to shards. Rebalancing edits the map:
it makes a new version that differs from the last only in the slots it moves;
records never change their slot. All row work is DataFrame expressions; the
driver holds the map alone, ``slots`` numbers whatever the data.

Law ``bytes``: the shards' byte totals are made near equal, as near as whole
slots allow.

Results on odd input: a null text has no bytes and CRC-32 0; a null doc_id
hashes as such; rows with equal doc_id and text share a slot and are numbered
one after the other; an empty table gives no rows and the default map.
Columns of the input other than doc_id and text play no part.
"""

from __future__ import annotations

import heapq
import json
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracklake.llm.common import clean_text, materialize

SLOTS, SHARDS, ROW_BYTES = 8192, 40, 16


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and the virtual slot of each row."""
    text = clean_text("text")
    return docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def default_map(slots: int = SLOTS, shards: int = SHARDS) -> list[int]:
    """Version 0: slots dealt in turn."""
    return [s % shards for s in range(slots)]


def slot_bytes(rows: DataFrame, slots: int = SLOTS) -> list[int]:
    """Bytes of each virtual slot (at most ``slots`` numbers reach the driver)."""
    out = [0] * slots
    for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes")).collect():
        out[r["virtual_slot"]] = r["bytes"]
    return out


def rebalance(shard_of: list[int], sizes: list[int], shards: int) -> list[int]:
    """The next version of a map: move slots from full shards to empty ones.

    Each shard above the mean first gives up its smallest-numbered slots that
    bring it to the mean or just above; the slots given up go, largest first,
    to the shard with the fewest bytes. Then single slots move from the
    fullest to the emptiest shard while that narrows their difference. Slots
    of shards that are no more (numbers from ``shards`` on) are given up whole."""
    new, held = list(shard_of), defaultdict(set)
    for slot, shard in enumerate(new):
        held[shard].add(slot)
    total = [sum(sizes[s] for s in held[k]) for k in range(shards)]
    mean = sum(total) / shards
    free = [s for k in list(held) if k >= shards for s in held.pop(k)]
    for k in range(shards):
        for s in sorted(held[k], key=lambda s: (-sizes[s], s)):
            if sizes[s] and total[k] - sizes[s] >= mean:
                held[k].discard(s)
                total[k] -= sizes[s]
                free.append(s)
    queue = [(total[k], k) for k in range(shards)]
    heapq.heapify(queue)
    for s in sorted(free, key=lambda s: (-sizes[s], s)):
        _, k = heapq.heappop(queue)
        held[k].add(s)
        total[k] += sizes[s]
        heapq.heappush(queue, (total[k], k))
    for _ in range(len(sizes)):
        low = min(range(shards), key=lambda k: (total[k], k))
        high = max(range(shards), key=lambda k: (total[k], -k))
        gap = total[high] - total[low]
        fits = [s for s in held[high] if 0 < sizes[s] < gap]
        if not fits:
            break
        s = min(fits, key=lambda s: (abs(gap - 2 * sizes[s]), s))
        held[high].discard(s)
        held[low].add(s)
        total[high] -= sizes[s]
        total[low] += sizes[s]
    for k, slots in held.items():
        for s in slots:
            new[s] = k
    return new


def map_table(spark: SparkSession, versions: list[list[int]], first: int = 0) -> DataFrame:
    """The stored form: (version, virtual_slot, shard), one row per slot and
    version, numbered from ``first``."""
    parts = [
        spark.range(len(m)).select(
            F.lit(v).alias("version"), F.col("id").cast("int").alias("virtual_slot"), _shard(m, F.col("id")).alias("shard")
        )
        for v, m in enumerate(versions, first)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def _shard(shard_of: list[int], slot: Column) -> Column:
    return F.element_at(F.from_json(F.lit(json.dumps(shard_of)), "array<int>"), slot.cast("int") + 1)


def latest(maps: DataFrame) -> DataFrame:
    """virtual_slot and shard of the highest version."""
    return maps.groupBy("virtual_slot").agg(F.max_by("shard", "version").alias("shard"))


def assign(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Add ``shard`` and ``slot``, the row's place in its shard, gapless from 0.

    Rows are numbered within their virtual slot, a slice of the data of even
    size, and each slot starts where the shard's slots before it end."""
    counts = rows.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    places = slot_map.join(counts, "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("slot_start")
    )
    order = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("place", F.row_number().over(order) - F.lit(1))
    # The map is bounded by the fixed number of slots: ``SLOTS`` rows of three numbers.
    return numbered.join(F.broadcast(places), "virtual_slot").withColumn("slot", F.col("slot_start") + F.col("place"))


def read_map(maps: DataFrame, slots: int = SLOTS) -> tuple[int, list[int]]:
    """The number and the map of the highest version stored (``slots`` rows
    reach the driver); ``ValueError`` if it is not a map of so many slots."""
    version = maps.agg(F.max("version")).first()[0]
    found = maps.where(F.col("version") == F.lit(version)).select("virtual_slot", "shard").limit(slots + 1).collect()
    shard_of = {r["virtual_slot"]: r["shard"] for r in found}
    if len(found) != slots or shard_of.keys() != set(range(slots)):
        raise ValueError(f"the stored map is not one of {slots} slots")
    return version, [shard_of[s] for s in range(slots)]


def shard(
    docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, maps: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows with shard and slot, the stored map of all versions).

    ``maps`` is the stored map of an earlier run; without one, version 0 is
    stored first. Its highest version is read back and edited for the bytes of
    ``docs`` and the number of shards. The edit is appended as the next version
    if it moves any slot; a first run always has versions 0 and 1."""
    spark, fresh = docs.sparkSession, maps is None
    if fresh:
        maps = materialize(map_table(spark, [default_map(slots, shards)]), "slot-map")
    version, stored = read_map(maps, slots)
    rows = materialize(records(docs, slots), "shard-records")
    edited = rebalance(stored, slot_bytes(rows, slots), shards)
    if fresh or edited != stored:
        maps = materialize(maps.unionByName(map_table(spark, [edited], version + 1)), "slot-map")
    return assign(rows, latest(maps)), maps
