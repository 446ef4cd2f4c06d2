"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Records are hashed into thousands of slots whose number never changes. Bytes are aggregated
per slot, and a map says which shard owns each slot. Rebalancing edits the map: it moves whole
slots, writes a new version beside the old ones, and leaves all other slots where they were.

Only one line per slot (at most ``slots``) reaches the driver, whatever the number of records.

Defined results: a null text has no bytes and checksum 0; null and repeated ids are placed by
id, checksum and size together; equal records are dealt over all slots, so that no slot outgrows the others;
an empty table gives an empty result and a map of empty slots; other columns don't matter.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faremill.llm.common import scratch_path, small_side, stored, text_of

SLOTS = 4096
MAP_SCHEMA = "version int, virtual_slot int, shard int, slot_bytes long, slot_rows long"


def slot_of(*keys: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def records(df: DataFrame, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """Id, size, checksum and slot of each record; texts are left behind before any shuffle."""
    body = text_of(text)
    light = df.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
        F.crc32(body).cast("long").alias("text_crc32"),
    )
    # equal records are dealt over the slots by the place that they are read at; all others by themselves alone
    names = ["doc_id", "text_crc32", "size"]
    several = light.groupBy(*names).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)
    several = small_side(stored(several.drop("copies").withColumn("salted", F.lit(True)), "shard-copies"))
    same = [light[c].eqNullSafe(several[c]) for c in names]
    marked = light.join(several, same, "left").select(*(light[c] for c in names), "salted")
    salt = F.when(F.col("salted"), F.monotonically_increasing_id())
    return marked.withColumn("virtual_slot", slot_of(*(F.col(c) for c in names), salt, slots=slots)).drop("salted")


def slot_totals(placed: DataFrame, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows by slot; at most ``slots`` lines come to the driver."""
    lines = placed.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    sizes, rows = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    for line in lines:
        sizes[line.virtual_slot], rows[line.virtual_slot] = line.b, line.n
    return sizes, rows


def first_map(slots: int, shards: int) -> np.ndarray:
    return np.arange(slots) % shards


def _closest(values: np.ndarray, target: float) -> int:
    return int(np.abs(values - target).argmin())


def rebalance(owner: np.ndarray, sizes: np.ndarray, shards: int, tolerance: float = 0.0005) -> np.ndarray:
    """Edit the map until the heaviest and lightest shard differ by ``tolerance`` of the mean.

    Each step moves a slot from the heaviest to the lightest shard, or swaps two, whichever comes
    closest to halving their gap; it stops where no step narrows the gap. New shards start empty.
    """
    owner = owner.copy()
    load = np.bincount(owner, weights=sizes, minlength=shards).astype(np.int64)
    for _ in range(8 * len(owner)):
        heavy, light = int(load.argmax()), int(load.argmin())
        gap = load[heavy] - load[light]
        if gap <= tolerance * load.sum() / shards:
            break
        mine, theirs = np.flatnonzero((owner == heavy) & (sizes > 0)), np.flatnonzero(owner == light)
        give = mine[_closest(sizes[mine], gap / 2)]
        best, take = sizes[give], None
        if len(theirs):
            order = theirs[sizes[theirs].argsort()]
            spots = np.searchsorted(sizes[order], sizes[mine] - gap / 2).clip(0, len(order) - 1)
            shifts = sizes[mine] - sizes[order[spots]]
            k = _closest(shifts, gap / 2)
            if 0 < shifts[k] < gap and abs(shifts[k] - gap / 2) < abs(best - gap / 2):
                best, give, take = shifts[k], mine[k], order[spots[k]]
        if not 0 < best < gap:
            break
        owner[give] = light
        if take is not None:
            owner[take] = heavy
        load[heavy] -= best
        load[light] += best
    return owner


def grow(owner: np.ndarray, sizes: np.ndarray, shards: int) -> np.ndarray:
    """The map with one shard more: slots move only into the new shard, from the heaviest ones."""
    owner = owner.copy()
    load = np.bincount(owner, weights=sizes, minlength=shards + 1).astype(np.int64)
    share = load.sum() / (shards + 1)
    for slot in np.argsort(-sizes, kind="stable"):
        old = owner[slot]
        if load[old] - sizes[slot] >= share * 0.999 and load[shards] + sizes[slot] <= share:
            load[old] -= sizes[slot]
            load[shards] += sizes[slot]
            owner[slot] = shards
    return owner


class SlotMaps:
    """The stored versions of a slot-to-shard map, one parquet folder per version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def save(self, version: int, owner: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> None:
        lines = [(version, i, int(o), int(b), int(n)) for i, (o, b, n) in enumerate(zip(owner, sizes, rows))]
        frame = self.spark.createDataFrame(lines, MAP_SCHEMA).coalesce(1)
        frame.write.mode("overwrite").parquet(f"{self.path}/v{version}")

    def load(self, version: int) -> DataFrame:
        return self.spark.read.schema(MAP_SCHEMA).parquet(f"{self.path}/v{version}")


def shard_documents(
    df: DataFrame, shards: int = 16, slots: int = SLOTS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Place every record: shard, virtual slot, and its gapless position ``slot`` in the shard.

    Version 1 of the map deals slots out in turn, version 2 is version 1 rebalanced by bytes; both
    stay in the shared folder. Rows keep their slot and are numbered inside it; a shard's slots
    follow each other, so positions need no window over a whole shard.
    """
    spark = df.sparkSession
    placed = stored(records(df, doc_id, text, slots), "shard-records")
    sizes, rows = slot_totals(placed, slots)
    maps = SlotMaps(spark, scratch_path(spark, "slot-map"))
    start = first_map(slots, shards)
    maps.save(1, start, sizes, rows)
    maps.save(2, rebalance(start, sizes, shards), sizes, rows)
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    owners = maps.load(2).select(
        "virtual_slot",
        "shard",
        F.col("version").alias("map_version"),
        F.coalesce(F.sum("slot_rows").over(before), F.lit(0)).alias("start"),
    )
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("position", F.row_number().over(inside) - 1)
    # the map has ``slots`` rows, whatever the number of records
    return numbered.join(F.broadcast(owners), "virtual_slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("start") + F.col("position")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )
