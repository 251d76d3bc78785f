"""Sharding over fixed virtual slots.

A row's key is hashed to one of thousands of slots, for good. Bytes are summed per slot, and a
small versioned table says which shard has which slot. Rebalancing edits that table: slots move
from the fullest shards to the emptiest, and rows follow their slot. Only the table of slots, whose
size is a parameter and not the data's, is ever held in one place.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 8192

MAP_SCHEMA = "virtual_slot int, shard int, bytes long, version int"


def digest60(*columns: Column) -> Column:
    """60 bits of the MD5 digest of the columns as text, nulls being told from empty text; the
    same in any engine that has MD5."""
    text = F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def virtual_slot(*key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(digest60(*key), F.lit(slots)).cast("int")


def slot_bytes(rows: DataFrame, slot: str = "virtual_slot", size: str = "size") -> DataFrame:
    """Bytes of each slot that has rows; summed before the shuffle."""
    return rows.groupBy(F.col(slot).alias("virtual_slot")).agg(F.sum(size).alias("bytes"))


def _sizes(bytes_by_slot: DataFrame, slots: int) -> list[int]:
    sizes = [0] * slots
    for row in bytes_by_slot.collect():  # one row per slot at most
        sizes[row.virtual_slot] = row.bytes or 0
    return sizes


def _table(spark: SparkSession, owner: list[int], sizes: list[int], version: int) -> DataFrame:
    return spark.createDataFrame([(s, owner[s], sizes[s], version) for s in range(len(owner))], MAP_SCHEMA)


def new_map(bytes_by_slot: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 0 of the map: the largest slot first, each to the shard with the fewest bytes (ties:
    fewest slots, then the smaller number)."""
    sizes = _sizes(bytes_by_slot, slots)
    loads = [(0, 0, shard) for shard in range(shards)]
    owner = [0] * slots
    for slot in sorted(range(slots), key=lambda s: (-sizes[s], s)):
        load, count, shard = heapq.heappop(loads)
        owner[slot] = shard
        heapq.heappush(loads, (load + sizes[slot], count + 1, shard))
    return _table(bytes_by_slot.sparkSession, owner, sizes, 0)


def rebalanced(slot_map: DataFrame, bytes_by_slot: DataFrame, shards: int) -> DataFrame:
    """The next version of the map for new sizes or another number of shards.

    Slots of shards that are gone go to the emptiest shard; then, as long as that narrows the gap,
    the best fitting slot of the fullest shard that has one moves to the emptiest. All others stay.
    """
    rows = sorted(slot_map.collect())
    slots, version = len(rows), rows[0].version + 1
    sizes, owner = _sizes(bytes_by_slot, slots), [r.shard for r in rows]
    load = [0] * shards
    held: list[list[int]] = [[] for _ in range(shards)]
    for slot in sorted(range(slots), key=lambda s: (owner[s] >= shards, -sizes[s], s)):
        if owner[slot] >= shards:
            owner[slot] = min(range(shards), key=lambda k: (load[k], k))
        load[owner[slot]] += sizes[slot]
        held[owner[slot]].append(slot)
    while True:
        empty = min(range(shards), key=lambda k: (load[k], k))
        for full in sorted(range(shards), key=lambda k: (-load[k], k)):
            gap = load[full] - load[empty]
            fitting = [s for s in held[full] if 0 < sizes[s] < gap]
            if fitting:
                break
        else:
            return _table(slot_map.sparkSession, owner, sizes, version)
        slot = min(fitting, key=lambda s: (abs(2 * sizes[s] - gap), s))
        held[full].remove(slot)
        held[empty].append(slot)
        load[full] -= sizes[slot]
        load[empty] += sizes[slot]
        owner[slot] = empty


def store_map(slot_map: DataFrame, folder: str) -> None:
    """Adds a version to ``folder``; a version that is there already is an error."""
    version = slot_map.first().version
    slot_map.drop("version").coalesce(1).write.parquet(f"{folder.rstrip('/')}/version={version}")


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The map of ``version``, by default the latest one."""
    maps = spark.read.schema(MAP_SCHEMA).parquet(folder)
    wanted = maps.agg(F.max("version")).first()[0] if version is None else version
    return maps.where(F.col("version") == wanted)


def shard_of(slot: Column, slot_map: DataFrame) -> Column:
    """The shard of a slot, as a lookup in the map's fixed number of entries."""
    owner = [r.shard for r in sorted(slot_map.collect())]
    return F.element_at(F.lit(owner), slot + 1)


def assign(rows: DataFrame, key: list[Column], size: Column, shards: int, folder: str | None = None, slots: int = SLOTS) -> DataFrame:
    """All rows with ``virtual_slot`` and ``shard`` (in place of columns so named), sizes of shards
    being nearly equal.

    ``key``: what names a row, nulls allowed; rows equal in all of it share a slot, so that it is
    for the caller to add what tells many copies apart. ``size``: a row's bytes, not null. ``folder``: where the map's version is stored. No rows give no rows.
    """
    placed = rows.withColumn("virtual_slot", virtual_slot(*key, slots=slots))
    totals = slot_bytes(placed.select("virtual_slot", size.alias("size")))
    slot_map = new_map(totals, shards, slots)
    if folder:
        store_map(slot_map, folder)
        slot_map = load_map(rows.sparkSession, folder)
    return placed.withColumn("shard", shard_of(F.col("virtual_slot"), slot_map))


def copies_in_blocks(rows: DataFrame, columns: list[str], block: int) -> DataFrame:
    """Distinct ``columns`` with ``block`` and ``copies``: equal rows counted before the shuffle and
    cut into blocks of at most ``block`` copies, so that a row repeated very often spreads out."""
    counted = rows.groupBy(*columns).agg(F.count("*").alias("_n"))
    last = F.floor((F.col("_n") - 1) / block)
    blocks = counted.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return blocks.withColumn("copies", F.least(F.lit(block), F.col("_n") - F.col("block") * block)).drop("_n")


def number_in_shard(units: DataFrame, slot_map: DataFrame, order: list[str], copies: str = "copies") -> DataFrame:
    """``units`` with ``first``: the place of a unit's first copy in its shard, from 0 without gaps.

    A unit counts ``copies`` places. Units are numbered within their virtual slot, and slots get
    their start from the counts of the slots before them in the shard.
    """
    owned = slot_map.select("virtual_slot", "shard")
    counts = units.groupBy("virtual_slot").agg(F.sum(copies).alias("_rows")).join(F.broadcast(owned), "virtual_slot")
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("virtual_slot", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("virtual_slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = units.withColumn("_inside", F.coalesce(F.sum(copies).over(inside), F.lit(0)))
    return numbered.join(F.broadcast(starts), "virtual_slot").withColumn("first", F.col("_start") + F.col("_inside")).drop("_start", "_inside")
