"""Sharding through fixed virtual slots and a versioned slot map.

Records are hashed into a fixed number of slots (thousands); the bytes and rows
of each slot are summed; slots, not records, are given to shards.  The map from
slot to shard is a small table with a version: ``new_map`` balances bytes,
``rebalance`` edits a stored map for another number of shards or changed slot
sizes by moving as few slots as it needs, and writes the next version.  A
record's shard is a lookup by its slot, so a map can be applied to any table.

The law of this operator is ``bytes``: shard sizes are near equal (they differ
by about the smallest slot that is worth moving).

Spark work: one pass over the texts leaves ids, sizes and checksums; slot sums
are a partial aggregate; only the slot sums (``slots`` rows, a parameter of at
most ``MAX_SLOTS``) come to the driver.  Places inside a shard need no shard in
one task: a slot's rows are numbered within the slot, and its first number
follows from the row counts of the slots before it.  The slot hash covers id,
checksum and size, so rows that share an id spread over the slots.

Results for odd input: a null text has size 1 and checksum 0; a null id hashes
like any value; rows equal in id and text are interchangeable; an empty table
gives a map of empty slots and no rows; other columns pass through, and an
output name that clashes with one of them is an error.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tabkit.llm.common import check_free, col

MAX_SLOTS = 65_536
MAP_SCHEMA = "version int, vslot int, shard int, bytes bigint, rows bigint"


def text_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text plus 1."""
    return (F.coalesce(F.octet_length(col(text)), F.lit(0)) + 1).cast("bigint")


def text_crc32(text: str = "text") -> Column:
    return F.crc32(F.coalesce(col(text), F.lit("")).cast("binary"))


def with_slots(df: DataFrame, size: str, crc: str, doc_id: str = "doc_id", slots: int = 4096) -> DataFrame:
    """``df`` with ``vslot``: the fixed virtual slot of each record."""
    check_free(df, "vslot")
    if not 0 < slots <= MAX_SLOTS:
        raise ValueError(f"slots must be between 1 and {MAX_SLOTS}")
    return df.withColumn("vslot", F.pmod(F.xxhash64(col(doc_id), col(crc), col(size)), F.lit(slots)).cast("int"))


def slot_sizes(slotted: DataFrame, size: str, slots: int) -> dict[int, tuple[int, int]]:
    """Bytes and rows of every slot; empty slots included."""
    rows = slotted.groupBy("vslot").agg(F.sum(col(size)).alias("bytes"), F.count("*").alias("rows")).collect()
    found = {r.vslot: (r.bytes, r.rows) for r in rows}
    return {s: found.get(s, (0, 0)) for s in range(slots)}


def new_map(sizes: dict[int, tuple[int, int]], shards: int) -> dict[int, int]:
    """Slots in falling order of bytes, each to the shard with the fewest
    bytes so far (ties: fewer slots, then the lower shard)."""
    load = [(0, 0, s) for s in range(shards)]
    given = {}
    for slot in sorted(sizes, key=lambda s: (-sizes[s][0], s)):
        total, n, shard = heapq.heappop(load)
        given[slot] = shard
        heapq.heappush(load, (total + sizes[slot][0], n + 1, shard))
    return given


def rebalance(slot_map: dict[int, int], sizes: dict[int, tuple[int, int]], shards: int) -> dict[int, int]:
    """An edited copy of ``slot_map`` for ``shards`` shards: slots of shards
    that are gone and of shards above the mean move, all others stay."""
    total = [0] * shards
    held: dict[int, list[int]] = {s: [] for s in range(shards)}
    loose = []
    for slot, shard in sorted(slot_map.items()):
        if shard < shards:
            held[shard].append(slot)
            total[shard] += sizes[slot][0]
        else:
            loose.append(slot)
    mean = sum(b for b, _ in sizes.values()) / shards
    for shard, own in held.items():
        # the largest slots that fit into what is above the mean
        for slot in sorted(own, key=lambda s: (-sizes[s][0], s)):
            if 0 < sizes[slot][0] <= total[shard] - mean:
                loose.append(slot)
                total[shard] -= sizes[slot][0]
    edited = {slot: shard for slot, shard in slot_map.items() if shard < shards}
    load = [(b, s) for s, b in enumerate(total)]
    heapq.heapify(load)
    for slot in sorted(loose, key=lambda s: (-sizes[s][0], s)):
        b, shard = heapq.heappop(load)
        edited[slot] = shard
        heapq.heappush(load, (b + sizes[slot][0], shard))
    return edited


def store_map(spark: SparkSession, path: str, slot_map: dict[int, int], sizes: dict[int, tuple[int, int]]) -> int:
    """Append the next version to the map table and return its number.  Each
    version is one file, renamed into the table when its write is committed,
    so a job that dies before leaves no part of a version."""
    version = max(stored_versions(spark, path), default=0) + 1
    rows = [(version, slot, shard, *sizes[slot]) for slot, shard in sorted(slot_map.items())]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return version


def stored_versions(spark: SparkSession, path: str) -> list[int]:
    """Versions of the map table; none where there is no table yet."""
    try:
        table = spark.read.schema(MAP_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted(r.version for r in table.select("version").distinct().collect())


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The slot map of a version (the newest if not given)."""
    version = stored_versions(spark, path)[-1] if version is None else version
    return spark.read.schema(MAP_SCHEMA).parquet(path).where(F.col("version") == version)


def assign(slotted: DataFrame, slot_map: DataFrame, order: list[str]) -> DataFrame:
    """``slotted`` with ``shard``, ``slot`` (place inside the shard, gapless
    from 0) and ``map_version``.  ``order`` settles the places inside a
    virtual slot.  The map holds ``MAX_SLOTS`` rows at most and is broadcast."""
    check_free(slotted, "shard", "slot", "map_version")
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.select("vslot", "shard", F.col("version").alias("map_version"),
                             F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("vslot").orderBy(*map(col, order)))
    return (slotted.withColumn("_place", place - 1).join(F.broadcast(starts), "vslot")
            .withColumn("slot", (F.col("_start") + F.col("_place")).cast("bigint")).drop("_start", "_place"))
