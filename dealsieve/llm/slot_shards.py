"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Records are hashed on their id into ``SLOTS`` slots that never change.  Bytes
are summed per slot; a map gives each slot its shard.  Version 1 assigns the
heaviest slots first, each to the lightest shard so far, so shard sizes come
out near equal.  A rebalance edits the map: slots move only where the new
shard count or the sizes ask for it, and each edit is stored as the next
version.  A map has ``SLOTS`` rows whatever the input, which bounds what the
driver holds and what is broadcast.

Rows are numbered inside their shard without a global sort: every slot is cut
into ``CELLS`` cells by a second hash, rows are numbered inside a cell, and
running totals over cells, then over slots, give each cell its first number.

Defined results: a null text has size 1 (no bytes plus 1) and checksum 0; a
row with a null id is hashed on its text; repeated rows are numbered one after
the other; an empty table gives an empty result and an even map; extra columns
are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dealsieve.llm.common import materialise, new_path, text_or_empty

SLOTS = 4096
CELLS = 256
EVEN = 0.002    # a shard this close to the mean is left alone by an edit
MAP_SCHEMA = "virtual_slot int, shard int, bytes long, version int"


def _place(key):
    hashed = F.xxhash64(key, F.lit("slot"))
    return (F.pmod(hashed, F.lit(SLOTS)).cast("int"),
            F.pmod(F.shiftrightunsigned(hashed, 20), F.lit(CELLS)).cast("int"))


def slot_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, size (UTF-8 bytes + 1), text_crc32, virtual_slot and cell of every row."""
    text = text_or_empty(text_col)
    slot, cell = _place(F.coalesce(F.col(f"`{id_col}`").cast("string"), text))
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       slot.alias("virtual_slot"), cell.alias("cell"))


def first_map(slot_bytes: dict[int, int], shards: int) -> dict[int, int]:
    """Slot -> shard: heaviest slot first, to the shard with the fewest bytes so far."""
    loads = [(0, s) for s in range(shards)]
    out = {}
    for slot in sorted(range(SLOTS), key=lambda k: (-slot_bytes.get(k, 0), k)):
        size, shard = heapq.heappop(loads)
        out[slot] = shard
        heapq.heappush(loads, (size + slot_bytes.get(slot, 0), shard))
    return out


def edited_map(current: dict[int, int], slot_bytes: dict[int, int], shards: int) -> dict[int, int]:
    """The next version of a map: slots leave removed and overfull shards for the lightest shards.

    Shards within ``EVEN`` of the mean give and take nothing, so a map that is
    already even stays as it is and a new shard alone receives.
    """
    out, loads = dict(current), [0] * shards
    homeless = [k for k, s in current.items() if s >= shards]
    for slot, shard in current.items():
        if shard < shards:
            loads[shard] += slot_bytes.get(slot, 0)
    for slot in sorted(homeless, key=lambda k: (-slot_bytes.get(k, 0), k)):
        to = min(range(shards), key=lambda s: (loads[s], s))
        out[slot] = to
        loads[to] += slot_bytes.get(slot, 0)
    target = sum(loads) / shards
    takers = [s for s in range(shards) if loads[s] < (1 - EVEN) * target]
    heaviest_first = sorted(out, key=lambda k: (-slot_bytes.get(k, 0), k))
    for slot in heaviest_first if takers else []:
        size, shard = slot_bytes.get(slot, 0), out[slot]
        to = min(takers, key=lambda s: (loads[s], s))
        if size and shard not in takers and loads[shard] > (1 + EVEN) * target and loads[to] + size <= target:
            out[slot] = to
            loads[shard] -= size
            loads[to] += size
    return out


class SlotMap:
    """A slot-to-shard map kept as one Parquet folder per version; versions are never rewritten."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def store(self, mapping: dict[int, int], slot_bytes: dict[int, int], version: int) -> DataFrame:
        rows = [(k, int(s), int(slot_bytes.get(k, 0)), version) for k, s in sorted(mapping.items())]
        frame = self.spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1)
        frame.write.parquet(f"{self.path}/version={version:06d}")
        return self.load(version)

    def load(self, version: int) -> DataFrame:
        return self.spark.read.schema(MAP_SCHEMA).parquet(f"{self.path}/version={version:06d}")


def bytes_per_slot(rows: DataFrame) -> dict[int, int]:
    """Bytes of each slot that has rows (at most ``SLOTS`` numbers)."""
    return {r.virtual_slot: r.b for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("b")).collect()}


def shard_documents(docs: DataFrame, shards: int, rebalance_to: int | None = None, map_path: str | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its virtual slot, shard and gapless number inside the shard (``slot``).

    Map version 1 is stored for ``shards``; with ``rebalance_to`` version 2
    edits it for that many shards, and ``rebalanced_shard`` is its answer.
    """
    spark = docs.sparkSession
    rows = materialise(slot_rows(docs, id_col, text_col), "slot-rows")
    sizes = bytes_per_slot(rows)
    store = SlotMap(spark, map_path or new_path(spark, "slot-map"))
    mapping = first_map(sizes, shards)
    current = store.store(mapping, sizes, 1).select("virtual_slot", "shard", F.col("version").alias("map_version"))
    if rebalance_to:
        after = store.store(edited_map(mapping, sizes, rebalance_to), sizes, 2)
        current = current.join(F.broadcast(after.select("virtual_slot", F.col("shard").alias("rebalanced_shard"))),
                               "virtual_slot")
    else:
        current = current.withColumn("rebalanced_shard", F.lit(None).cast("int"))

    in_cells = rows.groupBy("virtual_slot", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("virtual_slot").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cell_start = in_cells.withColumn("cell_start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    in_slots = in_cells.groupBy("virtual_slot").agg(F.sum("n").alias("n")) \
        .join(F.broadcast(current), "virtual_slot", "right").na.fill(0, ["n"])
    earlier = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    slot_start = in_slots.withColumn("slot_start", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")

    inside = Window.partitionBy("virtual_slot", "cell").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("_k", F.row_number().over(inside) - 1).join(cell_start, ["virtual_slot", "cell"])
    return numbered.join(F.broadcast(slot_start), "virtual_slot").select(
        "doc_id", "size", "text_crc32", "virtual_slot", "shard",
        (F.col("slot_start") + F.col("cell_start") + F.col("_k")).cast("long").alias("slot"),
        "map_version", "rebalanced_shard")
