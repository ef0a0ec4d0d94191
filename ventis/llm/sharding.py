"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record's slot is a hash of its id, one of thousands, and never changes. The map gives each slot
a shard; adding a shard or evening out load edits the map and raises its version, so only the
records of moved slots move. Bytes are aggregated per slot, never per record on the driver.
All work on records is expressions, grouped sums and one window per slot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 4096
SHARDS = 16


@dataclass(frozen=True)
class SlotMap:
    """Shard of each slot. Never larger than the fixed number of slots."""

    version: int
    shards: int
    owner: tuple[int, ...]

    @classmethod
    def initial(cls, shards: int = 1, slots: int = SLOTS) -> SlotMap:
        """The map that adding shards one by one to a single shard gives.

        It depends on nothing but the two numbers.
        """
        if not 1 <= shards <= slots:
            raise ValueError(f"Need 1 to {slots} shards.")
        current = cls(1, 1, (0,) * slots)
        while current.shards < shards:
            current = current.add_shard()
        return current

    def _slots_of(self) -> dict[int, list[int]]:
        held: dict[int, list[int]] = {shard: [] for shard in range(self.shards)}
        for slot, shard in enumerate(self.owner):
            held[shard].append(slot)
        return held

    def add_shard(self) -> SlotMap:
        """One more shard, with its fair share of slots taken from the fullest shards.

        No slot moves between the old shards.
        """
        new, owner, held = self.shards, list(self.owner), self._slots_of()
        for _ in range(len(owner) // (new + 1)):
            fullest = max(held, key=lambda shard: (len(held[shard]), -shard))
            owner[held[fullest].pop()] = new
        return SlotMap(self.version + 1, new + 1, tuple(owner))

    def rebalance(self, bytes_per_slot: dict[int, int], tolerance: float = 0.02) -> SlotMap:
        """Move slots from the heaviest to the lightest shard until they are near the mean.

        Works on the sums per slot alone. A slot larger than the tolerance stays where it is if
        moving it does not narrow the gap.
        """
        owner, held = list(self.owner), self._slots_of()
        load = {s: sum(bytes_per_slot.get(x, 0) for x in slots) for s, slots in held.items()}
        allowed = tolerance * sum(load.values()) / self.shards
        for _ in range(len(owner)):
            heavy, light = max(load, key=load.get), min(load, key=load.get)
            gap = load[heavy] - load[light]
            if gap <= allowed:
                break
            useful = [s for s in held[heavy] if 0 < bytes_per_slot.get(s, 0) < gap]
            if not useful:
                break
            slot = min(useful, key=lambda s: abs(bytes_per_slot[s] - gap / 2))
            held[heavy].remove(slot)
            held[light].append(slot)
            load[heavy] -= bytes_per_slot[slot]
            load[light] += bytes_per_slot[slot]
            owner[slot] = light
        return SlotMap(self.version + 1, self.shards, tuple(owner))

    def shard_of(self, slot: Column) -> Column:
        """Shard of a slot column: a lookup in one constant array."""
        table = F.split(F.lit(",".join(map(str, self.owner))), ",")
        return F.element_at(table, (slot + 1).cast("int")).cast("int")

    def save(self, spark: SparkSession, path: str) -> None:
        """Append this version to the table of all versions: (version, slot, shard)."""
        rows = spark.range(len(self.owner)).select(
            F.lit(self.version).alias("version"), F.col("id").cast("int").alias("slot"),
            self.shard_of(F.col("id")).alias("shard"))
        rows.coalesce(1).write.mode("append").partitionBy("version").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """A stored version, the newest by default."""
        table = spark.read.parquet(path)
        if version is None:
            version = table.agg(F.max("version")).first()[0]
        rows = table.filter(F.col("version") == version).orderBy("slot").collect()
        owner = tuple(row["shard"] for row in rows)
        return cls(version, max(owner) + 1, owner)


def slot_of(id_col: str = "doc_id", slots: int = SLOTS) -> Column:
    """Virtual slot of a record; null ids share one."""
    return F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(slots)).cast("int")


def record_bytes(text_col: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1


def slot_loads(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               slots: int = SLOTS) -> DataFrame:
    """Rows (slot, n_records, bytes); combined before the shuffle, at most one row per slot."""
    return docs.groupBy(slot_of(id_col, slots).alias("slot")).agg(
        F.count("*").alias("n_records"), F.sum(record_bytes(text_col)).alias("bytes"))


def assign(docs: DataFrame, slot_map: SlotMap, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """All rows without their texts, plus size, text_crc32 (unsigned, null text as empty), shard and slot.

    ``slot`` is the record's place in its shard, gapless from 0: places before its virtual slot,
    plus its rank inside the virtual slot by id (rows of one id in any order). No window is
    larger than a virtual slot.
    """
    slots = len(slot_map.owner)
    virtual = slot_of(id_col, slots)
    kept = [c for c in docs.columns if c not in (text_col, "size", "text_crc32", "shard", "slot")]
    records = docs.select(
        F.struct(*kept).alias("row"), F.col(id_col).cast("long").alias("id"),
        record_bytes(text_col).alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
        virtual.alias("virtual"))
    counts = docs.groupBy(virtual.alias("virtual")).agg(F.count("*").alias("n")).select(
        "virtual", "n", slot_map.shard_of(F.col("virtual")).alias("shard"))
    before = Window.partitionBy("shard").orderBy("virtual").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select("virtual", "shard", F.coalesce(F.sum("n").over(before), F.lit(0))
                           .alias("start"))
    inside = Window.partitionBy("virtual").orderBy("id", "text_crc32", "size")
    # One row per virtual slot: the side is bounded by the fixed number of slots.
    return (
        records.withColumn("rank", F.row_number().over(inside))
        .join(F.broadcast(starts), "virtual")
        .select("row.*", "size", "text_crc32", "shard",
                (F.col("start") + F.col("rank") - 1).alias("slot"))
    )
