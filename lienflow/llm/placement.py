"""Sharding by a permutation-filled lookup table: constant-time placement that moves few rows when shards change."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Slots of the table; a prime, well above a hundred times the shards.  The broadcast table has one row each.
SLOTS = 65_537


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "little")


def fill_table(shards: list[str], slots: int = SLOTS) -> list[str]:
    """The shard of each slot.

    Every shard prefers the slots in an order of its own, given by an offset and a step that are hashes of its
    name; since the number of slots is prime, each order visits all of them.  The shards take turns, each
    claiming the first slot it prefers that is still free, so no two shards differ by more than one slot.
    Names count once and in sorted order, so that the table depends on the set of shards alone.
    """
    names = sorted(set(shards))
    if not names or len(names) > slots:
        raise ValueError(f"{len(names)} shards do not fit a table of {slots} slots")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"{slots} is not prime")
    place = [_number(name, "offset") % slots for name in names]
    step = [_number(name, "step") % (slots - 1) + 1 for name in names]
    table: list[str | None] = [None] * slots
    free = slots
    while free:
        for i, name in enumerate(names):
            while table[place[i]] is not None:
                place[i] = (place[i] + step[i]) % slots
            table[place[i]] = name
            free -= 1
            if not free:
                break
    return table


def slot_of(key: str, slots: int = SLOTS) -> str:
    """SQL: the slot of a key: its md5 as text, first 60 bits.  A null key has slot 0."""
    return f"coalesce(pmod(cast(conv(substr(md5(cast({key} AS string)), 1, 15), 16, 10) AS bigint), {slots}L), 0L)"


def lookup_table(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """slot and shard; as many rows as slots, whatever the data."""
    return spark.createDataFrame(list(enumerate(fill_table(shards, slots))), "slot bigint, shard string")


def place(rows: DataFrame, shards: list[str], key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """key, slot and shard of each row; rows of equal key, repeated rows too, go to the same shard."""
    table = lookup_table(rows.sparkSession, shards, slots)
    return rows.selectExpr(f"`{key}`", f"{slot_of(f'`{key}`', slots)} AS slot").join(F.broadcast(table), "slot").select(
        key, "slot", "shard"
    )


def write_sharded(rows: DataFrame, shards: list[str], path: str, key: str = "doc_id", slots: int = SLOTS) -> None:
    """Write each row, all columns as they are, under its shard: ``path/shard=name``.

    Rows are dealt by slot, so a shard is written by many tasks and a frequent key stays one slot's matter.
    """
    table = lookup_table(rows.sparkSession, shards, slots)
    wide = rows.select(F.struct("*").alias("row"), F.expr(slot_of(f"`{key}`", slots)).alias("slot"))
    placed = wide.join(F.broadcast(table), "slot")
    placed.select("row", "shard").write.partitionBy("shard").parquet(path)
