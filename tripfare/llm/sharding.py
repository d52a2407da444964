"""Placement of rows on shards by a permutation-filled lookup table. DataFrame functions only."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A prime well above 100 slots per shard keeps shards within a percent of each other.
TABLE_SIZE = 2039
SHARDS = tuple(f"shard-{i:02d}" for i in range(16))


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:12], 16)


def lookup_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """Shard of every slot.

    The preference order of a shard is a permutation of the slots: an offset and
    a skip drawn from its name (``size`` is prime, so any skip visits all). The
    shards take turns, each claiming the first slot of its order that is still
    free, until none is. Adding or removing one shard moves few other slots.
    """
    if not shards or len(set(shards)) != len(shards) or size < len(shards):
        raise ValueError("shards have distinct names and at least a slot each")
    if size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the table size is prime")
    at = [_number(f"offset:{s}") % size for s in shards]
    skip = [_number(f"skip:{s}") % (size - 1) + 1 for s in shards]
    table, left = [-1] * size, size
    while True:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % size
            table[at[i]] = i
            left -= 1
            if not left:
                return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key: its text through md5; a NULL key is the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint") % size).cast("int")


def table_frame(spark: SparkSession, shards: Sequence[str], size: int = TABLE_SIZE) -> DataFrame:
    """(slot, shard), ``size`` rows."""
    names = json.dumps([shards[i] for i in lookup_table(shards, size)])
    listed = F.from_json(F.lit(names), "array<string>")
    return spark.range(1).select(F.posexplode(listed).alias("slot", "shard"))


def _aside(names: Sequence[str], taken: Sequence[str]) -> dict[str, str]:
    """A free name for every column called as one of the new ones, in any letter case."""
    moved: dict[str, str] = {}
    for name in names:
        if name.lower() in taken:
            free = f"input_{name}"
            while free.lower() in {n.lower() for n in [*names, *moved.values()]}:
                free = f"input_{free}"
            moved[name] = free
    return moved


def assign_shards(frame: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    """``frame`` with two more columns, slot and shard.

    The table has ``size`` rows whatever the data are; it is broadcast, and a
    row finds its shard by its slot without a shuffle. Equal keys share a shard;
    a NULL key is placed like the empty text. An existing column named slot or
    shard is kept as input_slot or input_shard; an empty table stays empty.
    """
    moved = _aside(frame.columns, ("slot", "shard"))
    quoted = {c: F.col(f"`{c.replace('`', '``')}`") for c in frame.columns}
    placed = frame.select(*[quoted[c].alias(moved.get(c, c)) for c in frame.columns], slot_of(quoted[key], size).alias("slot"))
    table = table_frame(frame.sparkSession, shards, size).withColumnRenamed("slot", "table_slot")
    return placed.join(F.broadcast(table), F.col("slot") == F.col("table_slot"), "left").drop("table_slot")


def write_shards(frame: DataFrame, path: str, key: str = "doc_id", shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> None:
    """One folder per shard. Tasks write their slots, so the largest shard is still written by many."""
    assign_shards(frame, key, shards, size).repartition("slot").write.partitionBy("shard").parquet(path)


def oracle(shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> str:
    """The table built turn by turn in SQL, and the placement of ``documents``."""
    names = ", ".join(f"'{s}'" for s in shards)
    number = "('0x' || substr(md5({}), 1, 12))::BIGINT"
    return f"""
WITH RECURSIVE shards AS (
  SELECT unnest([{names}]) AS shard, unnest(range({len(shards)})) AS i),
drawn AS (
  SELECT i, shard, {number.format("'offset:' || shard")} % {size} AS off,
         {number.format("'skip:' || shard")} % {size - 1} + 1 AS skip FROM shards),
turns(turn, taken, slot) AS (
  SELECT 0, [off], off FROM drawn WHERE i = 0
  UNION ALL
  SELECT t.turn + 1, list_append(t.taken, c.slot), c.slot
  FROM turns t, LATERAL (
    SELECT (d.off + j.j * d.skip) % {size} AS slot FROM drawn d, range({size}) j(j)
    WHERE d.i = (t.turn + 1) % {len(shards)} AND NOT list_contains(t.taken, (d.off + j.j * d.skip) % {size})
    ORDER BY j.j LIMIT 1) c
  WHERE t.turn + 1 < {size}),
slots AS (SELECT t.slot, d.shard FROM turns t JOIN drawn d ON d.i = t.turn % {len(shards)})
SELECT doc_id, slot::INT AS slot, shard
FROM (SELECT doc_id, {number.format("coalesce(doc_id::VARCHAR, '')")} % {size} AS slot FROM documents) JOIN slots USING (slot)"""

