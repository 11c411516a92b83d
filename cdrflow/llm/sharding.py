"""Maglev sharding: a permutation-filled lookup table gives constant-time placement.

Each shard has its own preference order of the slots of a prime-sized table (a
start and a step from its name).  The shards take turns, each claiming its most
preferred free slot, until the table is full.  Shares differ by one slot at
most, and adding or removing a shard moves few keys.  The table is a bounded
configuration value (``MAX_SLOTS``), built once on the driver and broadcast.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bound of the lookup table and so of the broadcast (about 16 bytes a slot).
MAX_SLOTS = 1_000_003


def _number(text: str) -> int:
    """The first 60 bits of the MD5, as ``key_number`` computes it in Spark."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: list[str], slots: int) -> list[int]:
    """The shard's index for each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be non-empty and distinct")
    if not _is_prime(slots) or not len(shards) <= slots <= MAX_SLOTS:
        raise ValueError(f"slots must be a prime from {len(shards)} to {MAX_SLOTS}")
    start = [_number(f"{s}#start") % slots for s in shards]
    step = [_number(f"{s}#step") % (slots - 1) + 1 for s in shards]
    table: list[int] = [-1] * slots
    for turn in range(slots):
        i = turn % len(shards)
        while table[start[i]] >= 0:
            start[i] = (start[i] + step[i]) % slots
        table[start[i]] = i
    return table


def lookup_table(spark: SparkSession, shards: list[str], slots: int) -> DataFrame:
    """(slot, shard) rows of the filled table."""
    names = [shards[i] for i in fill_table(shards, slots)]
    return spark.range(1).select(
        F.posexplode(F.from_json(F.lit(json.dumps(names)), "array<string>")).alias("slot", "shard")
    )


def key_number(key: Column) -> Column:
    """A 60-bit number of the key's text; a null key counts as the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def assign_shards(df: DataFrame, key: str, shards: list[str], slots: int, columns: list[str] | None = None) -> DataFrame:
    """``columns`` (default: the key) of every row plus its ``slot`` and ``shard``.

    Equal keys, repeated rows included, go to the same shard.  A null key is
    placed like the empty text.  The broadcast holds at most ``MAX_SLOTS`` rows,
    whatever the size of ``df``; ``df`` is never shuffled.
    """
    columns = columns or [key]
    placed = df.select(
        F.struct(*[df[c] for c in columns]).alias("row"), F.pmod(key_number(df[key]), F.lit(slots)).cast("int").alias("slot")
    )
    return placed.join(F.broadcast(lookup_table(df.sparkSession, shards, slots)), "slot").select("row.*", "slot", "shard")
