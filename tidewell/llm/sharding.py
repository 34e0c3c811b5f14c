"""Shard placement by a permutation-filled lookup table.

Every shard orders the slots of a prime-sized table by a permutation of its own
(an offset and a step from a hash of its name). Shards take turns; whoever
has its turn claims the first free slot of its order, and a shard of weight w has w turns a
round. A key goes to the shard of slot ``hash(key) mod size``. Shards hold equal shares
(to one turn), and without one shard few keys but its own move.

The table's size is a parameter with an upper bound, so it is broadcast whatever the data.

Defined results: a null key has the slot of the hash of null, one for all; rows that
repeat a key share its shard. With ``spread`` the rows of one key are dealt over so many
salted keys, by the hash of a second column, which divides a hot key.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

SLOTS = 65_537
MOST_SLOTS = 1_000_003


def fill_table(shards: list[str], slots: int = SLOTS, weights: list[int] | None = None) -> np.ndarray:
    """The shard number of each slot."""
    if slots > MOST_SLOTS or slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime of at most {MOST_SLOTS}")
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct names, one at least and no more than slots")
    weights = weights or [1] * len(shards)
    if len(weights) != len(shards) or min(weights) < 1:
        raise ValueError("one weight of at least 1 per shard")
    offset, step = [], []
    for name in shards:
        digest = hashlib.md5(name.encode(), usedforsecurity=False).digest()
        offset.append(int.from_bytes(digest[:8]) % slots)
        step.append(int.from_bytes(digest[8:]) % (slots - 1) + 1)
    table = np.full(slots, -1, np.int32)
    place, left = list(offset), slots
    while left:
        for number, turns in enumerate(weights):
            for _ in range(min(turns, left)):
                while table[place[number]] >= 0:
                    place[number] = (place[number] + step[number]) % slots
                table[place[number]] = number
                left -= 1
    return table


def lookup_table(spark, shards: list[str], slots: int = SLOTS, weights: list[int] | None = None) -> DataFrame:
    """(slot, shard, shard_name) of every slot."""
    table = fill_table(shards, slots, weights)
    rows = [(i, int(k), shards[k]) for i, k in enumerate(table)]
    return spark.createDataFrame(rows, "slot long, shard int, shard_name string")


def slot_of(*keys: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: its md5 text's first 60 bits, modulo the table's size."""
    whole = F.concat_ws("\x1f", *[F.coalesce(k.cast("string"), F.lit("\x1e")) for k in keys])
    return F.pmod(F.conv(F.substring(F.md5(whole.cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(slots))


def place(
    docs: DataFrame, shards: list[str], key: str = "doc_id", slots: int = SLOTS, weights: list[int] | None = None,
    spread: int = 1, salt: str | None = None,
) -> DataFrame:
    """(key, [salt,] slot, shard, shard_name) of every row, by one broadcast join and without a shuffle."""
    parts = [F.col(key)]
    if spread > 1:
        parts.append(F.pmod(F.xxhash64(F.col(salt or key)), F.lit(spread)))
    kept = [key] + ([salt] if salt and salt != key else [])
    rows = docs.select(*kept, slot_of(*parts, slots=slots).alias("slot"))
    return rows.join(F.broadcast(lookup_table(docs.sparkSession, shards, slots, weights)), "slot").select(
        *kept, "slot", "shard", "shard_name"
    )
