"""Sharding by a permutation-filled lookup table.

Each shard has a preference order over the slots of a prime-sized table: an offset and
a step drawn from its name's digest. The shards take turns; in its turn a shard claims
the first slot of its order that is still free, until none is. A key's slot is its
digest modulo the table size, so placing a row is one look-up in a broadcast table.
Removing a shard moves little but that shard's keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_SLOTS = 1 << 20


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: Sequence[str], slots: int) -> list[int]:
    """For each slot the index of the shard that claimed it. ``slots`` is a prime, at
    most ``MAX_SLOTS``: that bounds the broadcast whatever the data."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct and at least one")
    if not _is_prime(slots) or not len(shards) <= slots <= MAX_SLOTS:
        raise ValueError(f"slots must be a prime from {len(shards)} to {MAX_SLOTS}")
    start, step = [], []
    for name in shards:
        digest = hashlib.md5(name.encode()).hexdigest()
        start.append(int(digest[:8], 16) % slots)
        step.append(int(digest[8:16], 16) % (slots - 1) + 1 if slots > 1 else 1)
    owner, free = [-1] * slots, slots
    while True:
        for i in range(len(shards)):
            while owner[start[i]] >= 0:
                start[i] = (start[i] + step[i]) % slots
            owner[start[i]] = i
            free -= 1
            if not free:
                return owner


def slot_of(keys: Sequence[str | Column], slots: int) -> Column:
    """Slot of a row: the first 15 hex digits of the MD5 of its keys, modulo ``slots``.
    A null key counts as the empty string."""
    parts = [F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in keys]
    return F.pmod(F.conv(F.substring(F.md5(F.concat_ws("\x1f", *parts)), 1, 15), 16, 10).cast("long"),
                  F.lit(slots)).cast("int")


def shard(docs: DataFrame, shards: Sequence[str], slots: int = 4099, keys: Sequence[str] = ("doc_id",),
          slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """``docs`` with ``slot`` and ``shard``; input columns of these names are replaced.

    No shuffle: one broadcast join with the table of ``slots`` rows. Equal keys share a
    shard, so repeated rows stay together; rows with null keys all go to the slot of the
    empty string; an empty input gives an empty output.
    """
    spark, names = docs.sparkSession, [c for c in docs.columns if c not in (slot_col, shard_col)]
    owner = fill_table(shards, slots)
    filled = F.split(F.lit(",".join(map(str, owner))), ",").cast("array<int>")
    lookup = spark.range(1).select(F.posexplode(filled).alias(slot_col, "__i")).select(
        slot_col, F.element_at(F.array(*map(F.lit, shards)), F.col("__i") + 1).alias(shard_col))
    placed = docs.withColumn(slot_col, slot_of(keys, slots)).drop(*([shard_col] if shard_col != slot_col else []))
    return placed.join(F.broadcast(lookup), slot_col, "left").select(*[f"`{c}`" for c in names], slot_col, shard_col)
