"""Placement of keys on shards by a permutation-filled lookup table.

Every shard has a permutation of the table's slots, its order of preference. The shards take turns;
at its turn a shard claims the first slot of its order that is still free. The table is then shared
almost equally, and a change of the list of shards moves few keys. A row's key is hashed to a slot and
the slot looked up in the broadcast table.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The table is broadcast: two numbers a slot, so 8 million slots are at most about 200 MB in memory.
MOST_SLOTS = 1 << 23


def is_prime(number: int) -> bool:
    if number < 2:
        return False
    return all(number % d for d in range(2, int(number**0.5) + 1))


def preference(name: str, slots: int) -> tuple[int, int]:
    """Where a shard's order begins and how far it steps; the step is no multiple of the prime."""
    digest = md5(name.encode()).hexdigest()
    return int(digest[:8], 16) % slots, int(digest[8:16], 16) % (slots - 1) + 1


def fill(shards: Sequence[str], slots: int) -> list[int]:
    """The shard (as position in ``shards``) of each slot. Work and size depend on ``slots`` alone."""
    names = list(shards)
    if not names or len(set(names)) < len(names) or None in names:
        raise ValueError("shards need distinct names, one at least")
    if not is_prime(slots) or not len(names) < slots <= MOST_SLOTS:
        raise ValueError(f"the table needs a prime number of slots, more than shards and at most {MOST_SLOTS}")
    orders = [preference(name, slots) for name in names]
    tried, table, free = [0] * len(names), [-1] * slots, slots
    while True:
        for shard, (begin, step) in enumerate(orders):
            slot = (begin + tried[shard] * step) % slots
            while table[slot] >= 0:
                tried[shard] += 1
                slot = (begin + tried[shard] * step) % slots
            table[slot] = shard
            tried[shard] += 1
            free -= 1
            if not free:
                return table


def lookup_table(spark: SparkSession, shards: Sequence[str], slots: int) -> DataFrame:
    """The filled table as rows (slot, shard)."""
    claimed = ",".join(map(str, fill(shards, slots)))
    names = F.array(*(F.lit(name) for name in shards))
    return spark.range(1).select(F.posexplode(F.split(F.lit(claimed), ",")).alias("slot", "at")).select(
        "slot", F.element_at(names, F.col("at").cast("int") + 1).alias("shard")
    )


def slot_of(key, slots: int):
    """Slot of a key column: the first 15 hexadecimal digits of the MD5 of its text, modulo ``slots``."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15)
    return (F.conv(digits, 16, 10).cast("bigint") % slots).cast("int")


def place(
    docs: DataFrame,
    key: str,
    shards: Sequence[str],
    slots: int = 65537,
    columns: tuple[str, str] = ("slot", "shard"),
) -> DataFrame:
    """Add the slot and the shard of each row; rows stay where they are (one broadcast join).

    A row's place depends on its key alone: repeated keys share it, a null key is placed as the empty
    text. ``columns`` names the two added columns; a column of ``docs`` with such a name raises, so
    nothing is overwritten. An empty table gives an empty result.
    """
    clash = {c.lower() for c in docs.columns} & {c.lower() for c in columns}
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    slot, shard = columns
    table = lookup_table(docs.sparkSession, shards, slots).select(F.col("slot").alias(slot), F.col("shard").alias(shard))
    order = [*docs.columns, slot, shard]
    return docs.withColumn(slot, slot_of(F.col(key), slots)).join(F.broadcast(table), slot).select(*order)
