"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a prime-sized table,
``(offset + turn * skip) mod size``. Shards take turns, each claiming its most
preferred free slot, until the table is full. A row's key hashes to a slot and
the slot names the shard, so placement is one lookup, shards differ by at most
one slot, and a changed shard count moves few slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS, SLOTS = 16, 2039


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def key_hash(*parts: Column) -> Column:
    """32 bits of md5 of the key's text; a null part counts as a single NUL sign."""
    joined = F.concat_ws("\x01", *[F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("long")


def _let(value: Column, then) -> Column:
    """Bind a value once inside a higher-order function."""
    return F.element_at(F.transform(F.array(value), then), 1)


def lookup_table(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(slot, shard) for all slots: one row per slot, filled in turns.

    The state of the fold is the table, -1 for free slots, and each shard's next
    turn. Its work is ``slots`` squared and depends on the parameters alone.
    """
    if not (is_prime(slots) and 0 < shards <= slots):
        raise ValueError("slots must be a prime and shards between 1 and slots")
    # Offsets and skips from the shard's name; a skip is never 0, so a prime size makes the order a permutation.
    name = lambda i: F.concat(F.lit("shard-"), i.cast("string"))
    offsets = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda i: F.pmod(key_hash(name(i), F.lit("offset")), F.lit(slots)))
    skips = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)), lambda i: F.pmod(key_hash(name(i), F.lit("skip")), F.lit(slots - 1)) + 1
    )
    orders = spark.range(1).select(offsets.alias("offset"), skips.alias("skip"))
    turns = F.sequence(F.lit(0), F.lit(slots - 1))
    empty = F.struct(
        F.array_repeat(F.lit(-1), slots).alias("table"), F.array_repeat(F.lit(0), shards).alias("next")
    )

    def claim(state: Column, turn: Column) -> Column:
        shard = F.pmod(turn, F.lit(shards)).cast("int")
        slot_at = lambda j: F.pmod(F.get("offset", shard) + j.cast("long") * F.get("skip", shard), F.lit(slots)).cast("int")
        open_turns = F.filter(
            F.sequence(F.get(state["next"], shard), F.lit(slots - 1)), lambda j: F.get(state["table"], slot_at(j)) == -1
        )

        def filled(j: Column) -> Column:
            table = _let(slot_at(j), lambda s: F.transform(state["table"], lambda x, k: F.when(k == s, shard).otherwise(x)))
            following = F.transform(state["next"], lambda x, k: F.when(k == shard, F.least(j + 1, F.lit(slots - 1))).otherwise(x))
            return F.struct(table.alias("table"), following.alias("next"))

        return _let(F.get(open_turns, F.lit(0)), filled)

    full = F.aggregate(turns, empty, claim, lambda state: state["table"])
    return orders.select(F.posexplode(full).alias("slot", "shard"))


def place(
    df: DataFrame, keys: list[str], shards: int = SHARDS, slots: int = SLOTS, slot: str = "slot", shard: str = "shard"
) -> DataFrame:
    """All rows and columns of ``df`` with ``slot`` and ``shard`` (int), replacing columns of these names.

    The table has ``slots`` rows, a parameter, so broadcasting it is safe at any
    size of ``df``; rows don't move. Equal keys share a shard. A null key part
    counts as a value of its own, so null keys share a shard too; name a second
    key column where many keys are null. Empty tables stay empty.
    """
    table = lookup_table(df.sparkSession, shards, slots).select(
        F.col("slot").alias("_sh_slot"), F.col("shard").alias("_sh_shard")
    )
    hashed = df.withColumn("_sh_slot", F.pmod(key_hash(*[F.col(k) for k in keys]), F.lit(slots)).cast("int"))
    placed = hashed.join(F.broadcast(table), "_sh_slot")
    return placed.withColumns({slot: F.col("_sh_slot"), shard: F.col("_sh_shard")}).drop("_sh_slot", "_sh_shard")


def write_shards(placed: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder per shard. A hint, not a key, deals the rows out, so a full shard is written by many tasks."""
    placed.hint("rebalance", shard).write.partitionBy(shard).parquet(path)
