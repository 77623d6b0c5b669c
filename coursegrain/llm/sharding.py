"""Shard placement by a permutation-filled lookup table.

Every shard has a preference order over the slots of a table of prime size: it
starts at an offset and walks with a stride, both from hashes of its name, so
the walk visits every slot.  The shards take turns; each claims its first free
preference.  Shares differ by one slot at most, and taking a shard away moves few
other keys.  A row's slot is its key's hash modulo the size; the table has
``SLOTS`` rows whatever the data, so it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import hash60, packed, unpacked

#: A prime, at least a hundred times the number of shards.
SLOTS = 1009
SHARDS = tuple(f"shard-{n:02d}" for n in range(10))


def lookup_table(spark: SparkSession, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(slot, shard_no, shard): one row per slot.  Names must differ; none is an error."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct, at least one and at most one per slot")
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    names = F.array(*map(F.lit, shards))
    start = F.transform(names, lambda s: hash60(s, "start:") % slots)
    stride = F.transform(names, lambda s: hash60(s, "stride:") % (slots - 1) + 1)
    one = spark.range(1).select(names.alias("names"), start.alias("start"), stride.alias("stride"))

    def turn(state: Column, no: Column) -> Column:
        shard = (no % len(shards)).cast("int")
        slot_of = lambda j: ((F.get("start", shard) + j * F.get("stride", shard)) % slots).cast("int")
        free = F.filter(
            F.sequence(F.get(state["next"], shard), F.lit(slots - 1)), lambda j: F.get(state["owner"], slot_of(j)) < 0
        )
        def claim(j: Column) -> Column:
            slot = slot_of(j)
            return F.struct(
                F.concat(F.slice(state["owner"], F.lit(1), slot), F.array(shard), F.slice(state["owner"], slot + 2, F.lit(slots))).alias("owner"),
                F.transform(state["next"], lambda x, at: F.when(at == shard, j + 1).otherwise(x)).alias("next"),
            )

        # The one-element array binds the first free preference, so that the search runs once a turn.
        return F.get(F.transform(F.slice(free, 1, 1), claim), F.lit(0))

    begin = F.struct(
        F.array_repeat(F.lit(-1), slots).alias("owner"), F.array_repeat(F.lit(0), len(shards)).alias("next")
    )
    filled = one.select("names", F.aggregate(F.sequence(F.lit(0), F.lit(slots - 1)), begin, turn)["owner"].alias("owner"))
    rows = filled.select("names", F.posexplode_outer("owner").alias("slot", "shard_no"))
    return rows.select("slot", "shard_no", F.get("names", F.col("shard_no")).alias("shard"))


def place(rows: DataFrame, key: str = "doc_id", shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """All rows and columns plus slot, shard_no and shard.

    A null key is placed like an empty one; rows with the same key share a shard.
    Input columns named like an output are replaced.
    """
    keyed = packed(rows, _at=(hash60(F.col(f"`{key}`"), "key:") % slots).cast("int"))
    found = lookup_table(rows.sparkSession, shards, slots)
    return unpacked(keyed.join(F.broadcast(found), F.col("_at") == F.col("slot")), rows.columns, "slot", "shard_no", "shard")
