"""Sharding by a permutation-filled lookup table (operator 3).

Every shard has an order of preference over the slots of a prime-sized table:
slot ``(offset + k * skip) mod size`` for k = 0, 1, ..., with offset and skip
hashed from the shard's name. The shards take turns; at its turn a shard claims
the first slot of its order that is still free. The shares of any two shards
differ by one slot at most, and adding or removing a shard moves few slots.
A row's slot is a hash of its key, so placing a row is one lookup.

Built-in functions only: the fill is one fold on one row (``shards * size``
steps at most: every step moves one shard a slot ahead), the lookup an equi
join with the table's ``size`` rows, which is broadcast; ``size`` is a
parameter and doesn't grow with the data. Placing needs no shuffle, so a hot
key costs nothing here.

Defined cases: a NULL key counts as the empty string; repeated rows land in
the same shard; an empty table gives an empty result. The operator replaces
input columns named slot or shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = 32
TABLE_SIZE = 4099
MAX_SHARDS = 255          # the fold keeps one byte a slot; 0 is a free slot


def shard_names(shards: int) -> list[str]:
    return [f"shard-{i:03d}" for i in range(shards)]


def hash32(key: Column) -> Column:
    """The first 32 bits of md5 as a number."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def _prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def lookup_table(spark: SparkSession, names: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """slot long, shard int: the filled table, one row per slot."""
    if not 0 < len(names) <= MAX_SHARDS or not _prime(size) or size <= len(names):
        raise ValueError(f"1 to {MAX_SHARDS} shards and a prime table size above their number are needed")
    n = len(names)
    of = lambda salt: F.array(*[hash32(F.lit(f"{x}:{salt}")) for x in names])
    setup = spark.range(1).select(
        F.transform(of("offset"), lambda h: h % size).alias("offset"),
        F.transform(of("skip"), lambda h: h % (size - 1) + 1).alias("skip"))
    start = F.struct(F.unhex(F.lit("00" * size)).alias("table"),
                     F.array_repeat(F.lit(0).cast("long"), n).alias("ahead"),
                     F.lit(0).alias("turn"), F.lit(0).alias("claimed"))

    def step(s: Column, _: Column) -> Column:
        turn = s["turn"]
        slot = ((F.get(F.col("offset"), turn) + F.get(s["ahead"], turn) * F.get(F.col("skip"), turn)) % size).cast("int")
        ahead = F.transform(s["ahead"], lambda x, i: F.when(i == turn, x + 1).otherwise(x))
        mark = F.unhex(F.lpad(F.hex((turn + 1).cast("long")), 2, "0"))
        claim = F.struct(
            F.concat(F.substring(s["table"], F.lit(1), slot), mark,
                     F.substring(s["table"], slot + 2, F.lit(size))).alias("table"),
            ahead.alias("ahead"), ((turn + 1) % n).alias("turn"), (s["claimed"] + 1).alias("claimed"))
        skip = F.struct(s["table"].alias("table"), ahead.alias("ahead"), turn.alias("turn"),
                        s["claimed"].alias("claimed"))
        free = F.substring(s["table"], slot + 1, F.lit(1)) == F.unhex(F.lit("00"))
        return F.when(s["claimed"] >= size, s).when(free, claim).otherwise(skip)

    filled = F.aggregate(F.sequence(F.lit(1), F.lit(n * size)), start, step, lambda s: s["table"])
    owners = F.transform(F.sequence(F.lit(1), F.lit(size)), lambda p: (
        F.conv(F.hex(F.substring(F.col("table"), p, F.lit(1))), 16, 10).cast("int") - 1))
    return (setup.select(filled.alias("table"))
            .select(F.posexplode(owners).alias("slot", "shard"))
            .select(F.col("slot").cast("long").alias("slot"), "shard"))


def assign(docs: DataFrame, key: str | Column = "doc_id", shards: int = SHARDS,
           size: int = TABLE_SIZE, names: list[str] | None = None) -> DataFrame:
    """``docs`` with slot long and shard int."""
    key = F.col(key) if isinstance(key, str) else key
    names = names or shard_names(shards)
    slot = (hash32(F.coalesce(key.cast("string"), F.lit(""))) % size).alias("slot")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("slot", "shard")]
    table = lookup_table(docs.sparkSession, names, size)
    return docs.select(*kept, slot).join(F.broadcast(table), "slot").select(*kept, "slot", "shard")
