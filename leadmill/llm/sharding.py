"""Sharding by a permutation-filled lookup table.

Every shard prefers the slots of a table of prime size in an order of its own, a walk
with an offset and a skip from its name. Shards take turns to claim their next free
slot until the table is full, so all get the same number of slots, up to one, and few
keys move when a shard comes or goes. A key is placed by its hash modulo the size: one
lookup in a broadcast table of fixed size.

The table is a configuration of the shards, built once; the rows are placed by SQL
functions alone. Keys are read as text; null is a key like any other, so all rows
without a key share a shard, unless ``salt`` columns deal them out. Equal keys meet,
repeated rows stay, columns named shard or slot are replaced, and an empty table gives
an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SIZE = 65_537
SHARDS = 64


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str], size: int = SIZE) -> list[int]:
    """The shard of each slot, by turns over the shards in their given order."""
    if not is_prime(size):
        raise ValueError(f"{size} is not a prime, so a walk would not reach every slot")
    if not 0 < len(shards) <= size or len(set(shards)) < len(shards):
        raise ValueError("shards need different names, and no more of them than slots")
    at = [number(f"{name}/offset") % size for name in shards]
    skip = [number(f"{name}/skip") % (size - 1) + 1 for name in shards]
    table, left = [-1] * size, size
    while left:
        for shard in range(min(len(shards), left)):
            while table[at[shard]] >= 0:
                at[shard] = (at[shard] + skip[shard]) % size
            table[at[shard]] = shard
        left -= min(len(shards), left)
    return table


def slot(key: Column, size: int = SIZE) -> Column:
    """A hash that any engine with MD5 can repeat: its first 15 hexadecimal digits as a number."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint"), F.lit(size)).cast("int")


def place(df: DataFrame, key: str, shards: Sequence[str], size: int = SIZE, salt: Sequence[str] = ()) -> DataFrame:
    """``df`` with slot and shard; rows that differ in ``salt`` may be placed apart."""
    table = [(i, shards[s]) for i, s in enumerate(lookup_table(shards, size))]
    slots = df.sparkSession.createDataFrame(table, "slot int, shard string")
    whole = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in [key, *salt]]) if salt else F.col(key)
    return df.drop("shard").withColumn("slot", slot(whole, size)).join(F.broadcast(slots), "slot")  # ``size`` rows


def write(placed: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """One folder per shard. A shard's rows go to as many tasks as its slots spread over, so none is one task's work."""
    n = max(1, int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed.repartition(n, "shard", "slot").write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path)


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]
