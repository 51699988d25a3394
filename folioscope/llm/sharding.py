"""Placing rows on shards through a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size, and the
shards take turns claiming the next free slot of their order until the table is full. A row's key
is hashed to a slot and the slot names the shard. A shard that joins or leaves moves few keys
besides its own. The table has a fixed size (a parameter), so broadcasting it is bounded, and
placing a row is one hash and one look-up whatever the number of shards.

Defined results: a null key is placed like the empty string; repeated keys go to the same shard;
an empty input gives an empty result; other columns are kept as they are.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLE_SIZE, SHARDS = 4099, 32
_HEX = 15  # hex digits of md5 that make a key's number: 60 bits, so it is never negative


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:_HEX], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


@lru_cache(maxsize=16)
def lookup_table(shards: tuple[str, ...], size: int = TABLE_SIZE, weights: tuple[int, ...] | None = None) -> tuple[int, ...]:
    """slot -> index of the shard that claimed it.

    weights: turns that each shard has in a round (1 each by default).
    """
    if not is_prime(size):
        raise ValueError(f"the table's size must be prime, not {size}")
    if not shards or len(shards) > size or len(set(shards)) < len(shards):
        raise ValueError("shards must have names of their own, and no more than slots")
    turns = weights or (1,) * len(shards)
    if len(turns) != len(shards) or min(turns) < 0 or not any(turns):
        raise ValueError("there must be a weight for each shard, and one above 0")
    at = [_number(f"offset:{s}") % size for s in shards]
    step = [_number(f"skip:{s}") % (size - 1) + 1 if size > 1 else 1 for s in shards]
    owner, free = [-1] * size, size
    while free:
        for i, n in enumerate(turns):
            for _ in range(n):
                if not free:
                    break
                while owner[at[i]] >= 0:  # step and size have no common divisor, so every slot comes by
                    at[i] = (at[i] + step[i]) % size
                owner[at[i]] = i
                free -= 1
    return tuple(owner)


def shard_names(n: int) -> tuple[str, ...]:
    return tuple(f"shard-{i:05d}" for i in range(n))


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text), 1, _HEX), 16, 10).cast("long") % size).cast("int")


def place(df: DataFrame, key: str = "doc_id", shards: tuple[str, ...] | int = SHARDS, size: int = TABLE_SIZE, weights: tuple[int, ...] | None = None, shard_col: str = "shard", slot_col: str | None = None) -> DataFrame:
    """df's rows with the index of their shard in shard_col (and their slot in slot_col, if named)."""
    names = shard_names(shards) if isinstance(shards, int) else tuple(shards)
    owners = ",".join(map(str, lookup_table(names, size, weights)))
    spark, cols = df.sparkSession, df.columns
    lookup = spark.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("__slot", "__shard")).select("__slot", F.col("__shard").cast("int").alias("__shard"))
    inner = [f"c{i}" for i in range(len(cols))]
    rows = df.toDF(*inner)
    rows = rows.withColumn("__at", slot_of(F.col(f"c{cols.index(key)}"), size))
    out = rows.join(F.broadcast(lookup), F.col("__at") == F.col("__slot"))
    own = [shard_col] + ([slot_col] if slot_col else [])
    return out.select(*[F.col(c).alias(n) for c, n in zip(inner, cols, strict=True) if n not in own], *([F.col("__at").alias(slot_col)] if slot_col else []), F.col("__shard").alias(shard_col))


def write_shards(df: DataFrame, path: str, key: str = "doc_id", shards: tuple[str, ...] | int = SHARDS, size: int = TABLE_SIZE, slices: int = 1) -> None:
    """Writes df as one folder for each shard. slices: files (and tasks) that share a shard's rows.

    A file holds each name once, whatever its case: of columns whose names clash (also with "shard") the first keeps its name, later
    ones get a number (Text_2).
    """
    placed = place(df.toDF(*_apart(df.columns, key)), key, shards, size)
    salt = F.pmod(F.xxhash64(F.col(key)), F.lit(slices))
    placed.repartition(F.col("shard"), salt).write.mode("overwrite").partitionBy("shard").parquet(path)


def _apart(names: list[str], key: str) -> list[str]:
    """The names with numbers after those that, but for their case, are "shard", the key or one before."""
    taken, out = {"shard", key.lower()}, []
    own = names.index(key)
    for i, name in enumerate(names):
        new, n = name, 1
        while i != own and new.lower() in taken:
            n += 1
            new = f"{name}_{n}"
        taken.add(new.lower())
        out.append(new)
    return out


def sql(shards: int = SHARDS, size: int = TABLE_SIZE) -> str:
    """DuckDB SQL for the placements of `documents`."""
    owners = ",".join(map(str, lookup_table(shard_names(shards), size)))
    return f"""
WITH s AS (SELECT doc_id, source, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {_HEX}))::BIGINT % {size} AS INTEGER) AS slot FROM documents),
t AS (SELECT [{owners}] AS owners)
SELECT doc_id, source, slot, CAST(owners[slot + 1] AS INTEGER) AS shard FROM s, t"""
