"""Upserts and their kin on tables without a transaction log: the new state is computed, the sink writes it.

All take the target's present rows and return its next rows; columns that the target lacks are left out of a
write, columns that the source lacks keep their values (or are null on insertion).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.operators.latest import last_wins


def project_to(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """df's columns that the target has, in the target's order."""
    return df.select(*[c for c in columns if c in df.columns])


def coalesce_present(df: DataFrame, names: Sequence[str], default: str = "") -> Column:
    """The first of the columns that exist which is not null."""
    return F.coalesce(*[F.col(c) for c in names if c in df.columns], F.lit(default))


def _equal(keys: Sequence[str], a: str = "t", b: str = "s") -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return out


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None, ordinal: str | None = None) -> DataFrame:
    """Rows of source replace or extend those of target by key. Of several source rows of a key the last by ordinal counts.

    update: columns that a match overwrites (all but the keys by default), also with null; others keep the target's values.
    """
    src = last_wins(source, keys, ordinal) if ordinal else source.dropDuplicates(list(keys))
    have = [c for c in target.columns if c in src.columns]
    over = [c for c in (update if update is not None else have) if c in have and c not in keys]
    s = src.select(*have, F.lit(True).alias("__hit"))
    j = target.withColumn("__old", F.lit(True)).alias("t").join(s.alias("s"), _equal(keys), "full_outer")
    hit, old = F.col("s.__hit").isNotNull(), F.col("t.__old").isNotNull()

    def value(c: str) -> Column:
        if c in over:
            return F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        if c in have:
            return F.when(old, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))
        return F.col(f"t.{c}")

    return j.select(*[value(c).alias(c) for c in target.columns])


def replace_by_key(target: DataFrame, source: DataFrame, key: str, unique: Sequence[str] | None = None, ordinal: str | None = None) -> DataFrame:
    """All rows of the source's keys are deleted, then the source is inserted (of equal unique columns the last wins)."""
    src = last_wins(source, unique, ordinal) if unique and ordinal else source
    stay = target.join(src.select(F.col(key).alias("__k")).distinct(), F.col(key).eqNullSafe(F.col("__k")), "left_anti")
    return stay.unionByName(project_to(src, target.columns), allowMissingColumns=True)


def update_by_key(target: DataFrame, values: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Every target row of a key gets the key's values (one row for each key); others stay. Adds touched."""
    v = values.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__{c}") for c in columns])
    j = target.join(v, F.col(key) == F.col("__k"), "left")
    hit = F.col("__k").isNotNull()
    return j.select(*[F.when(hit, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns], hit.alias("touched"))


def delete_by_key(target: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return target.join(keys.select(*on).distinct(), list(on), "left_anti")


def split_by_presence(source: DataFrame, target: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key the target has, rows to append)."""
    k = target.select(*on).distinct()
    return source.join(k, list(on), "left_semi"), source.join(k, list(on), "left_anti")


def missing(wanted: DataFrame, have: DataFrame, key: str) -> DataFrame:
    """How many different keys are not there, and whether all are: one row (missing, covered)."""
    lost = wanted.select(key).where(F.col(key).isNotNull()).distinct().join(have.select(key), key, "left_anti")
    return lost.agg(F.count(F.lit(1)).alias("missing")).withColumn("covered", F.col("missing") == 0)


def shared(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """The different keys that both have."""
    return a.select(key).distinct().join(b.select(key), key, "left_semi")
