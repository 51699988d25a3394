"""Lookups with an order of sources: whole records from the first that has one, never mixed by field."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.keys import all_filled, any_filled


def _has(cols: Sequence[Column], rule: str) -> Column:
    return (any_filled if rule == "any" else all_filled)(*cols)


def chained(keys: DataFrame, on: str, sources: Sequence[tuple[str, DataFrame]], fields: Sequence[str], rule: str = "any", last: bool = False) -> DataFrame:
    """keys with the record of the first source that has one, and its name in ``found_in``.

    sources: (name, table with ``on`` unique and the fields). rule: "any" field filled or "all". last: if none
    qualifies, the last source's record is given as it is.
    """
    out = keys
    for name, t in sources:
        rec = t.select(F.col(on).alias(f"__k_{name}"), F.struct(*[F.col(f) for f in fields]).alias(f"__r_{name}"))
        out = out.join(rec, F.col(on) == F.col(f"__k_{name}"), "left")
    pick, found = F.lit(None), F.lit(None).cast("string")
    if last:
        pick, found = F.col(f"__r_{sources[-1][0]}"), F.when(F.col(f"__k_{sources[-1][0]}").isNotNull(), sources[-1][0])
    for name, _ in reversed(sources):
        ok = F.coalesce(_has([F.col(f"__r_{name}.{f}") for f in fields], rule), F.lit(False))
        pick, found = F.when(ok, F.col(f"__r_{name}")).otherwise(pick), F.when(ok, F.lit(name)).otherwise(found)
    out = out.withColumn("__pick", pick)
    return out.select(*keys.columns, *[F.col(f"__pick.{f}").alias(f) for f in fields], found.alias("found_in"))


def map_by_precedence(maps: Sequence[DataFrame], key: str) -> DataFrame:
    """The maps as one: of equal keys the row of the earliest map counts."""
    out = None
    for i, m in enumerate(maps):
        m = m.withColumn("__order", F.lit(i))
        out = m if out is None else out.unionByName(m)
    fields = [c for c in out.columns if c not in (key, "__order")]
    return out.groupBy(key).agg(F.min_by(F.struct(*fields), "__order").alias("r")).select(key, "r.*")


def hits_and_misses(df: DataFrame, found: Column) -> DataFrame:
    return df.agg(F.count_if(found).alias("hits"), F.count_if(~found).alias("misses"), F.count(F.lit(1)).alias("total"))


def name_backfill(parts: Sequence[DataFrame], key: str, name: str) -> DataFrame:
    """All keys of the parts, each once, with the first name that is not blank in the parts' order ("" if none)."""
    out = None
    for i, p in enumerate(parts):
        p = p.select(F.col(key), F.trim(F.col(name)).alias(name), F.lit(i).alias("__order"))
        out = p if out is None else out.unionByName(p)
    some = out.where(F.trim(F.col(key).cast("string")) != "")
    filled = F.min_by(F.col(name), F.when(F.col(name) != "", F.col("__order")))
    return some.groupBy(key).agg(F.coalesce(filled, F.lit("")).alias(name))


def renamed_keys(df: DataFrame, key: str, name: str) -> DataFrame:
    """Keys that have several names: key, number of names."""
    return df.groupBy(key).agg(F.countDistinct(name).alias("names")).where("names > 1")


def clamped_date(requested: Column, latest: Column) -> Column:
    """The requested date, but no later than what the source gives."""
    return F.least(requested, latest)
