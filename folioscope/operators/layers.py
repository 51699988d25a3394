"""Settings and rules in layers: which layer's value counts, field by field."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def field_wise(rows: DataFrame, keys: Sequence[str], layer: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """keys and, for each field by itself, the value of the first layer that has one (null: none has). One aggregate with partial sums.

    layer: columns that order a key's rows; of equal ones the least value counts.
    """
    order = [F.col(c) for c in layer]
    first = lambda f: F.min(F.when(F.col(f).isNotNull(), F.struct(*order, F.col(f).alias("__v"))))["__v"]
    return rows.groupBy(*keys).agg(*[first(f).alias(f) for f in fields])


def over_defaults(defaults: Column, own: Column) -> Column:
    """A map with the defaults' entries and, where it has the key, those of its own, also if null; entries that only it has are kept."""
    return F.map_zip_with(defaults, own, lambda k, d, o: F.when(F.map_contains_key(own, k), o).otherwise(d))


def chosen_rules(rows: DataFrame, key: str, defaults: dict[str, str]) -> DataFrame:
    """key, no, rule: the rules that count for each key, each over the defaults.

    rows: (key, kind, no, rule map<string,string>). A list of rules (kind ``list``) goes before a single rule (``single``); a key that
    names neither has the defaults as its only rule.
    """
    base = F.create_map(*[F.lit(x) for kv in defaults.items() for x in kv]).cast("map<string,string>")
    rank = F.when(F.col("kind") == "list", 0).when(F.col("kind") == "single", 1).otherwise(2)
    ranked = rows.withColumn("__r", F.when(F.col("rule").isNull(), 2).otherwise(rank))
    best = ranked.withColumn("__b", F.min("__r").over(W.partitionBy(key))).where(F.col("__r") == F.col("__b"))
    named = best.where(F.col("__b") < 2).select(key, "no", over_defaults(base, F.col("rule")).alias("rule"))
    return named.unionByName(best.where(F.col("__b") == 2).select(key).distinct().select(key, F.lit(0).cast(dict(rows.dtypes)["no"]).alias("no"), base.alias("rule")))
