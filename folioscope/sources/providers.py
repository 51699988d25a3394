"""Providers of records by key as data sources: each is asked for the keys that the ones before it did not know, and for no others.

A provider is a data source whose reader gets the wanted keys by filter pushdown. ``asked`` goes through providers in order; what one found is
written to the shared folder before the next is asked, so a provider is not asked twice for a key, also when a task is run again later.
Set spark.sql.python.filterPushdown.enabled, which ``asked`` needs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSourceReader, EqualTo, In, InputPartition

from folioscope.functions.keys import all_filled, any_filled
from folioscope.session import shared_dir

#: Keys in one read, which are literals of its plan.
BLOCK = 5000


class _Keys(InputPartition):
    def __init__(self, keys: list):
        self.keys = keys


class KeyedReader(DataSourceReader):
    """Reads the records of the keys that a filter on column ``key`` names. Subclasses say how: ``fetch``."""

    key, batch = "code", 200

    def __init__(self, options: dict):
        self.options, self.keys = options, None

    def fetch(self, keys: list) -> Iterable[tuple]:
        raise NotImplementedError

    def pushFilters(self, filters):  # noqa: N802  the API's name
        for f in filters:
            own = {f.value} if isinstance(f, EqualTo) and f.attribute == (self.key,) else set(f.value) if isinstance(f, In) and f.attribute == (self.key,) else None
            if own is None:
                yield f
            else:
                self.keys = own if self.keys is None else self.keys & own

    def partitions(self):
        if self.keys is None:
            raise ValueError(f"this provider is read by {self.key} only")
        keys = sorted(self.keys)
        return [_Keys(keys[i : i + self.batch]) for i in range(0, len(keys), self.batch)]

    def read(self, partition) -> Iterator[tuple]:
        yield from self.fetch(partition.keys)


def _kept(df: DataFrame, spark: SparkSession) -> DataFrame:
    path = f"{shared_dir(spark)}/provider-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def asked(keys: DataFrame, on: str, providers: Sequence[str], fields: Sequence[str], rule: str = "any") -> DataFrame:
    """on, the fields and found_in of each distinct key that a provider knows; rule: any or all of the fields filled.

    Keys go to a provider in blocks of BLOCK, one read each.
    """
    spark = keys.sparkSession
    if spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") != "true":
        raise ValueError("set spark.sql.python.filterPushdown.enabled")
    missing = _kept(keys.select(on).where(F.col(on).isNotNull()).distinct(), spark)
    out: DataFrame | None = None
    filled = (any_filled if rule == "any" else all_filled)(*[F.col(f) for f in fields])
    for name in providers:
        block: list = []
        known: DataFrame | None = None

        def ask(block: list, known: DataFrame | None, name: str = name) -> DataFrame:
            rows = spark.read.format(name).load().where(F.col(on).isin(block)).where(filled).dropDuplicates([on])
            got = _kept(rows.select(on, *fields, F.lit(name).alias("found_in")), spark)
            return got if known is None else known.unionByName(got)

        for r in missing.toLocalIterator():
            block.append(r[0])
            if len(block) == BLOCK:
                known, block = ask(block, known), []
        if block:
            known = ask(block, known)
        if known is None:
            break
        out = known if out is None else out.unionByName(known)
        missing = _kept(missing.join(known.select(on), on, "left_anti"), spark)
    return out if out is not None else keys.sparkSession.createDataFrame([], f"{on} string, " + ", ".join(f"{f} string" for f in fields) + ", found_in string")
