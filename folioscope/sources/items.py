"""A sink of items that are written as a whole or not at all, as a data source with commit and abort.

Rows (item, ordinal, body) of an item are a group. A task writes each item that is sound to a file of its own in a staging folder, and gives a reason for each
that is not. The driver publishes all of a run's items and failures by one manifest, which appears in one step; a run that dies leaves files that no
manifest names, and takes those of its tasks that ended away. Readers see what manifests name, of several the latest for each item.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

SCHEMA = "item string, ordinal long, body string"


def _store(address: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(address)


def _put(address: str, text: str) -> None:
    """A file that appears in one step."""
    store, path = _store(address)
    store.create_dir(path.rpartition("/")[0])
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(tmp) as f:
        f.write(text.encode())
    store.move(tmp, path)


@dataclass
class Written(WriterCommitMessage):
    files: dict[str, str] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)


class ItemWriter(DataSourceWriter):
    """Items to <path>/staged, manifests to <path>/batches; path is the address of a folder that driver and executors share."""

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")

    def check(self, item: str, bodies: list[str | None]) -> None:
        """Raises if the item must not be written."""
        if any(b is None for b in bodies):
            raise ValueError("a part is missing")

    def write(self, iterator: Iterator) -> Written:
        out, folder = Written(), uuid.uuid4().hex
        for item, rows in groupby(iterator, key=lambda r: r[0]):
            bodies = [r[2] for r in rows]
            try:
                self.check(item, bodies)
            except Exception as e:  # the others go on
                out.failures[item] = f"{type(e).__name__}: {e}"
                continue
            at = f"{self.path}/staged/{folder}/{len(out.files)}.json"
            _put(at, json.dumps({"item": item, "bodies": bodies}, ensure_ascii=False))
            out.files[item] = at
        return out

    def commit(self, messages) -> None:
        done = Written()
        for m in filter(None, messages):
            done.files |= m.files
            done.failures |= m.failures
        lines = [{"item": i, "file": f, "reason": None} for i, f in done.files.items()] + [{"item": i, "file": None, "reason": r} for i, r in done.failures.items()]
        if lines:
            stamp = time.time_ns()
            _put(f"{self.path}/batches/{stamp}-{uuid.uuid4().hex}.json", "\n".join(json.dumps(x | {"batch": stamp}, ensure_ascii=False) for x in lines))

    def abort(self, messages) -> None:
        for m in filter(None, messages):
            for f in m.files.values():
                store, path = _store(f)
                store.delete_file(path)


class Items(DataSource):
    """df.write.format("items").option("path", address).mode("append").save(); see ``write_items``."""

    @classmethod
    def name(cls) -> str:
        return "items"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite):
        return ItemWriter(self.options)


def write_items(rows: DataFrame, address: str, source: str = "items") -> None:
    """Rows (item, ordinal, body): all of an item in one task, in their order."""
    rows.select("item", F.col("ordinal").cast("long"), "body").repartition("item").sortWithinPartitions("item", "ordinal").write.format(source).option("path", address).mode("append").save()


def batches(spark: SparkSession, address: str) -> DataFrame:
    """item, file, reason of the latest batch that names the item."""
    every = spark.read.schema("item string, file string, reason string, batch long").json(f"{address.rstrip('/')}/batches")
    last = W.partitionBy("item").orderBy(F.desc("batch"))
    return every.withColumn("k", F.row_number().over(last)).where("k = 1").select("item", "file", "reason")


def items(spark: SparkSession, address: str) -> DataFrame:
    """item, bodies of the items whose latest batch has them."""
    have = batches(spark, address).where("file IS NOT NULL")
    staged = spark.read.schema("item string, bodies array<string>").option("recursiveFileLookup", "true").json(f"{address.rstrip('/')}/staged")
    name = lambda c: F.regexp_extract(c, r"[^/]+/[^/]+$", 0)  # noqa: E731  folder and file
    named = staged.select("item", "bodies", name(F.input_file_name()).alias("name"))
    return named.join(have.select(F.col("item").alias("i"), name(F.col("file")).alias("n")), (F.col("item") == F.col("i")) & (F.col("name") == F.col("n"))).select("item", "bodies")
