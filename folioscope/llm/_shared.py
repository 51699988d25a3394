"""What several operators of this subpackage need."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.session import shared_dir

BATCH_BYTES = 16 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """These columns alone, found by their exact names.

    Other columns may have any names, also the same ones in another case or twice: columns are
    addressed by position. Of equal names the first counts.
    """
    cols = df.columns
    tmp = df.toDF(*[f"c{i}" for i in range(len(cols))])
    return tmp.select(*[F.col(f"c{cols.index(n)}").alias(n) for n in names])


def kept(df: DataFrame, spark: SparkSession, tag: str) -> DataFrame:
    """df written as a table in the shared folder and read again: cuts the lineage, survives lost executors."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Within, Python gets at most so many rows and BATCH_BYTES at a time, which bounds a worker's memory where rows are large.

    The settings are the session's; what is planned within must be executed within.
    """
    now = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}
    was = {k: spark.conf.get(k) for k in now}
    for k, v in now.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def let(value: Column, body) -> Column:
    """body(value), where value is computed once however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and U+0009..U+000D; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
