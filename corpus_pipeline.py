"""A corpus pipeline of five stages over `documents`.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes every stage's result as
Parquet in the shared folder and rereads it for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioscope.llm import decontaminate, mixing, ngram_join, quality_rules, sharding
from folioscope.llm._shared import kept
from folioscope.session import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the rule ensemble accepts."""
    return quality_rules.accepted(docs, table(spark, sf_dir, "labels"), spark)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of documents linked by 5-word shingles at a similarity of 0.8 or more."""
    return ngram_join.one_of_each(docs, spark)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents contaminated by benchmark items."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), spark)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by target weights: a row for each copy that it takes."""
    return mixing.mixed_documents(docs, spark)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the shard of each row."""
    return sharding.place(docs, slot_col="slot")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mix), ("sharding", shard)]

#: The quality classifier is fitted, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), spark, f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
