"""Latest-per-key selection, de-duplication with stated ties, runs and group breaks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioscope.session import shared_dir


def newest_first(year: Column, published: Column, created: Column, row_id: Column) -> list[Column]:
    """The order of reports of one company: year, publication, creation, id; all descending, nulls last."""
    return [c.desc_nulls_last() for c in (year, published, created, row_id)]


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1, rank: str | None = None) -> DataFrame:
    """The first k rows of each key in the given order (which must be total to be repeatable)."""
    name = rank or "__rank"
    out = df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)
    return out if rank else out.drop(name)


def dedupe(df: DataFrame, keys: Sequence[str], by: Column, ordinal: str, tie: str = "last") -> DataFrame:
    """One row of each key: the largest ``by`` (nulls lowest); of equal ones the last or first by ordinal."""
    o = F.col(ordinal)
    return top_per_key(df, keys, [by.desc_nulls_last(), o.desc() if tie == "last" else o.asc()])


def last_wins(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    return top_per_key(df, keys, [F.col(ordinal).desc()])


def first_seen(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    return top_per_key(df, keys, [F.col(ordinal).asc()])


def latest_per_key(df: DataFrame, key: str, year: str, published: str, created: str, row_id: str) -> DataFrame:
    """The newest row of each key that is not blank."""
    some = df.where(F.trim(F.col(key).cast("string")) != "")
    return top_per_key(some, [key], newest_first(*[F.col(c) for c in (year, published, created, row_id)]))


def globally_latest(window: DataFrame, everything: DataFrame, key: str, order: Sequence[Column], row_id: str) -> DataFrame:
    """The window's rows that are their key's newest among all rows, not in the window alone."""
    newest = top_per_key(everything, [key], order).select(key, row_id)
    return window.join(newest, [key, row_id], "left_semi")


def latest_by_max_id(df: DataFrame, key: str, row_id: str) -> DataFrame:
    """Each key's row with the largest id."""
    return df.groupBy(key).agg(F.max_by(F.struct(*df.columns), row_id).alias("r")).select("r.*")


def group_breaks(df: DataFrame, part: Sequence[str], order: Sequence[Column], value: str, out: str = "is_new") -> DataFrame:
    """Marks rows whose value differs from the row before (the first always does)."""
    before = F.lag(value).over(W.partitionBy(*part).orderBy(*order))
    first = F.row_number().over(W.partitionBy(*part).orderBy(*order)) == 1
    return df.withColumn(out, first | ~before.eqNullSafe(F.col(value)))


def runs(df: DataFrame, part: Sequence[str], order: str, flag: Column) -> DataFrame:
    """Adds in_run, run_id, run_place (from 1) and run_size of consecutive rows with an equal flag."""
    seq = W.partitionBy(*part).orderBy(order)
    rows = df.withColumn("in_run", flag)
    rows = rows.withColumn("run_id", F.row_number().over(seq) - F.row_number().over(W.partitionBy(*part, "in_run").orderBy(order)))
    one = W.partitionBy(*part, "in_run", "run_id")
    return rows.withColumn("run_place", F.row_number().over(one.orderBy(order))).withColumn("run_size", F.count(F.lit(1)).over(one))


def compressed_runs(df: DataFrame, part: Sequence[str], order: str, flag: Column, least: int = 10, head: int = 3, tail: int = 3) -> DataFrame:
    """Long runs of flagged rows reduced to head and tail; dropped says how many rows stood between (on the head's last)."""
    r = runs(df, part, order, flag)
    long = F.col("in_run") & (F.col("run_size") >= least)
    keep = ~long | (F.col("run_place") <= head) | (F.col("run_place") > F.col("run_size") - tail)
    return r.where(keep).withColumn("dropped", F.when(long & (F.col("run_place") == head), F.col("run_size") - head - tail).otherwise(0))


def merged_short_lines(df: DataFrame, part: Sequence[str], order: str, line: str, most: int = 6, flush: int = 12) -> DataFrame:
    """Lines with runs of short ones (at most so many characters) joined, ``flush`` of them at a time; order is the first's."""
    r = runs(df, part, order, F.length(line) <= most)
    group = F.when(F.col("in_run"), F.floor((F.col("run_place") - 1) / flush)).otherwise(F.col("run_place"))
    one = r.groupBy(*part, "in_run", "run_id", group.alias("__g"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(line).alias("x")))), lambda e: e["x"]), "")
    return one.agg(F.min(order).alias(order), text.alias(line)).select(*part, order, line)


def running_total(df: DataFrame, order: Sequence[Column], amount: Column | None = None, out: str = "before") -> DataFrame:
    """Adds the sum of amount (1 by default) over all rows before the row in a total order.

    No task sees all rows: they are written in ranges of the order, totals of ranges (a row for each file) are summed up and added
    to the sums within each range.
    """
    spark, path = df.sparkSession, f"{shared_dir(df.sparkSession)}/ranges-{uuid.uuid4().hex}"
    df.withColumn("__amount", F.lit(1).cast("long") if amount is None else amount.cast("long")).repartitionByRange(*order).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("__range", F.input_file_name())
    ranges = rows.groupBy("__range").agg(F.sum("__amount").alias("__n"))
    up = F.sum("__n").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, 0)) - F.col("__n")
    starts = ranges.select(F.col("__range").alias("__file"), up.alias("__start"))
    own = F.sum("__amount").over(W.partitionBy("__range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)) - F.col("__amount")
    total = rows.withColumn("__own", own).join(F.broadcast(starts), F.col("__range") == F.col("__file"))  # a row for each file
    return total.withColumn(out, F.col("__start") + F.col("__own")).select(*df.columns, out)


def rolled_up(hits: DataFrame, keys: Sequence[str], weight: str, polarity: str, context: str, ordinal: str | Sequence[str]) -> DataFrame:
    """Hits of equal keys as one: their number, the strongest weight (the first of equal ones), neg if any is, the first context.

    ordinal: the columns that order the hits; together they must tell any two hits apart that differ in weight or context.
    """
    w, o = F.col(weight), F.struct(*([ordinal] if isinstance(ordinal, str) else ordinal))
    strongest = F.min_by(w, F.struct(-F.abs(w), o))
    return hits.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), strongest.alias("weight"), F.when(F.bool_or(F.col(polarity) == "neg"), "neg").otherwise("pos").alias("polarity"), F.min_by(context, F.when(F.coalesce(F.col(context), F.lit("")) != "", o)).alias("context"))
