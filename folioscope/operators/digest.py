"""Digest rows: reports with their texts and aggregated hits, ranked and cut."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioscope.operators.latest import running_total


def hit_totals(hits: DataFrame, key: str, label: str, weight: str, count: str, ties: Sequence[str] = (), sep: str = "；") -> DataFrame:
    """Per key: score_total and the labels with their counts, strongest first (ties by label and the given columns)."""
    value = F.col(weight).cast("double") * F.col(count)
    shown = F.concat(F.col(label).cast("string"), F.lit("("), F.col(count).cast("long").cast("string"), F.lit(")"))
    entry = F.struct((-F.abs(value)).alias("o"), F.col(label).alias("l"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(ties)], shown.alias("s"))
    return hits.groupBy(key).agg(F.sum(value).cast("long").alias("score_total"), F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["s"]), sep).alias("hit_list"))


def hit_details(hits: DataFrame, key: str, label: str, weight: str, count: str, context: str) -> DataFrame:
    """Per key the hits as structs, strongest first; contexts on one line."""
    e = F.struct((-F.abs(F.col(weight) * F.col(count))).alias("o"), F.col(label).alias("label"), F.col(weight).alias("weight"), F.col(count).alias("count"), F.regexp_replace(F.coalesce(F.col(context), F.lit("")), "[\r\n]+", " ").alias("context"))
    return hits.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(e)), lambda x: F.struct(x["label"].alias("label"), x["weight"].alias("weight"), x["count"].alias("count"), x["context"].alias("context"))).alias("details"))


def written_details(details: Column) -> Column:
    """label|weight|count|context, a line for each hit."""
    return F.array_join(F.transform(details, lambda d: F.concat_ws("|", d["label"], d["weight"].cast("string"), d["count"].cast("string"), d["context"])), "\n")


def parsed_details(text: Column, most: int = 10) -> Column:
    """Hit lines back as structs: bad numbers are 0; of equal contexts (but for white space) the first; then the first ``most``."""
    rows = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda s: F.trim(s) != "")
    cells = F.transform(rows, lambda s: F.split(s, r"\|", 4))
    num = lambda c: F.coalesce(F.try_to_number(c, F.lit("S999999")).cast("int"), F.lit(0))
    made = F.transform(cells, lambda c: F.struct(F.get(c, F.lit(0)).alias("label"), num(F.trim(F.get(c, F.lit(1)))).alias("weight"), num(F.trim(F.get(c, F.lit(2)))).alias("count"), F.coalesce(F.get(c, F.lit(3)), F.lit("")).alias("context")))

    def first_of(xs: Column) -> Column:
        bare = F.transform(xs, lambda x: F.regexp_replace(x["context"], r"(?U)\s+", ""))
        return F.filter(xs, lambda x, i: (F.regexp_replace(x["context"], r"(?U)\s+", "") == "") | (F.array_position(bare, F.regexp_replace(x["context"], r"(?U)\s+", "")) == i + 1))

    return F.slice(F.element_at(F.transform(F.array(made), first_of), 1), 1, most)


def digest(reports: DataFrame, texts: DataFrame, totals: DataFrame, key: str) -> DataFrame:
    """reports joined to their texts (inner) and hit totals (left; 0 and "" without hits)."""
    t = totals.select(F.col(key).alias("__k"), "score_total", "hit_list")
    out = reports.join(texts, key).join(t, F.col(key) == F.col("__k"), "left").drop("__k")
    return out.withColumn("score_total", F.coalesce("score_total", F.lit(0).cast("long"))).withColumn("hit_list", F.coalesce("hit_list", F.lit("")))


def by_score(score: Column, day: Column, code: Column) -> list[Column]:
    return [score.desc_nulls_last(), day.desc_nulls_last(), code.asc_nulls_last()]


def by_time(created: Column, day: Column, code: Column) -> list[Column]:
    return [F.date_trunc("second", created).desc_nulls_last(), day.desc_nulls_last(), code.asc_nulls_last()]


def by_year(year: Column, day: Column, row_id: Column, code: Column) -> list[Column]:
    return [c.desc_nulls_last() for c in (year, day, row_id, code)]


def ranked(df: DataFrame, order: Sequence[Column], k: int | None = None, part: Sequence[str] = ()) -> DataFrame:
    """Rows with their rank from 1. The first k only, if given: that is a top-k plan, without a part; else a window.

    Without a part and k all rows get a number in one sequence, from a range-partitioned sort and offsets, not one task; the order should be total.
    """
    if part:
        out = df.withColumn("rank", F.row_number().over(W.partitionBy(*part).orderBy(*order)))
        return out if k is None else out.where(F.col("rank") <= k)
    if k is not None:
        top = df.orderBy(*order).limit(k)
        return top.withColumn("rank", F.row_number().over(W.orderBy(*order)))
    return running_total(df, order, out="rank").withColumn("rank", (F.col("rank") + 1).cast("int"))


def badge(hits: Column, most: int = 4) -> Column:
    """The strongest hits as keyword×count(±points), joined by ；."""
    strong = F.transform(F.array_sort(F.transform(hits, lambda h, i: F.struct((-F.abs(h["weight"] * h["count"])).alias("o"), i.alias("i"), h.alias("h")))), lambda x: x["h"])
    one = lambda h: F.concat(h["keyword"], F.lit("×"), h["count"].cast("string"), F.lit("("), F.when(h["weight"] * h["count"] > 0, "+").otherwise(""), (h["weight"] * h["count"]).cast("string"), F.lit(")"))
    return F.array_join(F.slice(F.transform(strong, one), 1, most), "；")


def visible(score: Column, hits: Column) -> Column:
    """Rows to show: all but those with a score of 0 and no hits."""
    return ~((F.coalesce(score, F.lit(0)) == 0) & (F.trim(F.coalesce(hits, F.lit(""))) == ""))


def of_publish_year(day: Column, year: int) -> Column:
    return F.coalesce(F.year(day) == year, F.lit(False))
