"""Readers: report scans, maps from CSV and JSON, files."""

from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import keys, times
from folioscope.operators.latest import last_wins


def jdbc_table(spark: SparkSession, url: str, table: str, predicates: list[str], **properties) -> DataFrame:
    """A database table read by one task for each predicate (they must cover the rows without overlap)."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def scan(rows: DataFrame, where: Column, order: list[Column]) -> DataFrame:
    return rows.where(where).orderBy(*order)


def to_score(rows: DataFrame, report_id: int | None = None, start: datetime | None = None, since_days: int | None = None, today: date | None = None) -> DataFrame:
    """Rows to score, newest publication first: by id, else created from start on, else published in the last days."""
    if report_id is not None:
        where = F.col("id") == report_id
    elif start is not None:
        where = F.col("created_at") >= F.lit(start)
    elif since_days is not None and today is not None:
        where = F.col("publish_date") >= F.date_sub(F.lit(today), since_days)
    else:
        raise ValueError("either a report, a start or a number of days is needed")
    return scan(rows, where, [F.col("publish_date").desc_nulls_last(), F.col("id").desc_nulls_last()])


def on_day(day: Column, d: date) -> Column:
    return day == F.lit(d)


def between_days(day: Column, first: date, last: date) -> Column:
    """Closed on both ends."""
    return day.between(F.lit(first), F.lit(last))


def after_until(t: Column, start: datetime, end: datetime) -> Column:
    """Open at the start, closed at the end: windows that follow each other share no row."""
    return (t > F.lit(start)) & (t <= F.lit(end))


def csv_map(spark: SparkSession, path: str) -> DataFrame:
    """code, l1, l1_code from a CSV with a header (stock_code or code, sw_l1 or industry, ...); rows without code or l1 are left out."""
    raw = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    raw = raw.toDF(*[c.lstrip("﻿").strip() for c in raw.columns])
    first = lambda *names: keys.first_filled(*[F.col(n) for n in names if n in raw.columns]) if any(n in raw.columns for n in names) else F.lit(None).cast("string")
    out = raw.select(keys.normal_code(first("stock_code", "code")).alias("code"), first("sw_l1", "industry").alias("l1"), first("sw_l1_code", "industry_code").alias("l1_code"), F.monotonically_increasing_id().alias("o"))
    return last_wins(out.where("code IS NOT NULL AND l1 IS NOT NULL"), ["code"], "o").drop("o")


def json_map(spark: SparkSession, path: str) -> DataFrame:
    """code, l1, l1_code from a JSON object whose values are lists [l1, l1_code] or objects; an envelope's "data" is looked into."""
    return json_map_of(spark.read.text(path, wholetext=True))


def json_map_of(text: DataFrame) -> DataFrame:
    """The same from rows (value), each a JSON object."""
    entries = text.select(F.explode(F.coalesce(F.from_json(F.get_json_object("value", "$.data"), "map<string,string>"), F.from_json("value", "map<string,string>"))).alias("code", "v"))
    pick = lambda i, *names: F.coalesce(F.get(F.from_json("v", "array<string>"), F.lit(i)), *[F.get_json_object("v", f"$.{n}") for n in names])
    return entries.select(keys.normal_code(F.col("code")).alias("code"), pick(0, "sw_l1", "industry", "l1").alias("l1"), pick(1, "sw_l1_code", "industry_code", "l1_code").alias("l1_code")).where("code IS NOT NULL AND l1 IS NOT NULL")


def json_or(path: str, default):
    """A small JSON file of settings; the default if it is missing or broken."""
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except (OSError, ValueError):
        return default


def files(spark: SparkSession, root: str, pattern: str = "*.pdf") -> DataFrame:
    """Files below root: path, length, modificationTime, content."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)


def with_digest(df: DataFrame) -> DataFrame:
    return df.withColumn("md5", F.md5("content"))


def candidates(raw: DataFrame, start: Column, end: Column, least_year: int, code: str | None = None, reject: tuple[str, ...] = ("200", "201", "900")) -> DataFrame:
    """Announcements (title, stock_code, stock_name, ts) that are annual reports in the closed window, with their year."""
    t = times.from_epoch(F.col("ts"))
    out = raw.where(keys.title_is_report(F.col("title"))).withColumn("year", keys.title_year(F.col("title"))).where(F.col("year") >= least_year)
    out = out.where(keys.all_filled(F.col("stock_code"), F.col("stock_name")) & F.col("ts").isNotNull() & (t >= start) & (t <= end))
    for p in reject:
        out = out.where(~F.startswith(F.col("stock_code"), F.lit(p)))
    return out if code is None else out.where(F.col("stock_code") == code)
