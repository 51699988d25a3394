"""Sinks: tables by tab, status lists, an EPUB digest."""

from __future__ import annotations

import zipfile
from collections.abc import Iterable
from html import escape

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.functions import times

PROGRAM_COLUMNS = ("key", "stock_name", "industry1", "industry2", "industry3", "publish_date", "pdf_name")
MANUAL_COLUMNS = ("score", "notes")


def tab_of(mode: str, created: Column, published: Column, today: Column) -> Column:
    """The tab of a row: one, or by the month or (ISO or Sunday) week of its creation, else publication, else today."""
    t = F.coalesce(created.cast("timestamp_ntz"), published.cast("timestamp_ntz"), today.cast("timestamp_ntz"))
    return {"single": F.lit("all"), "monthly": times.month_label(t), "weekly": times.week_label(t), "weekly_sunday": times.sunday_week_label(t), "daily": times.month_day_tab(F.coalesce(published, today))}[mode]


def sync_tab(tab: DataFrame, rows: DataFrame) -> DataFrame:
    """The tab's next rows: known keys get the program's columns, manual ones stay; others are appended."""
    from folioscope.operators.merge import upsert

    return upsert(tab, rows, ["key"], [c for c in PROGRAM_COLUMNS if c != "key"])


def key_rows(tab: DataFrame, order: str) -> DataFrame:
    """key -> row number in the sheet (from 2); of equal keys the later row; blank keys are skipped."""
    from folioscope.operators.latest import running_total

    n = running_total(tab, [F.col(order)], out="row").withColumn("row", (F.col("row") + 2).cast("int"))
    return n.where(F.trim("key") != "").groupBy("key").agg(F.max("row").alias("row"))


#: Former layouts: their headers, and what each present column is called there.
LAYOUTS = {
    ("key", "stock_name", "publish_date", "pdf_name", "score", "notes"): {},
    ("key", "stock_name", "industry", "publish_date", "pdf_name", "score", "notes"): {"industry1": "industry"},
    ("key", "stock_name", "industry1", "publish_date", "pdf_name", "score", "notes"): {},
}


def migrated(tab: DataFrame) -> DataFrame:
    """A tab in a former layout in the present one; missing columns are null."""
    if tuple(tab.columns) == PROGRAM_COLUMNS + MANUAL_COLUMNS:
        return tab
    if tuple(tab.columns) not in LAYOUTS:
        raise ValueError(f"unknown layout: {tab.columns}")
    names = LAYOUTS[tuple(tab.columns)]
    return tab.select(*[F.col(n).alias(c) if (n := names.get(c, c)) in tab.columns else F.lit(None).cast("string").alias(c) for c in PROGRAM_COLUMNS + MANUAL_COLUMNS])


def sorted_tabs(tabs: DataFrame, name: str = "tab", index: str = "index", descending: bool = True) -> DataFrame:
    """Tabs that name a period first, newest first; the rest in their order. Adds place (from 0)."""
    from pyspark.sql import Window as W

    t = F.col(name)
    month, week = F.regexp_extract(t, r"^(\d{4})-(\d{2})$", 0), F.regexp_extract(t, r"^(\d{4})-W(\d{2})$", 0)
    day = F.when(t.rlike(r"^\d{1,2}\.\d{1,2}$"), F.concat(F.lit("0000-"), F.lpad(F.substring_index(t, ".", 1), 2, "0"), F.lpad(F.substring_index(t, ".", -1), 2, "0")))
    k = F.coalesce(F.nullif(month, F.lit("")), F.nullif(week, F.lit("")), day)
    return tabs.withColumn("place", F.row_number().over(W.orderBy(k.isNull(), k.desc_nulls_last() if descending else k.asc_nulls_last(), index)) - 1)


def write_tabs(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A folder for each tab; only the tabs of these rows are replaced."""
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("tab").parquet(path)


def read_tabs(spark: SparkSession, path: str) -> DataFrame:
    """All tabs of a folder; their names stay as they were written (3.10 is not 3.1)."""
    found = spark.read.parquet(path).schema
    return spark.read.schema(T.StructType([T.StructField(f.name, T.StringType()) if f.name == "tab" else f for f in found])).parquet(path)


def snapshot(rows: DataFrame, run_date: Column, published: str = "publish_date") -> DataFrame:
    """rows with the tab ``M.D`` of their publication, or of the run where that is missing."""
    return rows.withColumn("tab", tab_of("daily", F.lit(None), F.col(published), run_date))


def sync_snapshot(rows: DataFrame, path: str) -> None:
    """Brings the tabs of rows (tab, key, ...) in a folder of tabs up to date: known keys get the program's columns, manual ones stay, others are appended.

    Only these tabs are replaced, each in one step when the job commits; a second run with the same rows changes nothing.
    """
    from folioscope.operators.merge import upsert

    spark = rows.sparkSession
    try:
        old = read_tabs(spark, path)
    except AnalysisException:  # the first run
        old = spark.createDataFrame([], rows.schema)
    tabs = rows.select("tab").distinct()
    old = old.join(tabs, "tab", "left_semi").select(old.columns)
    write_tabs(upsert(old, rows, ["tab", "key"], [c for c in rows.columns if c in PROGRAM_COLUMNS and c != "key"]), path)


def write_lists(rows: DataFrame, path: str, value: str = "value", status: str = "status") -> None:
    """A text list for each status."""
    rows.select(F.col(value).cast("string").alias("value"), status).write.mode("overwrite").partitionBy(status).text(path)


def write_epub(path: str, title: str, chapters: Iterable[tuple[str, str]]) -> None:
    """An EPUB of (heading, text) chapters: a zip whose first entry is the media type, not compressed. For few rows, on the driver."""
    page = '<?xml version="1.0" encoding="utf-8"?><html xmlns="http://www.w3.org/1999/xhtml"><head><title>{0}</title></head><body><h1>{0}</h1>{1}</body></html>'
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(zipfile.ZipInfo("mimetype"), "application/epub+zip", zipfile.ZIP_STORED)
        z.writestr("META-INF/container.xml", '<?xml version="1.0"?><container version="1.0" xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="content.opf" media-type="application/oebps-package+xml"/></rootfiles></container>')
        names = []
        for i, (head, text) in enumerate(chapters):
            body = "".join(f"<p>{escape(s.strip())}</p>" for s in text.split("\n") if s.strip())
            z.writestr(f"c{i}.xhtml", page.format(escape(head), body))
            names.append(f"c{i}")
        items = "".join(f'<item id="{n}" href="{n}.xhtml" media-type="application/xhtml+xml"/>' for n in names)
        spine = "".join(f'<itemref idref="{n}"/>' for n in names)
        z.writestr("content.opf", f'<?xml version="1.0"?><package xmlns="http://www.idpf.org/2007/opf" version="3.0" unique-identifier="id"><metadata xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:identifier id="id">{escape(title)}</dc:identifier><dc:title>{escape(title)}</dc:title><dc:language>zh</dc:language></metadata><manifest>{items}</manifest><spine>{spine}</spine></package>')


def targets_first(tabs: DataFrame, targets: DataFrame, key: str, order: str, index: str) -> DataFrame:
    """Tabs that are targets first, in the targets' order, then the others in their own. Adds place (from 0).

    Tabs of a workbook are few; the window is one task.
    """
    from pyspark.sql import Window as W

    at = targets.select(F.col(key).alias("__key"), F.col(order).alias("__order"))
    rows = tabs.join(at, F.col(key) == F.col("__key"), "left")
    by = W.orderBy(F.col("__key").isNull(), "__order", index)
    return rows.withColumn("place", F.row_number().over(by) - 1).select(*tabs.columns, "place")
