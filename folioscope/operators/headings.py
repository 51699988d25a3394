"""Headings of documents: those of an outline where a document has one, else lines of its pages that look like headings.

Spans are rows (document, page from 1, line, span, text, size), in the order of page, line and span; outlines are rows (document, place,
level, title, page). Lines come from one aggregate over spans, numbers of lines from one window by page, and which source counts for a document is a
semi-join, so neither a document's lines nor its headings are gathered in one place before they are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioscope.operators import tree

# How headings begin, and the marks that their titles lose at both ends.
CHAPTER = "第[一二三四五六七八九十百零〇0-9]+节"
PATTERNS = (rf"^{CHAPTER}[ 　]+", "^[一二三四五六七八九十]+[、.]", "^[(（][一二三四五六七八九十]+[)）]", "^[0-9]+[、.]", r"^[0-9]+\.[0-9]+([.．][0-9]+)*")
NUMBER = rf"^({CHAPTER}|[一二三四五六七八九十]+[、.]|[(（][一二三四五六七八九十]+[)）]|[0-9]+[、.]|[0-9]+(?:\.[0-9]+)+)"
LEVELS = ((rf"^{CHAPTER}", 1), ("^[一二三四五六七八九十]+[、.]", 2), ("^[(（][一二三四五六七八九十]+[)）]", 3), ("^[0-9]+[、.]", 3))
ENDS = "[：:;； ]"
LONGEST, OTHER_LEVEL = 60, 2
OUTLINE, BY_TEXT = "toc", "text_heading"


def level(title: Column) -> Column:
    """1 to 3 by the way a title is numbered; 2 for all others."""
    out = F.lit(OTHER_LEVEL)
    for pattern, k in reversed(LEVELS):
        out = F.when(title.rlike(pattern), k).otherwise(out)
    return out


def number(title: Column) -> Column:
    """The title's number with its mark; null without one."""
    return F.nullif(F.regexp_extract(title, NUMBER, 1), F.lit(""))


def plain(title: Column) -> Column:
    """The title without white space and without marks at its ends."""
    return F.regexp_replace(F.regexp_replace(title, r"[\s\p{Z}]+", ""), f"^{ENDS}+|{ENDS}+$", "")


def lines(spans: DataFrame, key: str) -> DataFrame:
    """key, page, line_no (from 1 on each page), text, font (mean size of the spans that have one, else 0), spans."""
    sized = F.when(F.col("size") != 0, F.col("size"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("span", F.coalesce("text", F.lit("")).alias("text")))), lambda s: s["text"])
    each = spans.groupBy(key, "page", "line").agg(F.array_join(parts, "").alias("text"), F.coalesce(F.avg(sized), F.lit(0.0)).alias("font"), F.count("*").alias("spans"))
    text = F.regexp_replace("text", r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    return each.select(key, "page", F.row_number().over(W.partitionBy(key, "page").orderBy("line")).alias("line_no"), text.alias("text"), "font", "spans")


def by_text(spans: DataFrame, key: str) -> DataFrame:
    """The lines that look like headings, scored by font, length and number of spans."""
    t = F.col("text")
    found = lines(spans, key).where((t != "") & (F.length(t) <= LONGEST) & t.rlike("|".join(PATTERNS)))
    return found.select(key, "page", "line_no", t.alias("title"), level(t).alias("level"), F.round(tree.heading_score(F.col("font"), t, F.col("spans")), 4).alias("score"), F.lit(BY_TEXT).alias("method"), F.lit(0).alias("place"))


def by_outline(outline: DataFrame, key: str) -> DataFrame:
    """The outline's entries that have a title."""
    t = F.regexp_replace("title", r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    rows = outline.select(key, F.greatest("page", F.lit(1)).alias("page"), F.lit(0).alias("line_no"), t.alias("title"), "level", F.lit(1.0).alias("score"), F.lit(OUTLINE).alias("method"), "place")
    return rows.where(F.col("title") != "")


def detected(outline: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """key, idx (from 0), level, title, plain, number, page, line_no, score, method: each document's headings from the one source that counts for it."""
    own = by_outline(outline, key)
    rest = by_text(spans.join(own.select(key).distinct(), key, "left_anti"), key)
    both = own.unionByName(rest)
    order = W.partitionBy(key).orderBy("page", "line_no", "level", "place", "title")
    return both.select(key, (F.row_number().over(order) - 1).alias("idx"), "level", "title", plain(F.col("title")).alias("plain"), number(F.col("title")).alias("number"), "page", "line_no", "score", "method")
