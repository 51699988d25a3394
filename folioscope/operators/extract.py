"""Planning and running the extraction of sections from documents' page texts.

Failures are data: a document that is too long, broken or without the chapter gives a row with a status and a placeholder, and never
stops a task.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import text as X
from folioscope.functions.by_row import by_row
from folioscope.operators import chapters as C
from folioscope.operators import letters as L
from folioscope.operators import sections as S

OK, SLOW, BROKEN, EMPTY = "OK", "PARSE_TOO_SLOW", "FAILED", "NO_TEXT"
FIELDS = ("industry", "business", "future", "chairman_letter", "full_mda")

# Headings of reports without the usual chapter, and what ends their parts.
OVERVIEW = ("管理层综述", ("董事长致辞", r"第二章\s*董事会报告", "董事会报告", r"第三节\s*管理层讨论与分析", "公司治理", "重要事项"))
BOARD = (r"(?:第二章\s*)?(?:董事会报告书|董事会工作报告|董事会报告)", ("第三章", r"第三节\s*管理层讨论与分析", "公司治理", "重要事项"))
FRONT = ((r"目\s*录", ("第一[章节]",)), (r"释\s*义", (r"词\s*汇\s*表", "第一[章节]")), (r"词\s*汇\s*表", ("第一[章节]",)))
OUTLOOK = ("业务发展展望", "业务展望")
OUTLOOK_ENDS = (r"(?:[一二三四五六七八九十]{1,3}|\d{1,2})[、.．:：]", r"第\s*[一二三四五六七八九十]{1,3}\s*[章节]", r"目\s*录|释\s*义|词\s*汇\s*表", "公司治理", "重要事项", "可能面对的风险|风险因素|风险提示", r"\d\s*[.．]\s*\d")


def parse_jobs(candidates: DataFrame, complete: DataFrame, key: Sequence[str], pages: str = "pages", least: int = 50, again: bool = False) -> DataFrame:
    """Candidates whose file exists (``exists``), that are long enough and, unless all are to be read again, not complete yet."""
    some = candidates.where(F.col("exists") & (F.col(pages) >= least))
    return some if again else some.join(complete.select(*key).distinct(), list(key), "left_anti")


def image_heavy(images: Column, chars: Column, pages: Column, file_mb: Column) -> Column:
    """Whether sampled pages are mostly pictures: many images and little text; for large files, somewhat less of both."""
    mean = F.floor(chars / F.greatest(pages, F.lit(1)))
    return (images >= 20) & ((chars <= 800) | (mean <= 90)) | (F.coalesce(file_mb, F.lit(0)) >= 30) & (images >= 10) & (mean <= 180)


def _at_line(pattern: str) -> str:
    return rf"(?:^|\n)(?:{pattern})"


def alternative_sections(text: str | None, blank: str | None = None, cut: str | None = None) -> dict[str, str | None] | None:
    """Overview, board report and outlook of a report without the usual chapter; None if it has none of them.

    blank, cut: the characters that are blanks around a part, and before the mark of a cut, if not all white space.
    """
    if not text:
        return None
    t = text
    for start, ends in FRONT:
        t = S.without_block(t, _at_line(start), [_at_line(e) for e in ends])
    parts: list[str] = []
    for start, ends in (OVERVIEW, BOARD):
        p = S.between(t, _at_line(start), [_at_line(e) for e in ends], blank)
        if p and not any(p in x or x in p for x in parts):
            parts.append(p)
    business = S.truncated("\n\n".join(parts), 70_000, cut) or None
    future = None
    if found := [i for w in OUTLOOK if (i := t.find(w)) >= 0]:
        line = t.rfind("\n", 0, min(found)) + 1
        later = [m.start() for e in OUTLOOK_ENDS if (m := re.compile(rf"\n\s*(?:{e})").search(t, line + 50))]
        future = S.truncated(t[line : min(later, default=len(t))].strip(blank), 40_000, cut)
    if not business and not future:
        return None
    full = S.truncated("\n\n".join(filter(None, (business, future))), 140_000, cut)
    return {"industry": None, "business": business, "future": future, "chairman_letter": L.letter(text), "full_mda": full}


def placeholder(reason: Column | str, text: Column, least: int = 300, most: int = 6000) -> Column:
    """What stands in for a document that could not be read: the reason, and an excerpt if there is one worth showing."""
    body = C.stripped(F.regexp_replace(F.coalesce(text, F.lit("")), r"\n[\s\p{Z}]*\n", "\n"))
    excerpt = F.when(F.length(body) >= least, F.concat(F.lit("\n"), X.truncated(body, most))).otherwise("")
    return F.concat(F.lit("[PARSE_FAILED] reason="), F.lit(reason) if isinstance(reason, str) else reason, excerpt)


def _alternative_row(text: str | None) -> tuple:
    found = alternative_sections(text) or {}
    return tuple(found.get(n) for n in FIELDS)


_alternative = by_row(_alternative_row, ", ".join(f"{n} string" for n in FIELDS))


def extracted(df: DataFrame, key: str, pages: str = "pages", chars: int = C.BUDGET) -> DataFrame:
    """key, the sections, status and pages_read of each document (pages: array<string>).

    A document is read in batches of pages until they hold ``chars`` characters; what was found in them stays. OK: the chapter or other
    sections were found; NO_TEXT: there is none; PARSE_TOO_SLOW: nothing was found in what the budget allows; FAILED: nothing was found at all.
    """
    each = C.within_budget(C.paged(df, key, pages).withColumn("text", X.normalized(F.col("text"))), key, chars)
    read = each.where(~F.col("late"))
    found = C.discussions(read.drop("late"), key)
    whole = each.groupBy(key).agg(F.array_sort(F.collect_list(F.when(~F.col("late"), F.struct("page", "text")))).alias("p"), F.count(F.when(~F.col("late"), 1)).alias("pages_read"), F.max("late").alias("late"))
    whole = df.select(key).join(whole.select(key, F.array_join("p.text", "\n").alias("text"), "pages_read", "late"), key, "left").join(found, key, "left")
    usual = F.col("full_mda").isNotNull()
    text = F.coalesce("text", F.lit(""))
    whole = whole.withColumn("other", _alternative(F.when(~usual, text)))
    none = F.col("other.full_mda").isNull() & ~usual
    status = F.when(C.dense(text) == "", EMPTY).when(~none, OK).when(F.col("late"), SLOW).otherwise(BROKEN)
    own = {n: F.when(usual, F.col(n) if n in ("business", "future", "chairman_letter", "full_mda") else F.lit(None)).otherwise(F.col(f"other.{n}")) for n in FIELDS}
    own["full_mda"] = F.when(none, placeholder(status, text)).otherwise(own["full_mda"])
    return whole.select(key, *[c.alias(n) for n, c in own.items()], status.alias("status"), F.coalesce("pages_read", F.lit(0)).alias("pages_read"))


def parsed_by(df: DataFrame, key: str, pages: str, parse: Callable[[Sequence[str]], dict]) -> DataFrame:
    """key, the sections and status of each document by any function of its pages; a document that it fails on gives a row that says so."""
    names = [*FIELDS, "status"]

    def safe(p):
        try:
            return {"status": OK} | parse(p or [])
        except Exception as e:  # a bad document must not stop the others
            return {"full_mda": S.placeholder(f"{type(e).__name__}: {e}", [x for x in p or [] if isinstance(x, str)]), "status": BROKEN}

    def run(batches):
        for batch in batches:
            rows = [safe(p) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r.get(n) for r in rows], pa.string()) for n in names]], [key, *names])

    kind = dict(df.dtypes)[key]
    return df.select(key, pages).mapInArrow(run, f"{key} {kind}, " + ", ".join(f"{n} string" for n in names))
