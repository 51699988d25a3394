"""The management discussion of paged reports, located by a query over a table of pages.

Pages are rows (document, number from 0, text). Each page is classified by column expressions; the first qualifying page of a document and
the interval of pages up to the next chapter come from windows over its pages, so a table of pages is dealt out by document once and
everything else (choice of pages, texts of chapters, parts of these) follows without another exchange.

A document's pages are one group of the windows, as many as a report has. Blank pages are as good as missing. Documents without a chapter
have no row in ``chapters``; ``located`` keeps nothing of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioscope.functions import text as X
from folioscope.functions.by_row import by_row
from folioscope.operators import letters as L
from folioscope.operators import sections as S

# Titles and numbers of the chapter, words of pages that point to it, pages that are lists, phrases that begin the
# chapter's text, tables that come before it, and what shows that a later chapter has begun. Patterns mean the same to Java and RE2.
B = r"[\s\p{Z}]*"
ORDINAL = r"(?:[一二三四五六七八九十]{1,3}|[0-9]{1,2})"
MARK = r"[、.．:：]"
TITLE = "(?:管理层|经营情况)讨论[与和]分析"
TITLE_LINE = rf"^(?:第[一二三四五六七八九十0-9]{{1,3}}节|第三部分|第三章)?{TITLE}$"
TITLE_WITHIN = rf"第三节{B}{TITLE}"
NAMES_IT = "管理层讨论与分析|经营情况讨论与分析"
POINTS = "详见|请查阅|参阅"
CAUTIONS = "风险提示|重要提示"
QUOTES = "[“”\"'《》]"
LISTS = rf"目{B}录|释{B}义|词{B}汇{B}表|名词解释|备查文件目录"
LEADER_MARKS = ("......", "·", "…")
LEADER = r"[.·…]{6,}.*[0-9]{1,4}\s*$"
ITEM = rf"第{B}{ORDINAL}{B}(?:节|章|部分)"
ANCHOR = rf"报告期内公司(?:所从事的主要业务|从事的(?:主要)?业务)|(?:^|\n){B}{ORDINAL}{MARK}{B}报告期内公司所?(?:从事|经营)的(?:主要)?业务情况|(?:^|\n){B}(?:业务概述|业务情况|主要业务)(?:[^\p{{L}}\p{{N}}_]|$)"
NEAR_ANCHOR = rf"报告期内公司所?(?:从事|经营)的(?:主要)?业务情况|报告期内公司所从事的主要业务、经营模式|(?:^|\n){B}{ORDINAL}{MARK}{B}(?:业务概述|业务情况|主要业务)(?:[^\p{{L}}\p{{N}}_]|$)"
FIGURES = "分季度主要财务指标|非经常性损益"
LATER = rf"(?:^|\n){B}第{B}(?:[四五六七八九十]|[4-9]|1[0-9]){B}节|第{B}[四4]{B}节|(?:^|\n){B}0?4{B}公司治理|公司治理、环境和社会|(?:^|[^\p{{L}}\p{{N}}_]){B}(?:(?:十{B}二|12){B}{MARK}?{B}报告期内接待调研|(?:十{B}三|13){B}{MARK}?{B}市值管理)"
#: Where a chapter's text begins, the first that it has.
BEGINS = ("管理层讨论[与和]分析", "经营情况讨论[与和]分析", rf"(?:^|\n){B}一、报告期内公司从事的主要业务", "报告期内公司从事的主要业务", rf"(?:^|\n){B}{ORDINAL}{MARK}{B}报告期内公司从事的业务情况", "报告期内公司从事的业务情况")
#: Titles that end the overview; the last one ends it wherever it stands.
STOPS = ("核心竞争力分析", "主营业务分析", "公司治理", "重要事项", "未来发展的展望", "风险因素", "风险提示", "经营情况讨论与分析")
STOP_LINE = rf"\n{B}(?:{ORDINAL}{MARK}|[（(][一二三四五六七八九十0-9]{{1,3}}[）)]){B}[^\n]{{0,72}}?(?:{'|'.join(STOPS)})"
CORE_LINE = rf"\n{B}{ORDINAL}{MARK}{B}[^\n]{{0,80}}核心竞争力分析"

FIRST, LAST_TITLE, LAST_ANCHOR, NEAR, LONGEST = 6, 159, 179, 12, 160
LEAST_OVERVIEW, LEAST_OUTLOOK, LETTER_PAGES = 500, 200, 25
#: Pages in a batch, and the characters after which no further batch of a document is read.
BATCH, BUDGET = 20, 2_000_000


def dense(c: Column) -> Column:
    return F.regexp_replace(c, r"[\s\p{Z}]+", "")


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def _has(text: Column, *words: str) -> Column:
    """Whether the text has one of the words. A search of bytes: it goes before expressions that can match with them alone."""
    out = F.contains(text, F.lit(words[0]))
    for w in words[1:]:
        out = out | F.contains(text, F.lit(w))
    return out


def is_list(text: Column) -> Column:
    """A table of contents, a glossary or another list."""
    leaders = F.size(F.filter(F.split(text, "\n"), lambda ln: ln.rlike(LEADER)))
    named = _has(text, "录", "义", "表", "名词解释") & text.rlike(LISTS)
    return named | (_has(text, *LEADER_MARKS) & (leaders >= 3)) | (_has(text, "第") & (F.regexp_count(text, F.lit(ITEM)) >= 8))


def has_title(text: Column) -> Column:
    """The chapter's heading stands on the page: as a line of its own, or within a short line that is no reference to it."""
    page = dense(text)
    elsewhere = page.rlike(NAMES_IT) & page.rlike(f"{POINTS}|{CAUTIONS}")
    own_line = F.exists(F.split(text, "\n"), lambda ln: dense(ln).rlike(TITLE_LINE))
    line = F.regexp_extract(text, rf"(?md)^[^\n]*{TITLE_WITHIN}[^\n]*", 0)  # tried at a line's start alone: linear in long lines
    around = dense(F.regexp_extract(text, rf"(?s).{{0,30}}{TITLE_WITHIN}.{{0,30}}", 0))
    within = (line != "") & ~line.rlike(QUOTES) & (F.length(dense(line)) <= 60) & ~around.rlike(POINTS)
    return _has(text, "讨") & _has(text, "论") & ~elsewhere & (own_line | within)


def paged(df: DataFrame, key: str, pages: str = "pages") -> DataFrame:
    """key, page, text: a row for each page of an array of texts."""
    return df.select(F.col(key).alias(key), F.posexplode(pages).alias("page", "text"))


def within_budget(pages: DataFrame, key: str, chars: int = BUDGET, batch: int = BATCH) -> DataFrame:
    """Adds late: the batches of pages before this page's already hold ``chars`` characters of the document.

    The budget counts characters, not seconds, so every run and machine reads the same pages.
    """
    number = F.floor(F.col("page") / batch)
    before = W.partitionBy(key).orderBy(number).rangeBetween(W.unboundedPreceding, -1)
    return pages.withColumn("late", F.coalesce(F.sum(F.length("text")).over(before), F.lit(0)) >= chars)


def located(pages: DataFrame, key: str) -> DataFrame:
    """key, page, text, how, first_page, end_page: the pages of each document's chapter.

    The chapter begins on the first page of 6..159 with its title (how: title), else the first of 6..179 with a phrase that begins its text (how:
    anchor), lists left out. If that page is not where the text is, one of the next NEAR pages with title or phrase, but without tables of figures, is.
    It ends before the first page with a mark of a later chapter, after LONGEST pages at most.
    """
    text = F.col("text")
    business = _has(text, "业务")
    flags = {"list": is_list(text), "title": has_title(text), "anchor": business & text.rlike(ANCHOR), "near": business & text.rlike(NEAR_ANCHOR), "figures": _has(text, *FIGURES.split("|")), "later": _has(text, "节", "公司治理", "接待调研", "市值管理") & text.rlike(LATER)}
    rows = pages.where(text.rlike(r"[^\s\p{Z}]")).select(key, "page", "text", *[c.alias(f"__{n}") for n, c in flags.items()])
    doc, page = W.partitionBy(key), F.col("page")
    least = lambda cond: F.min(F.when(cond, page)).over(doc)
    on = {n: F.col(f"__{n}") for n in flags}
    rows = rows.withColumn("__t", least(on["title"] & ~on["list"] & page.between(FIRST, LAST_TITLE))).withColumn("__a", least(on["anchor"] & ~on["list"] & page.between(FIRST, LAST_ANCHOR)))
    rows = rows.withColumn("__s", F.coalesce("__t", "__a")).where(F.col("__s").isNotNull())
    rows = rows.withColumn("first_page", F.coalesce(least((on["title"] | on["near"]) & ~on["list"] & ~on["figures"] & page.between(F.col("__s"), F.col("__s") + NEAR - 1)), "__s"))
    most = F.col("first_page") + LONGEST
    rows = rows.withColumn("end_page", F.coalesce(least(on["later"] & (page >= F.col("first_page")) & (page < most)), most))
    kept = rows.where((page >= F.col("first_page")) & (page < F.col("end_page")))
    return kept.select(key, "page", "text", F.when(F.col("__t").isNotNull(), "title").otherwise("anchor").alias("how"), "first_page", "end_page")


def from_beginning(text: Column) -> Column:
    """The text from the chapter's title, or else from a phrase that begins it."""
    found = [F.nullif(F.regexp_extract(text, f"(?s)(?:{p}).*", 0), F.lit("")) for p in BEGINS]
    return stripped(F.coalesce(*found, text))


def overview(chapter: Column) -> Column:
    """The chapter up to the analysis of core competence, else up to the first of the titles that end it; the whole if that is short."""
    cut = F.when(chapter.rlike(CORE_LINE), F.get(F.split(chapter, CORE_LINE, 2), F.lit(0))).otherwise(F.get(F.split(chapter, STOP_LINE, 2), F.lit(0)))
    return F.when(F.length(stripped(cut)) < LEAST_OVERVIEW, chapter).otherwise(stripped(cut))


def chapters(pages: DataFrame, key: str) -> DataFrame:
    """key, how, first_page, n_pages, full_mda, business."""
    each = located(pages, key).groupBy(key, "how", "first_page").agg(F.count("*").alias("n_pages"), F.array_sort(F.collect_list(F.struct("page", "text"))).alias("p"))
    whole = each.select(key, "how", "first_page", "n_pages", from_beginning(F.array_join("p.text", "\n")).alias("full_mda"))
    return whole.withColumn("business", overview(F.col("full_mda")))


_outlook = by_row(lambda t: None if t is None else S.outlook(t, LEAST_OUTLOOK))
letter_of = by_row(L.letter)


def letters(pages: DataFrame, key: str) -> DataFrame:
    """key, chairman_letter of each document: the letter on its first pages."""
    front = pages.where(F.col("page") < LETTER_PAGES).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("page", "text"))).alias("p"))
    return front.select(key, letter_of(X.letter_text(F.array_join("p.text", "\n"))).alias("chairman_letter"))


def discussions(pages: DataFrame, key: str) -> DataFrame:
    """key, how, first_page, n_pages, full_mda, business, future, chairman_letter of each document with a chapter."""
    found = chapters(pages, key).withColumn("future", _outlook(F.col("full_mda")))
    return found.join(letters(pages, key), key, "left")
