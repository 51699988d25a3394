"""Text operators as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a masked character becomes: no keyword contains it.
MASK = "█"
SENTENCE_ENDS = "[。！？!?；;]"

# Line filters and markers of report texts (must equal those that reports are read with).
PAGE_NUMBER = r"(?Ud)^\d{1,4}$"
PAGE_OF = r"(?Ud)^\d{1,4}\s*/\s*\d{1,4}$"
BORDER = r"^[-+|]{3,}$"
TOC_LEADER = r"(?Ud)[\.．·…]{2,}\s*\d{1,4}\s*$"
TOC_TAIL = r"(?Ud)\s(?!19\d\d$|20\d\d$)\d{1,4}$"
TABLE_WORDS = r"单位[:：]|同比增减|金额|占比|毛利率|营业收入|营业成本|现金流|项目|合计|本期数|上期数"
NARRATIVE = "[。；！？;!?]"
TRUNCATED = "\n\n[...TRUNCATED...]"
PARSE_FAILED = "[PARSE_FAILED]"


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def count_of(text: Column, needle: Column) -> Column:
    """Occurrences of needle from left to right without overlap; null text has none."""
    n = (F.length(text) - F.length(F.replace(text, needle, F.lit("")))) / F.length(needle)
    return F.coalesce(F.when(F.length(needle) > 0, n), F.lit(0)).cast("int")


def dictionary(keywords: Sequence[tuple[str, int, str]]) -> Column:
    """(keyword, weight, polarity) as an array of structs, longest keyword first, else in the given order."""
    order = sorted(range(len(keywords)), key=lambda i: (-len(keywords[i][0]), i))
    return F.array(*[F.struct(F.lit(keywords[i][0]).alias("keyword"), F.lit(keywords[i][1]).alias("weight"), F.lit(keywords[i][2]).alias("polarity")) for i in order])


_HIT = "array<struct<keyword:string,weight:int,polarity:string,count:int>>"


def masked_hits(text: Column, words: Column) -> Column:
    """Hits of a dictionary; what one keyword matched is masked, so shorter ones do not count it again.

    words: array of (keyword, weight, polarity) in the order of matching, a literal or a column.
    """

    def step(acc: Column, w: Column) -> Column:
        n = count_of(acc["text"], w["keyword"])
        hit = F.array(F.struct(w["keyword"].alias("keyword"), w["weight"].cast("int").alias("weight"), w["polarity"].alias("polarity"), n.alias("count")))
        text = F.replace(acc["text"], w["keyword"], F.repeat(F.lit(MASK), F.length(w["keyword"])))
        return F.when(n > 0, F.struct(text.alias("text"), F.concat(acc["hits"], hit.cast(_HIT)).alias("hits"))).otherwise(acc)

    start = F.struct(F.coalesce(text, F.lit("")).alias("text"), F.array().cast(_HIT).alias("hits"))
    return F.aggregate(words, start, step, lambda acc: acc["hits"])


def plain_hits(text: Column, words: Column) -> Column:
    """Hits without masking, on the text without white space: overlapping keywords all count."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", "")
    hits = lambda t: F.filter(F.transform(words, lambda w: F.struct(w["keyword"].alias("keyword"), w["weight"].cast("int").alias("weight"), w["polarity"].alias("polarity"), count_of(t, w["keyword"]).alias("count"))), lambda h: h["count"] > 0)
    return let(bare, hits).cast(_HIT)


def points(hits: Column) -> Column:
    """Sum of weight * count."""
    return F.aggregate(hits, F.lit(0).cast("long"), lambda a, h: a + h["weight"].cast("long") * h["count"])


def is_blank(c: Column) -> Column:
    return F.coalesce(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")) == "", F.lit(True))


def merged_sections(parts: Sequence[Column], whole: Column) -> Column:
    """The parts that are not blank, an empty line between them; the whole only if all are blank."""
    joined = F.array_join(F.filter(F.array(*parts), lambda p: ~is_blank(p)), "\n\n")
    return F.when(joined == "", F.coalesce(whole, F.lit(""))).otherwise(joined)


def section_or(primary: Column, fallback: Column, most: int = 12_000) -> Column:
    """primary if not blank, else fallback without a first line that only reports a failure; cut at ``most`` characters."""
    rest = F.when(F.startswith(fallback, F.lit(PARSE_FAILED)), F.regexp_replace(fallback, r"^[^\n]*\n?", "")).otherwise(fallback)
    return truncated(F.trim(F.when(is_blank(primary), F.coalesce(rest, F.lit(""))).otherwise(primary)), most)


def truncated(text: Column, most: int) -> Column:
    """At most so many characters, and a note where something was cut."""
    return F.when(F.length(text) > most, F.concat(F.rtrim(F.substring(text, 1, most)), F.lit(TRUNCATED))).otherwise(text)


def lines(text: Column) -> Column:
    return F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?|\f", "\n"), "\n")


def _header(s: Column, short: int, names: str = "股份有限公司") -> list[Column]:
    return [
        F.contains(s, F.lit("年度报告")) & s.rlike(names),
        F.contains(s, F.lit("公司代码：")) | F.contains(s, F.lit("公司简称：")),
        s.rlike("有限公司$") & (F.length(s) <= 30),
        F.contains(s, F.lit("年度报告")) & (F.length(s) <= short),
    ]


def _kept_lines(text: Column, drops, trim: bool = True) -> Column:
    def bad(ln: Column) -> Column:
        s = F.trim(ln) if trim else ln
        out = F.lit(False)
        for d in drops(s):
            out = out | d
        return out

    return F.filter(lines(text), lambda ln: ~bad(ln))


def _trimmed_lines(text: Column, drops) -> Column:
    """The kept lines without spaces around them. (``F.trim`` itself as the function of a transform would take the line's number as what to trim.)"""
    return F.array_join(F.transform(_kept_lines(text, drops), lambda ln: F.trim(ln)), "\n")


def normalized(text: Column) -> Column:
    """Page numbers, headers, borders and blank lines dropped; spaces removed."""
    rules = lambda s: [s == "", s.rlike(PAGE_NUMBER), s.rlike(PAGE_OF), s.rlike(BORDER), F.contains(s, F.lit("年度报告全文")), *_header(s, 20)]
    return F.replace(_trimmed_lines(text, rules), F.lit(" "), F.lit(""))


def letter_text(text: Column) -> Column:
    """As ``normalized``, but gentler: blank lines stay (two line feeds at most), spaces are collapsed."""
    rules = lambda s: [s.rlike(PAGE_NUMBER), s.rlike(PAGE_OF), F.contains(s, F.lit("年度报告全文")), *_header(s, 0, "有限公司")[:3]]
    out = _trimmed_lines(text, rules)
    return F.trim(F.regexp_replace(F.regexp_replace(out, "[ \t]+", " "), "\n{3,}", "\n\n"))


def reading_text(text: Column) -> Column:
    """Lines for reading: numbers, headers and blank lines dropped; long unbroken tokens get places to break."""
    rules = lambda s: [s == "", s.rlike(r"(?U)^\d+$"), s.rlike(r"(?U)^\d+\s*/\s*\d+$") & (F.length(s) <= 15), *_header(s, 25)]
    soft = lambda ln: F.when(ln.rlike("[!-~]{25,}"), F.regexp_replace(ln, "([!-~]{20})(?=[!-~]{5})", "$1​")).otherwise(ln)
    return F.array_join(F.transform(_kept_lines(text, rules), lambda ln: soft(F.trim(ln))), "\n")


def without_toc(text: Column) -> Column:
    """Lines of tables of contents dropped: dotted leaders, or short lines that end in a number other than a year."""
    toc = lambda ln: F.trim(ln).rlike(TOC_LEADER) | ((F.length(F.trim(ln)) <= 30) & F.trim(ln).rlike(TOC_TAIL))
    return F.array_join(F.filter(lines(text), lambda ln: ~toc(ln)), "\n")


def table_like(line: Column) -> Column:
    """Whether a line looks like a table's row."""
    s = F.trim(line)
    bare = F.regexp_replace(s, r"(?U)\s+", "")
    n, digits = F.length(bare), F.regexp_count(bare, F.lit(r"(?U)\d"))
    rows = s.rlike("[|│┆┊—-]") & (digits > 0)
    short = (n <= 40) & ((digits >= 6) | ((digits >= 3) & bare.rlike("[,%‰]")))
    cells = (n <= 50) & bare.rlike(r"^[0-9,.\-+%‰/（）()\x{4e00}-\x{9fff}A-Za-z]{10,}$") & bare.rlike("[0-9]")
    return (s != "") & ~s.rlike("[。！？]") & (n > 2) & (rows | short | cells)


def table_noise(text: Column) -> Column:
    """Whether a snippet is a table rather than prose."""

    def judge(t: Column) -> Column:
        n, prose = F.length(t), t.rlike(NARRATIVE)
        digits, percents = F.regexp_count(t, F.lit(r"(?U)\d")), count_of(t, F.lit("%"))
        pipes, commas = count_of(t, F.lit("|")), count_of(t, F.lit(",")) + count_of(t, F.lit("，"))
        return (t != "") & (
            t.rlike(TABLE_WORDS)
            | ((pipes >= 2) & (n >= 140))
            | ((commas >= 14) & (n >= 260) & ~prose)
            | ((n >= 420) & (digits / F.greatest(n, F.lit(1)) > 0.26) & ~prose)
            | ((percents >= 5) & (n >= 260) & ~prose)
        )

    return let(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " ")), judge)


def sentences(text: Column) -> Column:
    """Sentences by their end marks, white space collapsed, without blank ones."""
    each = F.transform(F.split(F.coalesce(text, F.lit("")), SENTENCE_ENDS), lambda s: F.trim(F.regexp_replace(s, r"(?U)\s+", " ")))
    return F.filter(each, lambda s: s != "")


def sentences_with(text: Column, needle: Column, most: int = 3) -> Column:
    """The first distinct sentences that contain needle, joined by " | "; null without any."""
    found = F.slice(F.array_distinct(F.filter(sentences(text), lambda s: F.contains(s, needle))), 1, most)
    joined = F.array_join(found, " | ")
    return F.when(F.size(found) > 0, F.when(F.length(joined) > 4000, F.concat(F.rtrim(F.substring(joined, 1, 4000)), F.lit("…"))).otherwise(joined))


def window_around(text: Column, at: Column, window: int = 180) -> Column:
    """Characters around a place (from 0), with an ellipsis where something is cut."""
    half = max(20, window // 2)
    i = F.greatest(F.lit(0), F.least(at, F.length(text) - 1))
    a, b = F.greatest(F.lit(0), i - half), F.least(F.length(text), i + half)
    s = F.trim(F.regexp_replace(F.substring(text, a + 1, b - a), r"(?U)\s+", " "))
    return F.when(F.length(text) > 0, F.concat(F.when(a > 0, "…").otherwise(""), s, F.when(b < F.length(text), "…").otherwise(""))).otherwise("")


def one_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


def no_space(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", "")


def xml_escaped(text: Column) -> Column:
    out = text
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def paragraphs_xhtml(text: Column) -> Column:
    """Each line that is not blank as a paragraph."""
    return F.array_join(F.transform(F.filter(lines(text), lambda s: F.trim(s) != ""), lambda s: F.concat(F.lit("<p>"), xml_escaped(F.trim(s)), F.lit("</p>"))), "\n")


def safe_filename(name: Column) -> Column:
    return F.regexp_replace(name, r'[\\/:*?"<>|\r\n\t]+', "_")


def column_letter(n: Column) -> Column:
    """1 -> A, 26 -> Z, 27 -> AA (up to six letters)."""
    out, rest = F.lit(""), n.cast("long")
    for _ in range(6):
        digit = F.pmod(rest - 1, F.lit(26))
        out = F.when(rest > 0, F.concat(F.char(digit + 65), out)).otherwise(out)
        rest = F.when(rest > 0, F.floor((rest - 1) / 26)).otherwise(F.lit(0))
    return out


def has_all_characters(hay: Column, needle: Column) -> Column:
    """Whether every character of needle occurs in hay."""
    return F.forall(F.split(needle, "(?!^)(?!$)"), lambda c: (c == "") | F.contains(hay, c))


def contains_any(text: Column, words: Sequence[str]) -> Column:
    return F.exists(F.array(*[F.lit(w) for w in words]).cast("array<string>"), lambda w: F.contains(text, w)) if words else F.lit(False)


def complete_sections(full: Column, business: Column, future: Column, industry: Column, letter: Column) -> Column:
    """Whether extracted sections are long enough to count as complete."""
    n = lambda c: F.length(F.trim(F.coalesce(c, F.lit(""))))
    failed = F.startswith(F.trim(F.coalesce(full, F.lit(""))), F.lit(PARSE_FAILED))
    return ~failed & ((n(business) >= 500) | (n(future) >= 200) | (n(industry) >= 200) | (n(letter) >= 200) | (n(full) >= 5000))
