"""Codes and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normal_code(code: Column) -> Column:
    """Digits only, padded to six (longer ones stay whole); null without digits."""
    d = F.regexp_replace(code, "[^0-9]", "")
    return F.when(F.length(d) == 0, None).when(F.length(d) < 6, F.lpad(d, 6, "0")).otherwise(d)


def exchange(code: Column) -> Column:
    """SSE for 6, SZSE for 0 and 3, BSE for 4, 8 and 9; else null."""
    c = F.substring(code, 1, 1)
    return F.when(c == "6", "SSE").when(c.isin("0", "3"), "SZSE").when(c.isin("8", "4", "9"), "BSE")


def exchange_or_bse(code: Column) -> Column:
    """As ``exchange``, but anything else is BSE."""
    c = F.substring(code, 1, 1)
    return F.when(c == "6", "SSE").when(c.isin("0", "3"), "SZSE").otherwise("BSE")


def column_of(code: Column, prefixes: tuple[str, ...] = ("600", "601", "603", "605", "688", "689", "900")) -> Column:
    """sse for the given prefixes, else szse."""
    hit = F.lit(False)
    for p in prefixes:
        hit = hit | F.startswith(code, F.lit(p))
    return F.when(hit, "sse").otherwise("szse")


def vendor_suffix(code: Column) -> Column:
    """code.XSHG for 6 and 9, code.XSHE otherwise."""
    return F.concat(code, F.when(F.substring(code, 1, 1).isin("6", "9"), ".XSHG").otherwise(".XSHE"))


def vendor_suffix_short(code: Column) -> Column:
    """code.SH, .BJ or .SZ; 900 is tested before 9."""
    one = F.substring(code, 1, 1)
    return F.concat(code, F.when((one == "6") | F.startswith(code, F.lit("900")), ".SH").when(one.isin("4", "8", "9"), ".BJ").otherwise(".SZ"))


def market(text: Column) -> Column:
    """SZ for anything with szse, SH with sse, else null."""
    t = F.lower(text)
    return F.when(F.contains(t, F.lit("szse")), "SZ").when(F.contains(t, F.lit("sse")), "SH")


def row_key(*parts: Column, sep: str = "-") -> Column:
    """Parts joined by sep; null counts as empty."""
    return F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def nav_key(*parts: Column) -> Column:
    """Parts as an anchor: everything but letters and digits becomes one "_"; "row" if nothing is left."""
    k = F.regexp_replace(F.regexp_replace(row_key(*parts, sep="|"), "[^0-9A-Za-z]+", "_"), "^_+|_+$", "")
    return F.when(k == "", "row").otherwise(k)


def first_filled(*cols: Column) -> Column:
    """The first that is neither null nor blank, trimmed; null if none."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cols])


def any_filled(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cols]).isNotNull()


def all_filled(*cols: Column) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.coalesce(F.trim(c) != "", F.lit(False))
    return out


def title_is_report(title: Column) -> Column:
    """An annual report's announcement: names it, is no summary, and does not only speak about it."""
    at, about = F.instr(title, "年度报告"), F.instr(title, "关于")
    return F.contains(title, F.lit("年度报告")) & ~F.contains(title, F.lit("摘要")) & ((about == 0) | (at < about))


def title_year(title: Column) -> Column:
    """The report year in a title; null if there is none."""
    one = F.nullif(F.regexp_extract(title, r"(20\d{2})\s*年?\s*年度报告", 1), F.lit(""))
    two = F.nullif(F.regexp_extract(title, r"^(20\d{2})", 1), F.lit(""))
    return F.coalesce(one, two).cast("int")


#: Words that a valid title must not contain.
STOP_WORDS = ("摘要", "英文", "取消", "更正", "补充", "说明", "提示性公告", "审计报告")


def valid_report(title: Column, url: Column, stop: tuple[str, ...] = STOP_WORDS) -> Column:
    bad = F.lit(False)
    for w in stop:
        bad = bad | F.contains(title, F.lit(w))
    return F.contains(title, F.lit("年度报告")) & ~bad & F.endswith(F.lower(url), F.lit(".pdf"))
