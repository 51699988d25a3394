"""Texts for reading: fragments of tables joined, hard-wrapped lines put together to paragraphs, long tables shortened.

The routines keep state along a text, so they are plain Python on its lines; ``readable`` applies them row by row after
the native line filters have run.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.by_row import by_row
from folioscope.functions.text import normalized, reading_text

# What counts as a heading, an ordinal by itself, and the end of a paragraph.
HEADING = re.compile(r"第[一二三四五六七八九十0-9]{1,3}[节章]|[一二三四五六七八九十]{1,3}、|\d{1,2}、|[（(][一二三四五六七八九十0-9]{1,3}[）)]")
ORDINALS = ((re.compile(r"\d{1,2}"), re.compile(r"\d{1,2}\s*[、.．:：)]")), (re.compile(r"[一二三四五六七八九十]{1,3}"), re.compile(r"[一二三四五六七八九十]{1,3}\s*[、.．:：)]")))
BRACKETED = re.compile(r"[（(]\s*(?:\d{1,2}|[一二三四五六七八九十]{1,3})\s*[）)]")
ENDS = tuple("。！？；：:）)」』】")
CLAUSE_ENDS = tuple("。；;：:")
OMITTED = "…（此处为表格，已省略中间内容；建议查看报告原文PDF）…"
FRAGMENT, TOGETHER = 6, 12


def numbered(ordinal: str, line: str) -> str | None:
    """An ordinal that stands alone before its line, put together with it; None if it is none or the line has its own."""
    if BRACKETED.fullmatch(ordinal):
        return ordinal + line
    for alone, own in ORDINALS:
        if alone.fullmatch(ordinal) and not own.match(line):
            return f"{ordinal}、{line}"
    return None


def without_fragments(lines: Iterable[str]) -> Iterator[str]:
    """Short lines joined by two spaces, TOGETHER at a time; a lone ordinal goes to the line after it."""
    held: list[str] = []
    for line in lines:
        if len(line) <= FRAGMENT and not line.endswith(CLAUSE_ENDS):
            held.append(line)
            if len(held) == TOGETHER:
                yield "  ".join(held).strip()
                held = []
            continue
        whole = numbered(held[0].strip(), line) if len(held) == 1 else None
        if held and whole is None:
            yield "  ".join(held).strip()
        held = []
        yield whole or line
    if held:
        yield "  ".join(held).strip()


def paragraphs(lines: Iterable[str]) -> str:
    """Lines run on until one ends with a mark; headings stand alone, an empty line after each."""
    out: list[str] = []
    running = ""
    for line in map(str.strip, lines):
        if not line or HEADING.match(line):
            out += [running] * bool(running) + [line, ""] * bool(line)
            running = ""
        elif running.endswith(ENDS):
            out.append(running)
            running = line
        else:
            running += line
    return "\n".join([*out, running]).strip()


def reflowed(text: str | None) -> str | None:
    return None if text is None else paragraphs(without_fragments(text.split("\n")))


def table_row(line: str) -> bool:
    """Whether a line looks like a table's row (as functions.text.table_like)."""
    s = line.strip()
    bare = re.sub(r"\s+", "", s)
    digits = sum(c.isdigit() for c in bare)
    if any(m in s for m in "。！？") or len(bare) <= 2 or not digits:
        return False
    return bool(re.search("[|│┆┊—-]", s)) or (len(bare) <= 40 and (digits >= 6 or (digits >= 3 and bool(re.search("[,%‰]", bare))))) or (len(bare) <= 50 and bool(re.fullmatch(r"[0-9,.\-+%‰/（）()一-鿿A-Za-z]{10,}", bare)))


def shortened_tables(text: str | None, least: int = 10, head: int = 3, tail: int = 3) -> str:
    """Runs of at least so many table rows as head, a note and tail; no more than two empty lines in a row."""
    out: list[str] = []
    for is_table, run in groupby((text or "").split("\n"), table_row):
        rows = list(run)
        out += [*rows[:head], OMITTED, *rows[-tail:]] if is_table and len(rows) >= least else rows
    return re.sub("\n{4,}", "\n\n\n", "\n".join(out))


def readable(text: Column) -> Column:
    """Line filters, then fragments and paragraphs."""
    return by_row(reflowed)(reading_text(F.replace(text, F.lit(" "), F.lit(" "))))


def preprocessed(text: Column) -> Column:
    """Tables shortened, before sections are looked for."""
    return by_row(shortened_tables)(text)


def cleaned(df: DataFrame, text: str, out: str = "clean") -> DataFrame:
    """df with the text of a document's pages: tables shortened, then page numbers, headers, borders and spaces dropped."""
    return df.withColumn(out, normalized(preprocessed(F.col(text))))
