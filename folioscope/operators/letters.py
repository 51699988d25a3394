"""Letters to shareholders on the first pages of a report.

All places where a letter may begin and where one must end are found once and sorted. A sweep over them takes the earliest beginning whose
text up to the next end holds enough characters; places of blanks, looked up by halving, make each test short, so
the work grows with the text and the number of marks. What follows the signature at the end is left out.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

from folioscope.operators import sections as S

# Headings that begin a letter, marks that end one, blocks before it, references, kinds of lines of a signature.
PART = r"(?:第\s*[一二三四五六七八九十0-9]{1,3}\s*(?:章|节|部分|篇)\s*)?"
STARTS = (
    r"董事长\s*致辞|董事长\s*致信|董事长\s*致股东信|董事长\s*致投资者信",
    r"主席\s*致辞|主席\s*致信",
    r"董事会\s*主席\s*致辞|董事会\s*主席\s*致信",
    r"董事会\s*致辞|董事会\s*致信|致\s*董事会\s*的\s*信",
    r"致\s*股东\s*信|致\s*股东\s*的\s*信|致\s*股东\s*函|致\s*投资者\s*信|致\s*投资者\s*函|致\s*股东\s*及\s*投资者\s*(?:信|函)|致\s*全体\s*股东\s*(?:信|函)",
    r"致\s*股东|致\s*投资者",
    r"尊敬的各位股东|尊敬的股东",
)
ENDS = (r"(?:目\s*录|释\s*义|词\s*汇\s*表|名词解释)\b", r"重\s*要\s*提\s*示\b", r"第\s*[一二三四五六七八九十0-9]{1,3}\s*(?:章|节|部分)\b", r"(?:公司概况|公司简介|公司基本情况|董事会报告|管理层讨论与分析|经营情况讨论与分析)\b")
NEXT_PART = (r"公司简介\b", r"董事长致辞\b", r"第\s*[一二三四五六七八九十0-9]{1,3}\s*(?:章|节|部分|篇)\b")
OVERVIEWS = (r"公司概况\b", r"主要财务数据\b")
BLOCKS = (
    (r"重\s*要\s*提\s*示\b", (r"目\s*录\b", r"释\s*义\b", r"词\s*汇\s*表\b", *OVERVIEWS, *NEXT_PART)),
    (r"目\s*录\b", (r"重\s*要\s*提\s*示\b", r"经营业绩回顾", r"管理层讨论与分析\b", *OVERVIEWS, *NEXT_PART)),
    (r"释\s*义\b", (r"(?:词\s*汇\s*表|名词解释)\b", *NEXT_PART)),
    (r"(?:词\s*汇\s*表|名词解释)\b", NEXT_PART),
)
REFERENCES = ("详见", "敬请", "查阅")
LEADER, NUMBERED, YEAR = re.compile(r"[.·…]{4,}\s*\d{1,4}\s*$"), re.compile(r"\s\d{1,4}\s*$"), re.compile(r"(?:19|20)\d{2}\s*$")
DATE = r"(?:\d{4}年\d{1,2}月(?:\d{1,2}日)?|[二〇○零一二三四五六七八九十]{2,4}年[一二三四五六七八九十]{1,3}月(?:[一二三四五六七八九十]{1,3}日)?)"
ROLE = "(?:董事长|主席|董事会主席|董事会)"
KINDS = (  # kind, longest line without blanks, the line without blanks
    ("date", 20, re.compile(DATE)),
    ("company", 40, re.compile(r"(?!.*(?:年度报告|报告全文)).*[一-鿿A-Za-z0-9]{2,60}(?:股份有限公司|有限公司|集团|公司)(?:董事会|董事局|董事长|主席).*")),
    ("role", 40, re.compile(rf"{ROLE}(?:[：:]?[一-鿿A-Za-z·•]{{1,16}})?")),
    ("signer", 25, re.compile(r".*(?:董事长|主席|董事会主席)[：:]?[一-鿿A-Za-z·•]{1,16}.*")),
    ("name", 8, re.compile(r"[一-鿿·•]{2,8}")),
)
INDEX = re.compile("董事长致辞|董事会致辞|主席致辞|致股东信|致投资者信")
HINT = "[CHAIRMAN_LETTER_HINT] 目录显示存在董事长/董事会/主席致辞或致股东(投资者)信，但正文抽取失败；建议打开原PDF查看原文与落款。"
LEAST, FEW_LINES, LEAST_END = 400, 900, 120
LONGEST, HEAD, TAIL, BLOCK = 50_000, 46_000, 12_000, 18_000
#: Lines at the end in which a signature is looked for.
SIGNED_WITHIN = 40

SPACE = re.compile(r"\s")
_BEGIN = re.compile(rf"(?:^|\n)[^\S\n]*{PART}(?:{'|'.join(STARTS)})")
_END = re.compile(rf"(?:^|\n)[^\S\n]*(?:{'|'.join(ENDS)})")
_HEADING = re.compile(r"(?:第[一二三四五六七八九十0-9]{1,3}(?:章|节|部分)|(?:[一二三四五六七八九十]{1,3}|\d{1,2})[、.．:：])")


def listed(line: str) -> bool:
    """Whether a line is one of a table of contents: leaders or a page number at its end."""
    return bool(LEADER.search(line) or NUMBERED.search(line) and not YEAR.search(line))


def without_lists(text: str) -> str:
    """The text without blocks of hints, contents and glossary, and without lines of a table of contents."""
    for start, ends in BLOCKS:
        text = S.without_block(text, rf"(?:^|\n){start}", [rf"(?:^|\n){e}" for e in ends], BLOCK)
    return "\n".join(ln for ln in text.split("\n") if not (LEADER.search(s := ln.strip()) or len(s) <= 30 and NUMBERED.search(s) and not YEAR.search(s)))


def spans(text: str, least: int = LEAST) -> Iterator[tuple[int, int]]:
    """(start, end) of each text between a beginning and the next end with enough characters, by start."""
    blank = array("q", (m.start() for m in SPACE.finditer(text)))
    ends = [m.start() for m in _END.finditer(text)]
    for m in _BEGIN.finditer(text):
        a = m.start()
        first = bisect_right(ends, max(a + LEAST_END, m.end() - 1))
        b = ends[first] if first < len(ends) else len(text)
        if b - a - (bisect_left(blank, b) - bisect_left(blank, a)) < least:
            continue
        at = m.end() - len(m[0].lstrip())
        stop = text.find("\n", at)
        line = text[at : stop if stop >= 0 else len(text)].strip()
        if not listed(line) and not (any(w in line for w in REFERENCES) and len(re.sub(r"\s+", "", line)) > 20):
            yield a, b


def kinds(line: str) -> set[str]:
    """What a line of a signature may be."""
    bare = re.sub(r"\s+", "", line)
    return {kind for kind, most, p in KINDS if bare and len(bare) <= most and p.fullmatch(bare)}


def _apart(line: str) -> list[str]:
    """Name, role and date of a signature in one line, each as a line."""
    date, role = re.search(DATE, line), re.search(rf"{ROLE}[^\d]{{0,20}}", line)
    if not (date or role):
        return [line]
    cuts = sorted({0, len(line), *(x for m in (date, role) if m for x in (m.start(), m.end()))})
    parts = [p for a, b in zip(cuts, cuts[1:], strict=False) if (p := line[a:b].strip(" ：:，,;；"))]
    return [line] if any(len(re.sub(r"\s+", "", p)) > 40 for p in parts) else parts


def signed(letter: str) -> str:
    """The letter up to its signature, which is a run of lines of at least two kinds, blank lines among them; with an empty line before it.

    Without a signature the letter stays as it is.
    """
    lines = letter.split("\n")
    begin = max(2, len(lines) - SIGNED_WITHIN)  # heading and address are no signature
    body, tail = lines[:begin], [p for ln in lines[begin:] for p in (_apart(ln.strip()) if ln.strip() else [""])]
    marks = [kinds(ln) for ln in tail]
    last = next((i for i in range(len(tail) - 1, -1, -1) if marks[i]), None)
    if last is None:
        return letter.rstrip()
    first = last
    while first and (marks[first - 1] or not tail[first - 1]):
        first -= 1
    if len(set().union(*marks[first : last + 1])) < 2:
        return letter.rstrip()
    heading = next((i for i in range(first, last + 1) if _HEADING.match(re.sub(r"\s+", "", tail[i]))), last + 1)
    head = "\n".join([*body, *tail[:first]]).rstrip()
    end = "\n".join(tail[first:heading]).strip()
    return "\n\n".join(filter(None, (head, end)))


def letter(front: str | None) -> str | None:
    """The letter in the text of a report's first pages; a hint if only its table of contents has one; None without either."""
    if not front:
        return None
    for text in dict.fromkeys((without_lists(front), front)):
        for a, b in spans(text):
            found = signed(text[a:b].strip())
            if len(re.sub(r"\s+", "", found)) >= LEAST and (found.count("\n") >= 2 or len(found) >= FEW_LINES):
                return found if len(found) <= LONGEST else f"{found[:HEAD].rstrip()}\n\n[...TRUNCATED...]\n\n{found[-TAIL:].lstrip()}"
        if not any(INDEX.search(ln) and listed(ln.strip()) for ln in front.split("\n")):
            return None  # only a letter that the contents name is looked for again among their lines
    return HINT
