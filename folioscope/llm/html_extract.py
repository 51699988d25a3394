"""Main text of HTML pages by a maximum-scoring subsequence.

1. A tolerant tokenizer, linear in the page's length, cuts a page into blocks of text, each within its innermost open element.
2. Weights come from labelled pages (labelled_pages.py by default; ``fit`` takes any others marked in the same way): a logistic
   regression over the names of open tags, their classes, ids and roles, and the share of linked words, for words; for tags how
   much more often they stand outside the main text than within it, so every tag has a negative weight.
3. A word scores its block's log-odds of being main text, between LEAST and MOST; a tag scores its weight.
4. A linear scan over words and tags finds the contiguous region with the largest sum: it begins and ends with a block. What stands
   outside is not main text, whatever its own score; so a paragraph beyond long menus or comments is out, and a block
   that scores little within the article is in.
5. Elements within the region that their own names mark as noise (an advert, a form, a comment section; the sum of the weights
   of names that hold no main text in any labelled page is below NOISE) are taken out of it. A form that holds most of a page's words and paragraphs wraps the page; it marks nothing.
   Nor does part of a longer name (has-sidebar, comments-open) of any such element, or any name beside one of main text. A header
   with a heading within an article is the article's, not the page's: its name says nothing, the names within it still do.

The text of a page: each block with references decoded, runs of white space as one space, trimmed; blocks joined by two line feeds.

Defined results: null, empty and blank pages, and pages without a region of positive sum, have an empty text; of equal regions the
first counts; unclosed tags, comments and quotes end with the page; repeated rows give equal rows.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from folioscope.llm import labelled_pages
from folioscope.llm._shared import pick

#: Bounds of a word's score (what speaks against a block weighs less, as blocks that aren't text may stand within it); of a
#: tag's; sum of an element's own weights that marks it as noise.
MOST, LEAST, LEAST_TAG, MOST_TAG, NOISE = 4.0, -0.5, -1.0, -0.02, -0.9
#: Names of main text in any page.
MAIN = frozenset(("main", "article", "content"))
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page; those in RAW hold no tags.
RAW = frozenset("script style textarea title noembed xmp iframe noframes".split())
HIDDEN = RAW | frozenset("head noscript template svg annotation annotation-xml canvas object select option button datalist audio video".split())
#: Names of a header, of what has a header of its own, and of headings.
HEADER, OWNER, HEADINGS = frozenset(("header", ".header")), frozenset(("article", ".article", ".post", ".entry")), frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements of which a new one ends an open one, as does one of the same group.
SIBLINGS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr", "td": "td th", "th": "td th", "option": "option"}
_OPEN = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|/?[A-Za-z])")
_NAMED = re.compile(r"</?([A-Za-z][^\s/>]*)")
_COMMENT = re.compile(r"-?>|[^>]*?--!?>|.*?--!?>", re.S)
_PLAIN = re.compile(r"[^'\">]*+")
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _features(tag: str, attrs: str) -> tuple[list[str], set[str]]:
    """Names of an element, and those of them that only stand beside others in names such as has-sidebar or comments-open."""
    out, whole, part = [tag], set(), set()
    if attrs:
        for _, a, b, c in _ATTR.findall(attrs):
            for name in (a or b or c).split():
                words = ["." + w.lower() for w in _NAME.findall(name)]
                out += words
                (part if len(words) > 1 else whole).update(words)
    return out, part - whole


def tags(page: str):
    """(start, end, name, is closing, attributes) of each tag; name is "" for comments and declarations, with their content.

    A tag ends at the first ">" outside quotes; if there is none, at the first ">". Places from which no end was found
    are remembered, so every quote is looked at a bounded number of times.
    """
    at, size = 0, len(page)
    dead: set[int] = set()
    no_end = size + 1  # from here on there is no ">"
    while m := _OPEN.search(page, at):
        start, head = m.start(), m[0]
        if head == "<!--":
            c = _COMMENT.match(page, m.end())
            at = c.end() if c else size
            yield start, at, "", False, page[m.end() : at].removesuffix("-->")
        elif head[1] in "!?":
            i = page.find("]]>" if head == "<![CDATA[" else ">", m.end())
            at = size if i < 0 else i + (3 if head == "<![CDATA[" else 1)
            yield start, at, "", False, ""
        else:
            name = _NAMED.match(page, start)
            if name.end() >= no_end:
                at = name.end()
                continue
            i, tried = name.end(), []
            while True:
                i = _PLAIN.match(page, i).end()
                if i >= size or i in dead:
                    i = -1
                    break
                if page[i] == ">":
                    break
                tried.append(i)
                i = page.find(page[i], i + 1) + 1
                if not i:
                    i = -1
                    break
            if i < 0:
                dead.update(tried)
                i = page.find(">", name.end())
                if i < 0:  # no tag, but text
                    no_end = min(no_end, name.end())
                    at = name.end()
                    continue
            at = i + 1
            jump = yield start, at, name[1].lower(), head[1] == "/", page[name.end() : i]
            if jump:
                at = jump
                yield None


@dataclass
class Page:
    """Elements (parent, tag, own names, those that are parts of longer ones) and blocks (element, text, number of words, mostly linked, tags before, marked)."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    names: list[list[str]] = field(default_factory=list)
    joined: list[set[str]] = field(default_factory=list)
    blocks: list[tuple[int, str, int, bool, list[str], bool]] = field(default_factory=list)


def parsed(page: str, marks: bool = False) -> Page:
    """marks: <!--keep--> and <!--/keep--> enclose main text (in labelled pages)."""
    out = Page()
    stack: list[int] = []  # open elements
    block_at: list[int] = []  # places in the stack of the blocks among them
    open_tags: Counter = Counter()
    hidden, links, linked, keep = 0, 0, 0, False
    between: list[str] = []
    parts: list[str] = []

    def push(tag: str, attrs: str) -> None:
        nonlocal hidden, links
        out.parent.append(stack[-1] if stack else -1)
        out.tag.append(tag)
        names, joined = _features(tag, attrs)
        out.names.append(names)
        out.joined.append(joined)
        if tag in BLOCKS:
            block_at.append(len(stack))
        stack.append(len(out.tag) - 1)
        open_tags[tag] += 1
        hidden += tag in HIDDEN
        links += tag == "a"

    def pop_to(n: int) -> None:
        nonlocal hidden, links
        while len(stack) > n:
            tag = out.tag[stack.pop()]
            if tag in BLOCKS:
                block_at.pop()
            open_tags[tag] -= 1
            hidden -= tag in HIDDEN
            links -= tag == "a"

    def flush() -> None:
        nonlocal linked, between
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                n = text.count(" ") + 1
                out.blocks.append((stack[-1] if stack else -1, text, n, linked >= 0.6 * n, between, keep))
                between = []
        linked = 0

    def text(raw: str) -> None:
        nonlocal linked
        if raw and not hidden:
            s = _html.unescape(raw) if "&" in raw else raw
            parts.append(s)
            if links:
                linked += len(s.split())

    at, last = 0, page.rfind(">")
    found = tags(page)
    for start, end, tag, closing, attrs in found:
        text(page[at:start])
        at = end
        if not tag:
            if marks and attrs in ("keep", "/keep"):
                flush()
                keep = attrs == "keep"
            continue
        if tag == "br":
            parts.append(" ")
            continue
        between.append(tag)
        block = tag in BLOCKS
        if block:
            flush()
        if closing:
            if open_tags[tag]:
                n = len(stack) - 1
                while out.tag[stack[n]] != tag:
                    n -= 1
                pop_to(n)
            continue
        if block and block_at and out.tag[stack[block_at[-1]]] == "p":  # a block ends an open paragraph and what is open in it
            pop_to(block_at[-1])
        if tag in SIBLINGS and block_at and out.tag[stack[block_at[-1]]] in SIBLINGS[tag].split():
            pop_to(block_at[-1])
        if tag in VOID or attrs.endswith("/") and not block and tag not in RAW:
            continue
        if tag == "body" and open_tags["head"]:
            n = len(stack) - 1
            while out.tag[stack[n]] != "head":
                n -= 1
            pop_to(n)
        push(tag, attrs)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at) if at <= last else None
            at = close.end() if close else len(page)
            pop_to(len(stack) - 1)
            found.send(at)
    text(page[at:])
    flush()
    return out


@dataclass(frozen=True)
class Weights:
    """Of names ("" is the constant, "#linked" of blocks of links), and of tags by name; names that may mark noise, as none holds main text."""

    names: dict[str, float]
    tags: dict[str, float]
    marking: frozenset[str] = frozenset()

    def tag(self, name: str) -> float:
        return self.tags.get(name, MOST_TAG)


def _wrappers(page: Page) -> list[bool]:
    """Elements that hold most of the page's words, and paragraphs among them."""
    words, paragraphs = [0] * len(page.tag), [tag == "p" for tag in page.tag]
    for el, _, n, *_ in page.blocks:
        if el >= 0:
            words[el] += n
    for i in range(len(words) - 1, -1, -1):  # children come after their parents
        if page.parent[i] >= 0:
            words[page.parent[i]] += words[i]
            paragraphs[page.parent[i]] |= paragraphs[i]
    total = sum(n for _, _, n, *_ in page.blocks)
    return [2 * w > total and p for w, p in zip(words, paragraphs, strict=True)]


def _own_headers(page: Page) -> list[bool]:
    """Elements that are the header of an article: they hold a heading, and the article holds them."""
    within, heading = [False] * len(page.tag), [tag in HEADINGS for tag in page.tag]
    for i, up in enumerate(page.parent):
        within[i] = up >= 0 and (within[up] or not OWNER.isdisjoint(page.names[up]))
    for i in range(len(heading) - 1, -1, -1):
        if page.parent[i] >= 0:
            heading[page.parent[i]] |= heading[i]
    return [a and h and not HEADER.isdisjoint(names) for a, h, names in zip(within, heading, page.names, strict=True)]


def _names_of(page: Page, w: Weights | None = None) -> list[list[str]]:
    """Each element's own names; those of elements that wrap the page say nothing.

    What holds most of the page is not noise by part of a name (it has a sidebar, or is open to comments), nor by any name beside one of main text.
    """

    def own(tag: str, names: list[str], joined: set[str], wraps: bool, heads: bool) -> list[str]:
        if tag in ("html", "body") or tag == "form" and wraps:
            return []
        if heads and w:
            names = [n for n in names if n not in HEADER]
        if not (wraps and w):
            return names
        main = any(n.lstrip(".") in MAIN or n[0] == "." and n not in w.marking and w.names.get(n, 0.0) > 0 for n in names)
        return [n for n in names if n not in w.marking or not (main or n in joined)]

    return list(map(own, page.tag, page.names, page.joined, _wrappers(page), _own_headers(page)))


def judged(page: Page, w: Weights) -> tuple[list[float], list[float], list[bool]]:
    """Of each block: its words' score together, that of the tags before it, and whether it stands in noise."""
    own = _names_of(page, w)
    score, noise = [0.0] * len(own), [False] * len(own)
    stack: list[int] = []
    count: Counter = Counter()
    for i, names in enumerate(own):
        up = page.parent[i]
        while stack and stack[-1] != up:
            for f in own[stack.pop()]:
                count[f] -= 1
        score[i], noise[i] = (score[up], noise[up]) if up >= 0 else (0.0, False)
        for f in names:
            count[f] += 1
            if count[f] == 1:  # a name counts once, however often it is open
                score[i] += w.names.get(f, 0.0)
        noise[i] |= sum(w.names.get(f, 0.0) for f in set(names) & w.marking) < NOISE
        stack.append(i)
    words, before, out = [], [], []
    for el, _, n, linked, tags_, _ in page.blocks:
        s = w.names.get("", 0.0) + (score[el] if el >= 0 else 0.0) + (w.names.get("#linked", 0.0) if linked else 0.0)
        words.append(n * (LEAST if el >= 0 and noise[el] else max(LEAST, min(MOST, s))))
        before.append(sum(map(w.tag, tags_)))
        out.append(el >= 0 and noise[el])
    return words, before, out


def region(words: list[float], before: list[float]) -> tuple[int, int]:
    """First block and the one after the last of the run with the largest sum of words and of tags between them; (0, 0) if none is positive."""
    best, run, first = (0.0, 0, 0), 0.0, 0
    for i, (s, t) in enumerate(zip(words, before, strict=True)):
        run += t
        if run <= 0:
            run, first = 0.0, i
        run += s
        if run > best[0]:
            best = (run, first, i + 1)
    return best[1:]


def fit(pages: list[str], steps: int = 3000, rate: float = 0.5, ridge: float = 0.002) -> Weights:
    """Weights from pages in which <!--keep--> marks the main text."""
    rows, y, inside, outside, holding = [], [], Counter(), Counter(), set()
    for text in pages:
        page = parsed(text, marks=True)
        own, up = _names_of(page), page.parent
        for i, (el, _, _, linked, tags_, keep) in enumerate(page.blocks):
            names = {"", *(["#linked"] if linked else [])}
            while el >= 0:
                names.update(own[el])
                el = up[el]
            rows.append(names)
            y.append(float(keep))
            if keep:
                holding |= names
            # tags before a block stand within the main text if blocks of it stand on both sides
            (inside if keep and i > 0 and page.blocks[i - 1][5] else outside).update(tags_)
    vocab = sorted(set().union(*rows))
    at = {f: i for i, f in enumerate(vocab)}
    x = np.zeros((len(rows), len(vocab)))
    for i, r in enumerate(rows):
        x[i, [at[f] for f in r]] = 1
    target, w = np.array(y), np.zeros(len(vocab))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        w -= rate * (x.T @ (p - target) / len(target) * 4 + ridge * w)
    n_in, n_out = max(1, inside.total()), max(1, outside.total())
    tag = lambda t: math.log((inside[t] + 1) / n_in) - math.log((outside[t] + 1) / n_out)
    return Weights({f: float(v) for f, v in zip(vocab, w, strict=True)}, {t: max(LEAST_TAG, min(MOST_TAG, tag(t) / 2)) for t in {*inside, *outside}}, frozenset(vocab) - holding)


@lru_cache(maxsize=1)
def default_weights() -> Weights:
    return fit(labelled_pages.pages())


def extract(page: str | None, weights: Weights | None = None) -> str:
    """The page's main text."""
    if not page:
        return ""
    found = parsed(page)
    words, before, noise = judged(found, weights or default_weights())
    first, end = region(words, before)
    return "\n\n".join(found.blocks[i][1] for i in range(first, end) if not noise[i])


def _run(weights: Weights):
    def run(batches):
        for batch in batches:
            texts = [extract(x.as_py(), weights) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def main_text(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """page_id, url, text, n_chars: a row for each page."""
    rows = pick(pages, "page_id", "url", "html")
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(_run(weights or default_weights()), f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
