"""HTML extraction: labelled pages, hand-made pages, and the defined results."""

import random
import re
import time

from folioscope.llm import html_extract as H
from folioscope.llm import labelled_pages as L


def test_labelled_pages():
    pages, right = L.pages(), 0
    for p in pages:
        want = [b[1] for b in H.parsed(p, marks=True).blocks if b[5]]
        right += H.extract(re.sub("<!--/?keep-->", "", p)).split("\n\n") == want
    assert right >= 0.9 * len(pages)


def test_article_is_whole():
    page = '<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><a href="/">x y z</a></nav><div class="ad">Buy now, it is cheap.</div><article><h1>Head &amp; more</h1><p><b>One  two\n three<br><p>Last.</p><div class="ad">Advert within.</div><p>X</p><section class="comments"><p>First! I was here before all others.</p></section></article><aside>Side words.</aside><footer>&copy; me</footer></body></html>'
    assert H.extract(page) == "Head & more\n\nOne two three\n\nLast.\n\nX"


def test_no_article():
    page = '<body><div class="menu"><a href="/">a</a></div><div id="content"><p>Plain words of a page that is long enough.</p><p>More.</p></div><div class="footer">foot</div></body>'
    assert H.extract(page) == "Plain words of a page that is long enough.\n\nMore."


def test_edges():
    assert [H.extract(x) for x in (None, "", "   ", "<nav><a>x</a></nav>", "<!-- a")] == [""] * 5
    assert H.extract("<article><p>a &lt;b&gt; &#233; 1 < 2") == "a <b> é 1 < 2"
    assert H.extract("<article><p title='a>b'>x</p><p class=\"unclosed>y") == "x\n\ny"
    assert H.extract("<article><p>one<!--> two</p><p>three <!--keep-->four<!--/keep--></p></article>") == "one two\n\nthree four"
    assert H.extract("<article>" + "<div>" * 3000 + "deep words" + "</p>" * 3000) == "deep words"
    long = "<article>" + "<p>" + "word " * 100_000 + "</p></article>"
    assert len(H.extract(long)) == 499_999


def test_frame(spark, clashing):
    rows = [(1, "u", "<article><p>Some words stand here.</p></article>"), (1, "u", "<article><p>Some words stand here.</p></article>"), (2, None, None), (None, "v", "")]
    df = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = sorted(map(tuple, H.main_text(df).collect()), key=str)
    assert got == sorted([(1, "u", "Some words stand here.", 22)] * 2 + [(2, None, "", 0), (None, "v", "", 0)], key=str)
    assert H.main_text(df.limit(0)).count() == 0


def test_region_is_the_maximum():
    """The linear scan finds what trying all runs of blocks finds; the first of equal ones."""
    rng = random.Random(2)
    for _ in range(400):
        n = rng.randint(0, 9)
        words, before = [float(rng.randint(-6, 6)) for _ in range(n)], [-float(rng.randint(0, 3)) for _ in range(n)]
        sums = {(i, j): sum(words[i:j]) + sum(before[i + 1 : j]) for i in range(n) for j in range(i + 1, n + 1)}
        first, end = H.region(words, before)
        best = max(sums.values(), default=0)
        assert (first, end) == (0, 0) if best <= 0 else sums[first, end] == best
    assert H.region([3.0, -1.0, 3.0, -9.0, 4.0], [0.0, -0.5, -0.5, -0.5, -0.5]) == (0, 3)


def test_scan_decides():
    """Words outside the region are out though they score as text, words within are in though they don't; noise within is taken out."""
    links = "".join(f'<li><a href="/{i}">Some other page of the site</a></li>' for i in range(12))
    page = f'<body><p>Stray words.</p><div class="menu"><ul>{links}</ul></div><article><p>{"The text goes on. " * 20}</p><h2><a href="#x">Linked heading</a></h2><p>{"And on. " * 30}</p><div class="ad"><p>Buy this.</p></div><p>The end of it all.</p></article><ul>{links}</ul><p>More stray words.</p></body>'
    found, w = H.parsed(page), H.default_weights()
    words, before, noise = H.judged(found, w)
    positive = "\n\n".join(b[1] for b, s in zip(found.blocks, words, strict=True) if s > 0)
    text = H.extract(page)
    assert "Stray" in positive and "Linked heading" not in positive and "Buy" not in positive
    assert text.split("\n\n") == [("The text goes on. " * 20).strip(), "Linked heading", ("And on. " * 30).strip(), "The end of it all."]


def test_form_around_the_page():
    page = '<body><form id="aspnetForm"><div class="menu"><a href="/">a</a></div><h1>T t</h1><p>Plain words of a page that is long enough.</p><p>More words.</p></form></body>'
    assert H.extract(page) == "T t\n\nPlain words of a page that is long enough.\n\nMore words."


def test_linear_in_broken_pages():
    for page in ("<a '" * 125_000, "<a \"'>" * 80_000, "<b>" * 50_000 + "<li>x" * 50_000, "<!--" * 100_000, "<div" * 100_000, "<a '><a \"" * 50_000, "<p>x" * 50_000 + "</b>" * 50_000):
        t = time.process_time()
        H.extract(page)
        assert time.process_time() - t < 8, page[:12]


def test_wrappers_are_not_noise():
    """An element that holds the page is not lost by a name that says what else it has; a comment thread that is longer than the article still goes."""
    article = "<h2>Title</h2>" + "".join(f"<p>Many plain words of an article number {i}, long enough to count.</p>" for i in range(7))
    want = H.extract(f"<body><article>{article}</article></body>")
    assert want.count("\n\n") == 7
    for w in ('div class="container has-sidebar"', 'article class="post comments-open has-related"', 'div id="page" class="site header-fixed"', 'main class="no-sidebar"', 'div class="wrap menu-open"', 'div id="main" class="research more"'):
        assert H.extract(f"<body><nav><a href='/'>menu</a></nav><{w}>{article}</{w.split()[0]}><footer>foot</footer></body>") == want
    thread = "".join(f"<p>I was here before all of the others, said number {i}.</p>" for i in range(40))
    assert H.extract(f'<body><article>{article}</article><div class="comments">{thread}</div></body>') == want
    assert H.extract(f'<body><div class="sidebar">{article}</div></body>') == ""


def test_linear_in_unclosed_tags():
    for unit in ("<div ", "</title ", "<a b='", "<!--x"):
        for head in ("<p>", "<title>", ""):
            began = time.thread_time()
            H.extract(head + unit * (1_000_000 // len(unit)))
            assert time.thread_time() - began < 4


def test_header_of_an_article():
    """The title in an article's own header is its text; what else the header holds is told by its own names, and the page's header goes."""
    text = "".join(f"<p>Many plain words of an article number {i}, long enough to count.</p>" for i in range(7))
    site = '<header><h1>The site</h1><p>Of many pages.</p></header><div class="site-header"><h2>And its name</h2></div>'
    for head in ("<header>%s</header>", '<div class="entry-header">%s</div>', '<header class="entry-header">%s</header>'):
        for open_, close in (("<article>", "</article>"), ('<div class="post">', "</div>"), ('<main><article class="entry">', "</article></main>")):
            inner = head % '<h1>A title of the usual length</h1><nav><a href="/">up</a></nav><div class="share">Share this with all</div>'
            got = H.extract(f"<body>{site}{open_}{inner}{text}{close}<footer>foot</footer></body>").split("\n\n")
            assert got[0] == "A title of the usual length" and len(got) == 8, got
    assert H.extract(f"<body><article><header><p>No title stands here.</p></header>{text}</article></body>").startswith("Many plain words")


def test_formulas_and_names_of_noise():
    text = "".join(f"<p>Many plain words of an article number {i}, long enough to count.</p>" for i in range(7))
    formula = '<p>Let <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation encoding="tex">x=1</annotation></semantics></math> be it.</p>'
    noise = ('<div id="disqus_thread"><p>I was here too, and first.</p></div>', '<div class="remarks"><p>I was here too, and first.</p></div>', '<div class="Zr9-sponsoring">Buy this.</div>', '<div class="author-bio"><p>Writes of many things.</p></div>')
    for n in noise:
        got = H.extract(f"<body><article><h1>Title</h1>{formula}{text}{n}</article>{n}</body>").split("\n\n")
        assert got[:2] == ["Title", "Let x=1 be it."] and len(got) == 9, (n, got[-1])
