"""Hand-labelled pages for fitting the weights of HTML extraction.

In each page the main text stands between <!--keep--> and <!--/keep-->, also in several pieces; all else is not main text.
The pages are put together from layouts, kinds of main text and kinds of surroundings that are common on the web; names of tags
and classes carry the signal, words do not, so the words are plain filler.
"""

from __future__ import annotations

FILL = "Some plain words stand here to fill the block that the page shows, and more follow."
SHORT = "Few words."
LINKS = '<ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">About us</a></li></ul>'

#: Opening and closing tags of what holds the main text.
HOLDERS = (
    ("<article>", "</article>"),
    ("<main>", "</main>"),
    ("<main><article>", "</article></main>"),
    ('<div id="content">', "</div>"),
    ('<div class="post-content entry">', "</div>"),
    ('<div class="article-body">', "</div>"),
    ('<section class="story text">', "</section>"),
    ('<article class="post"><div class="entry-content">', "</div></article>"),
    ("<div>", "</div>"),
    ("", ""),
    ('<table><tr><td class="content">', "</td></tr></table>"),
)

#: Kinds of main text.
BODIES = (
    f"<h1>A title</h1><p>{FILL} {FILL}</p><p>{SHORT}</p><p>{FILL}</p>",
    f"<h1>A title here</h1><p><b>{FILL}<br><p>{FILL} {FILL}</p><p>{FILL}</p>",
    f"<h2>Part one</h2><p>{FILL}</p><ul><li>{FILL}</li><li>{SHORT}</li></ul><p>{FILL}</p>",
    f'<p>{FILL} <a href="/x">a link</a> {FILL}</p><blockquote><p>{FILL}</p></blockquote><pre>{SHORT}</pre><p>{FILL}</p>',
    f"<p>{FILL}</p><table><tr><td>{SHORT}</td><td>{SHORT}</td></tr></table><h3>{SHORT}</h3><p>{FILL}</p>",
    f"{FILL}<br>{FILL}<br>{FILL}",
    f"<div>{FILL}</div><div>{FILL} {FILL}</div><div>{SHORT}</div>",
    f"<section><h2>{SHORT}</h2><p>{FILL}</p></section><section><h2>{SHORT}</h2><p>{FILL} {FILL}</p></section>",
    f"<p>{FILL}</p><ol><li>{FILL}</li><li>{SHORT}</li><li>{FILL}</li></ol><div><p>{FILL}</p></div>",
    f"<figure><figcaption>{SHORT}</figcaption></figure><p>{FILL}</p><dl><dt>{SHORT}</dt><dd>{FILL}</dd></dl>",
)

#: What surrounds the main text, or stands within its holder.
SIDES = (
    f"<nav>{LINKS}</nav>",
    f'<div class="menu navbar">{LINKS}</div>',
    f'<div id="navigation" role="navigation">{LINKS}</div>',
    f'<header><h1>The site</h1><p>{SHORT}</p></header>',
    f'<div class="header banner" id="masthead"><p>{FILL}</p></div>',
    f"<footer>&copy; site &middot; {FILL}</footer>",
    f'<div class="footer copyright"><p>{FILL}</p></div>',
    f"<aside><h2>{SHORT}</h2><p>{FILL}</p></aside>",
    f'<div class="sidebar widget"><p>{FILL}</p>{LINKS}</div>',
    f'<div class="ad">{FILL}</div>',
    f'<div class="ads advert advertisement sponsored" id="promo"><p>{FILL}</p></div>',
    f'<div class="cookie notice consent" role="dialog"><p>{FILL}</p></div>',
    f'<div class="alert banner notification"><p>{FILL}</p></div>',
    f'<form action="/s"><label>{SHORT}</label><p>{FILL}</p></form>',
    f'<div class="subscribe newsletter signup"><p>{FILL}</p></div>',
    f'<section class="comments" id="comments"><h2>Comments</h2><div class="comment"><p>{FILL} {FILL}</p></div><p>{FILL}</p></section>',
    f'<div class="reply user-comment discussion"><p>{FILL}</p></div>',
    f'<ol class="commentlist responses"><li>{FILL}</li></ol>',
    f'<div class="related recommended more"><h3>{SHORT}</h3>{LINKS}</div>',
    f'<div class="share social buttons"><a href="/f">{SHORT}</a></div>',
    f'<div class="breadcrumb breadcrumbs pagination pager"><a href="/">Home</a> &gt; <a href="/n">News</a></div>',
    f'<div class="popup modal overlay"><p>{FILL}</p></div>',
    f'<div class="toc tags meta byline author"><a href="/t">{SHORT}</a></div>',
)

#: Names of classes and ids each of which tells by itself that an element isn't main text.
MARKED = "menu navbar navigation header banner masthead footer copyright sidebar widget ad ads advert advertisement sponsored promo cookie notice consent dialog alert notification subscribe newsletter signup comments comment reply discussion commentlist responses related recommended share social breadcrumb breadcrumbs pagination pager popup modal overlay login search disqus remarks sponsoring bio".split()


def pages() -> list[str]:
    """All labelled pages: every holder and body with sides before, after and within the holder, in turn."""
    out, n = [], 0
    for open_, close in HOLDERS:
        for body in BODIES:
            before, after, inside = (SIDES[(n * k + j) % len(SIDES)] for k, j in ((1, 0), (5, 3), (7, 11)))
            within = n % 3 and open_
            cut = body.rfind("<p>") if "<p>" in body else len(body)
            head, tail = (body[:cut], body[cut:]) if within == open_ and n % 3 == 1 else (body, "")
            core = f"<!--keep-->{head}<!--/keep-->{inside if within else ''}" + (f"<!--keep-->{tail}<!--/keep-->" if tail else "")
            out.append(f"<!DOCTYPE html><html><head><title>A title</title></head><body>{before}{open_}{core}{close}{after}</body></html>")
            n += 1
    for i, side in enumerate(SIDES):  # each kind of side also inside and beside plain holders
        body, (open_, close) = BODIES[i % len(BODIES)], HOLDERS[i % len(HOLDERS)]
        out.append(f"<html><body>{side}{open_}<!--keep-->{body}<!--/keep-->{close}{side}</body></html>")
        open_, close = HOLDERS[i % 8]
        out.append(f"<html><body>{open_}{side}<!--keep-->{body}<!--/keep-->{side}{close}</body></html>")
    for i, name in enumerate(MARKED):
        body, (open_, close) = BODIES[i % len(BODIES)], HOLDERS[i % len(HOLDERS)]
        tag, inner = ("div", "section", "ul", "p", "div")[i % 5], (f"<p>{FILL}</p>", f"{FILL}", f"<li>{SHORT}</li><li>{SHORT}</li>", f"{FILL} {SHORT}", SHORT)[i % 5]
        side = f'<{tag} {("class", "id")[i % 2]}="{name}">{inner}</{tag}>'
        out.append(f"<html><body>{side}{open_}<!--keep-->{body}<!--/keep-->{side}{close}{side}</body></html>")
    return out
