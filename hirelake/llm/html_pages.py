"""Labelled pages for the extraction model, composed from parts.

Each part is a fragment of HTML with a label: does its text belong to the article? Words in
braces are replaced by filler. The pages are put together by rule, so their number is a
parameter and every combination of layout and part comes up.
"""

from __future__ import annotations

import random

# Fixed fragments. Keys of CONTENT and CHROME are only names; "{n}" stands for n filler words.
CONTENT = {
    "paragraph": "<p>{40}.</p>", "long": "<p>{90}.</p><p>{70}.</p>", "short": "<p>{6}.</p>", "tiny": "<p>{2}.</p>",
    "linked": "<p>{20} <a href='#'>{3}</a> {15}.</p>", "bold": "<p><b>{12}</b> {30}.<br>{9}.</p>",
    "heading": "<h2>{5}</h2><p>{50}.</p>", "subheading": "<h3>{4}</h3><p>{25}.</p>",
    "list": "<ul><li>{8}</li><li>{10}.</li><li>{7}</li></ul>", "steps": "<ol><li>{14}.</li><li>{12}.</li></ol>",
    "quote": "<blockquote><p>{18}.</p></blockquote>", "figure": "<figure><img src='a'><figcaption>{7}.</figcaption></figure>",
    "table": "<table><tr><th>{2}</th><th>{2}</th></tr><tr><td>{4}</td><td>{3}</td></tr></table>",
    "code": "<pre>{12}</pre>", "loose": "{30}.", "section": "<section><h2>{4}</h2><p>{45}.</p></section>",
    "div": "<div>{35}.</div>", "definition": "<dl><dt>{2}</dt><dd>{12}.</dd></dl>",
}
# Inside the article or beside it.
CHROME = {
    "ad": "<div class='ad'>{9}.</div>", "ads": "<div class='ads banner-ad'><a href='#'>{6}</a></div>",
    "sponsor": "<div id='sponsored'><p>{14}.</p></div>", "promo": "<section class='promo'><p>{15}.</p></section>",
    "notice": "<div class='cookie-notice'><p>{16}.</p><button>{1}</button></div>",
    "consent": "<div role='dialog' class='consent'>{20}.</div>", "alert": "<div role='alert' class='notice'>{12}.</div>",
    "newsletter": "<form class='newsletter'><p>{9}.</p><label>{2}</label><input><button>{1}</button></form>",
    "login": "<form action='/login'><label>{1}</label><input><p>{5}</p></form>",
    "search": "<form role='search'><input><button>{1}</button></form>",
    "share": "<div class='share social'><a href='#'>{1}</a> <a href='#'>{1}</a></div>",
    "related": "<div class='related-posts'><h3>{2}</h3><ul><li><a href='#'>{6}</a></li><li><a href='#'>{7}</a></li></ul></div>",
    "aside": "<aside><h3>{2}</h3><p>{20}.</p></aside>", "sidebar": "<div class='sidebar'><h4>{2}</h4><p>{12}.</p>"
    "<ul><li><a href='#'>{3}</a></li><li><a href='#'>{2}</a></li></ul></div>",
    "widget": "<aside class='widget'><ul><li><a href='#'>{4}</a></li></ul></aside>",
    "comments": "<section id='comments' class='comments'><h3>{2}</h3><div class='comment'><p>{22}.</p></div>"
    "<div class='comment'><p>{35}.</p></div></section>",
    "comment_list": "<ol class='comment-list'><li class='comment'><p>{18}.</p></li><li class='comment'><p>{9}.</p></li></ol>",
    "replies": "<div class='responses'><article class='comment'><header>{2}</header><p>{24}.</p></article></div>",
    "nested_replies": "<section class='comments'><h2>{2}</h2><article><p>{30}.</p><footer>{2}</footer></article>"
    "<article><p>{12}.</p></article></section>",
    "thread": "<div id='disqus_thread'><ul><li><p>{25}.</p></li><li><p>{8}.</p></li></ul></div>",
    "breadcrumb": "<div class='breadcrumbs'><a href='#'>{1}</a> / <a href='#'>{2}</a></div>",
    "pager": "<div class='pagination'><a href='#'>{1}</a> <a href='#'>{1}</a></div>",
    "tags": "<ul class='tags'><li><a href='#'>{1}</a></li><li><a href='#'>{1}</a></li></ul>",
    "toc": "<nav class='toc'><ul><li><a href='#'>{3}</a></li><li><a href='#'>{3}</a></li></ul></nav>",
}
HEAD = (
    "<nav><ul><li><a href='/'>{1}</a></li><li><a href='/'>{1}</a></li><li><a href='/'>{2}</a></li></ul></nav>",
    "<header><a href='/'>{2}</a><p>{6}</p><nav><ul><li><a href='#'>{1}</a></li></ul></nav></header>",
    "<div id='header'><div class='logo'>{2}</div></div><div class='menu'><a href='#'>{1}</a> <a href='#'>{1}</a></div>",
    "<div class='masthead'><h1>{2}</h1><p>{8}</p></div><div role='navigation'><ul><li><a href='#'>{1}</a></li></ul></div>",
    "<header class='site-header'><h2>{3}</h2></header><ul class='navbar'><li><a href='#'>{1}</a></li></ul>",
)
FOOT = (
    "<footer>&copy; {2} &middot; <a href='#'>{1}</a></footer>", "<footer><p>{14}.</p><ul><li><a href='#'>{1}</a></li></ul></footer>",
    "<div id='footer'><p>&copy; {6}.</p></div>", "<div class='site-footer copyright'>{12}. <a href='#'>{2}</a></div>",
)
# Around the article; "|" is its place.
MAIN = (
    "<article><h1>{6}</h1>|</article>", "<main><article><header><h1>{5}</h1></header>|</article></main>",
    "<div class='content'><h1>{7}</h1>|</div>", "<div id='main'><div class='post entry-content'>|</div></div>",
    "<main>|</main>", "<section class='article-body'><h1>{4}</h1>|</section>", "<article class='story'>|</article>",
    "<div class='container'><div class='article'><h2>{5}</h2>|</div></div>", "<h1>{5}</h1>|", "<div><div>|</div></div>",
)
LABEL = "data-label"


def _marked(fragment: str, label: int) -> str:
    return f"<span {LABEL}={label}>{fragment}</span>"


def labelled_pages(count: int = 600, seed: int = 5) -> list[str]:
    """Pages whose fragments stand in ``<span data-label=0|1>`` marks, which the reader of the
    training pages turns into labels and otherwise ignores."""
    draw = random.Random(seed)

    def filled(fragment: str) -> str:
        out, rest = [], fragment
        while "{" in rest:
            text, _, rest = rest.partition("{")
            number, _, rest = rest.partition("}")
            n = max(1, round(int(number) * draw.uniform(0.5, 1.6)))
            words = [draw.choice("abcdefghij") * draw.randint(1, 8) for _ in range(n)]
            out += [text, " ".join(w + "," if k % 9 == 8 else w for k, w in enumerate(words)).capitalize()]
        return "".join([*out, rest])

    pages = []
    content, chrome = list(CONTENT.values()), list(CHROME.values())
    for k in range(count):
        inner = []
        for _ in range(draw.randint(2, 12)):
            inner.append(_marked(draw.choice(content[:8] if draw.random() < 0.6 else content), 1))
            if draw.random() < 0.3:
                inner.append(_marked(draw.choice(chrome), 0))
        before, after = MAIN[k % len(MAIN)].split("|")
        around = [draw.choice(chrome) for _ in range(draw.randint(0, 5))]
        at = draw.randint(0, len(around))
        parts = [_marked(HEAD[k % len(HEAD)], 0), *(_marked(c, 0) for c in around[:at]),
                 f"<span {LABEL}=1>{before}{''.join(inner)}{after}</span>",
                 *(_marked(c, 0) for c in around[at:]), _marked(FOOT[k % len(FOOT)], 0)]
        pages.append(filled(f"<!DOCTYPE html><html><body>{''.join(parts)}</body></html>"))
    return pages
