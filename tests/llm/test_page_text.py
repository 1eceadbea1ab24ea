"""Main text of pages: rules on small pages, a plain reading of the given ones."""

from __future__ import annotations

import html
import re

import pytest

from sparkmart.llm import page_text, queries

LONG = "Some long words of an article, told in their order. " * 4
P = f"<p>{LONG}</p>"
TEXT = LONG.strip()


def text(page):
    """The page's text; the same however the page is cut for the parser."""
    whole = page_text.main_text(page)
    held, page_text.PIECE = page_text.PIECE, 5
    try:
        assert page_text.main_text(page) == whole
    finally:
        page_text.PIECE = held
    return whole


CASES = {
    "empty": ("", ""),
    "no markup": ("a &lt;b&gt; &amp c", "a <b> & c"),
    "only a menu": ("<nav><ul><li><a href=x>Home</a></ul></nav>", ""),
    "references": ("<p>x&nbsp;y &#x41;&#66; &eacute; &bogus; 3 < 4 &#0;</p>", "x y AB é &bogus; 3 < 4 �"),
    "white space": ("<pre>a\n  b\tc</pre><p>\n d<br>e <b>f</b>g\n</p>", "a b c\n\nd e fg"),
    "a reference in a script": ("<script>var p='</p>';</script><style>p{}</style><p>x</p>", "x"),
    "open elements": (f"<article><p><b>One.<br><p>Two.<p>{TEXT}</article>", f"One.\n\nTwo.\n\n{TEXT}"),
    "lists and tables": (
        "<article><ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><th>3</table></article>",
        "a\n\nb\n\n1\n\n2\n\n3",
    ),
    "comments of readers": (f"<main>{P}</main><div id=comments><article>{P}</article></div>", TEXT),
    "comments in the article": (f"<article>{P}<section class='post-comments'>{P}</section></article>", TEXT),
    "aside and footer in the article": (
        f"<article><header><h1>T &amp; U</h1><p>by me</p></header><p>S.</p><aside>{P}</aside><footer>{P}</footer></article>",
        "T & U\n\nS.",
    ),
    "page header": (f"<header><h1>Site</h1></header><div id=content><h1>T</h1>{P}</div>", f"T\n\n{TEXT}"),
    "a form around all": (f"<form><div class='cookie-notice'>{P}</div><article>{P}<input></article></form>", TEXT),
    "a form in the article": (f"<article>{P}<form><label>{LONG}</label></form></article>", TEXT),
    "advert by class": (f"<div class='story'>{P}<div class='ad'>{P}</div><p>End.</p></div>", f"{TEXT}\n\nEnd."),
    "class about elsewhere": (f"<div class='page has-sidebar'>{P}</div>", TEXT),
    "hidden": (f"<article>{P}<p hidden>{LONG}</p><p style='display: none'>{LONG}</p></article>", TEXT),
    "links without a name": (
        f"<div><div>{P}{P}</div><div><a href=1>{LONG}</a><a href=2>{LONG}</a></div></div>",
        f"{TEXT}\n\n{TEXT}",
    ),
    "short remarks without a name": (
        f"<div><div>Top</div><div>{P}<blockquote><p>Ha.</p></blockquote>{P}</div>"
        + "<div>a</div><div>b</div><div>c</div><div>d</div></div>",
        f"{TEXT}\n\nHa.\n\n{TEXT}",
    ),
    "teasers": (
        f"<article>{P}{P}{P}</article><div class=related><article><h3>Next</h3></article></div>",
        f"{TEXT}\n\n{TEXT}\n\n{TEXT}",
    ),
    "broken off in a tag": (f"<article>{P}<p>End <a href='x", f"{TEXT}\n\nEnd"),
    "broken off in a comment": (f"<article>{P}<p>End <!-- x", f"{TEXT}\n\nEnd"),
    "end tags of nothing": (f"</div></p></article><article>{P}</b></article></div>", TEXT),
    "capitals": (f"<ARTICLE><P>One.</P>{P}</ARTICLE><FOOTER>x</FOOTER>", f"One.\n\n{TEXT}"),
}


@pytest.mark.parametrize("name", CASES)
def test_small_pages(name):
    page, wanted = CASES[name]
    assert text(page) == wanted


def test_long_pages():
    """Many open elements, and one long page: time and memory grow with the page."""
    many = "<article>" + "<p><b>" + "<p><b>".join(f"w{i}" for i in range(200_000)) + "</article>"
    assert page_text.main_text(many).split() == [f"w{i}" for i in range(200_000)]
    assert page_text.main_text("<div>" * 100_000 + "x") == "x"
    assert page_text.main_text("<a " * 200_000) == ""


def plain(page):
    """The article's blocks by regular expressions; holds for the given pages only."""
    article = re.search("<article>(.*)</article>", page, re.S).group(1)
    blocks = [
        " ".join(html.unescape(re.sub("<[^>]*>", "", block)).split())
        for block in re.split(r"</?(?:p|h1)>", article)
    ]
    return "\n\n".join(filter(None, blocks))


def test_registered_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    found = sorted(tuple(r) for r in queries.queries()["op13_pages"](spark, sf_dir).collect())
    wanted = [(r.page_id, r.url, plain(r.html)) for r in pages]
    assert found == sorted((*w, len(w[2])) for w in wanted)


def test_odd_rows(spark):
    frame = spark.createDataFrame(
        [(1, None, "<p>a</p>", 7), (1, None, "<p>a</p>", 7), (None, "u", None, 7), (2, "v", "", 7)],
        "page_id long, url string, html string, text long",
    )
    rows = sorted((tuple(r) for r in page_text.extract(frame).collect()), key=repr)
    assert rows == [(1, None, "a", 1), (1, None, "a", 1), (2, "v", "", 0), (None, "u", "", 0)]
    assert page_text.extract(frame.limit(0)).collect() == []
