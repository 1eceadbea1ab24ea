"""Main text of web pages: parser events, text-to-tag ratios, smoothing, clustering.

The standard library's parser is fed a page piece by piece; its events cut the page into
lines (the text between two block-level tags), and no tree is built. Each line has the
ratio of its characters outside links to the tags met since the line before. Ratios are
smoothed by a Gaussian over neighbouring lines; lines at or above the standard deviation of
the smoothed ratios are content, and the element that holds a content line is a content
region, of which every line stays, short ones too.

What is never content counts with a ratio of 0: menus, page headers, footers, sidebars,
notices, adverts, forms, scripts, styles, hidden parts and reader comments, known by
element, role, or a word of the class or id. If a page marks its article (``article``,
``main`` or their roles), only lines inside of it are looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Characters given to the parser at a time.
PIECE = 1 << 20
#: Standard deviation of the Gaussian, in lines; it reaches three of them.
SIGMA = 1.0
#: A line's ratio has to reach so many standard deviations of the page's ratios.
THRESHOLD = 1.0
#: An element inside a content region stays unless links make up more of its text.
LINKED = 0.5

# Elements of the HTML standard.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend "
    "li main menu nav ol p pre search section summary table tbody td tfoot th thead tr "
    "ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What holds lines; the innermost of them is a line's element.
HOLDERS = frozenset(
    "article aside blockquote body details dialog div dl fieldset figure footer form header "
    "main menu nav ol section table td th ul".split()
)
#: Opening one of these ends an open one of the listed kind in the same holder.
ENDS = {
    **dict.fromkeys(
        "address article aside blockquote center details div dl fieldset figure footer form "
        "h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split(),
        ("p",),
    ),
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr",),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}

NEVER = frozenset(
    "script style head title noscript template iframe object svg canvas audio video map "
    "select textarea button datalist nav aside footer menu dialog search".split()
)
NEVER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu "
    "menubar toolbar".split()
)
#: Words of class and id names that mark what is not content.
NEVER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo "
    "promotion banner nav navbar navigation menu menus breadcrumb breadcrumbs pagination "
    "pager footer foot sidebar sidebars rail widget widgets cookie cookies consent gdpr "
    "notice notices notification disclaimer paywall popup modal overlay toast alert "
    "newsletter subscribe subscription signup login share sharing social related "
    "recommended teaser teasers masthead topbar toolbar copyright skip adsbygoogle".split()
)
#: The same for what readers have written; an article inside of it is a comment too.
COMMENT_WORDS = frozenset("comment comments disqus respond replies reply discussion".split())
#: Like the element ``header``: nothing of it stays but an article's headings.
HEADER_WORDS = frozenset("header head".split())
ARTICLE_WORDS = frozenset("article post entry story content".split())
#: Next to a word of ``NEVER_WORDS`` these name what is around a page's columns.
LAYOUT_WORDS = frozenset("layout wrapper container page site content main".split())
#: A class name with one of these only says what is elsewhere ("has-sidebar").
TELLS = frozenset("has no with without".split())
_BROKEN = re.compile("<[A-Za-z/!?]")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: How an element treats its text: PART of content, HEADER, LAYOUT (not content, unless an
#: article begins inside of it) or OUT.
PART, HEADER, LAYOUT, OUT = range(4)


def _words(*names: str | None) -> set[str]:
    found = set()
    for name in " ".join(filter(None, names)).split():
        words = {w.lower() for w in _WORD.findall(name)}
        if not words & TELLS:
            found |= words
    return found


def _begins_article(tag: str, attrs: dict[str, str | None]) -> bool:
    return tag in ("article", "main") or (attrs.get("role") or "").lower() in (
        "article",
        "main",
    )


def _kind(tag: str, attrs: dict[str, str | None], in_article: bool) -> int:
    if tag in ("html", "body"):
        return PART
    style = (attrs.get("style") or "").replace(" ", "").lower()
    unseen = "hidden" in attrs or attrs.get("aria-hidden") == "true"
    if tag in NEVER or unseen or "display:none" in style:
        return OUT
    names = _words(attrs.get("class"), attrs.get("id"))
    if names & COMMENT_WORDS:
        return OUT
    if _begins_article(tag, attrs):
        return PART
    if tag == "header" or names & HEADER_WORDS:
        return HEADER if in_article or names & ARTICLE_WORDS else LAYOUT
    if (attrs.get("role") or "").lower() in NEVER_ROLES or names & NEVER_WORDS:
        return LAYOUT if names & LAYOUT_WORDS else OUT
    return LAYOUT if tag == "form" else PART


class _Lines(HTMLParser):
    """Lines of a page; the text of a line that can't be content is dropped at once."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        #: Per open element: tag, kind in force, in an article, in a link, holder, heading.
        self.open: list[tuple[str, int, bool, bool, int, bool]] = [
            ("", PART, False, False, 0, False)
        ]
        self.count: dict[str, int] = {}
        #: The holder around each holder.
        self.parents = [0]
        self.texts: list[str | None] = []
        self.plain: list[int] = []
        self.linked: list[int] = []
        self.tags: list[int] = []
        self.holders: list[int] = []
        self.marked: list[bool] = []
        self.parts: list[str] = []
        self.n_tags = self.n_plain = self.n_linked = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.n_tags += 1
        for other in ENDS.get(tag, ()):
            self._close(other, within=HOLDERS - {other})
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        _, kind, article, link, holder, heading = self.open[-1]
        named = dict(attrs)
        own = _kind(tag, named, article)
        if own == PART and kind != OUT and _begins_article(tag, named):
            kind, article = PART, True
        else:
            kind = max(kind, own)
        if tag in HOLDERS:
            self.parents.append(holder)
            holder = len(self.parents) - 1
        self.open.append(
            (tag, kind, article, link or tag == "a", holder, heading or tag in HEADINGS)
        )
        self.count[tag] = self.count.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        # A slash closes only foreign elements; HTML's own stay open.
        if tag not in VOID and tag not in BLOCKS:
            self._close(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.n_tags += 1
        self._close(tag)

    def _close(self, tag: str, within: frozenset[str] = frozenset()) -> None:
        """Close the last open ``tag`` and what is open in it; not beyond ``within``."""
        if not self.count.get(tag):
            return
        at = len(self.open) - 1
        while self.open[at][0] != tag:
            if self.open[at][0] in within:
                return
            at -= 1
        for gone in self.open[at:]:
            self.count[gone[0]] -= 1
        del self.open[at:]

    def handle_data(self, data: str) -> None:
        _, kind, _, link, _, heading = self.open[-1]
        if kind == PART or kind == HEADER and heading:
            self.parts.append(data)
            size = len(data) - data.count(" ")
            if link:
                self.n_linked += size
            else:
                self.n_plain += size

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            _, _, article, _, holder, _ = self.open[-1]
            self.texts.append(text)
            self.plain.append(self.n_plain)
            self.linked.append(self.n_linked)
            self.tags.append(max(self.n_tags, 1))
            self.holders.append(holder)
            self.marked.append(article)
            self.n_tags = self.n_plain = self.n_linked = 0
        elif self.n_tags > 1 and self.texts and self.texts[-1] is not None:
            # Something without content lies between: neighbours are further apart.
            self._gap()
        self.parts.clear()

    def finish(self) -> None:
        """End the page; a tag or comment that it breaks off in is no text."""
        if self.cdata_elem is None and _BROKEN.match(self.rawdata):
            self.rawdata = ""
        self.close()
        self.end_line()

    def _gap(self) -> None:
        self.texts.append(None)
        self.plain.append(0)
        self.linked.append(0)
        self.tags.append(1)
        self.holders.append(0)
        self.marked.append(False)


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian means over neighbouring lines; beyond the ends there is nothing."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(ratios, kernel / kernel.sum())[reach : reach + len(ratios)]


def content_lines(ratios: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Which lines belong to the cluster of high ratios."""
    smoothed = smooth(ratios)
    return (smoothed > 0) & (smoothed >= threshold * smoothed.std())


def main_text(html: str) -> str:
    """The main text of one page, blocks joined by an empty line."""
    lines = _Lines()
    for at in range(0, len(html), PIECE):
        lines.feed(html[at : at + PIECE])
    lines.finish()
    if not lines.texts:
        return ""
    plain, linked = np.array(lines.plain, float), np.array(lines.linked, float)
    there = np.array([t is not None for t in lines.texts])
    marked, holders = np.array(lines.marked), np.array(lines.holders)
    if (marked & there).any():
        there &= marked
    ratios = np.where(there, plain / np.array(lines.tags), 0.0)
    core = content_lines(ratios) & there
    parents = lines.parents
    n = len(parents)
    text = np.bincount(holders, plain + linked, n)
    links = np.bincount(holders, linked, n)
    kept = np.zeros(n, bool)
    kept[holders[core]] = True
    # Holders are numbered as they open: those inside come after those around them.
    for k in range(n - 1, 0, -1):
        text[parents[k]] += text[k]
        links[parents[k]] += links[k]
    for k in range(1, n):
        if kept[parents[k]] and links[k] <= LINKED * text[k]:
            kept[k] = True
    stays = there & kept[holders]
    return "\n\n".join(lines.texts[i] for i in np.flatnonzero(stays))


def _extractor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        # One page at a time, so that a batch of long pages isn't held twice.
        texts = [main_text(page.as_py() or "") for page in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages``; other columns aren't read.

    ``text`` is the page's main text: white space inside a block is one space, blocks are
    joined by ``\\n\\n``; ``n_chars`` counts its code points. A null or empty page, or one
    without content, has an empty text. Nulls in the other columns and repeated rows come
    back as they are; an empty table gives none. A page is one task's work and is held in
    memory once, with those of its lines that may be content; nothing is cut.
    """
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(
        _extractor,
        f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long",
    )
