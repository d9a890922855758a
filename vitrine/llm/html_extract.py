"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block-level element. Every line weighs its text
length; lines of page furniture (menus, headers, footers, sidebars, notices, adverts, forms,
reader comments) and, outside an article element, lines that are mostly links weigh nothing.
The weights are summed over a sliding window of lines. Where the sums rise above the threshold
from nothing is a surge, where a whole window weighs nothing is the dive; text between the first
surge (with the lighter lines that lead to it without such a gap) and the last dive is kept. On pages that mark their article, furniture and everything outside the
article weigh nothing and any text at all is a surge; elsewhere the threshold follows the page.

Spark partitions the pages; a task reads one page at a time, in time linear in its length.

Defined results: a null or empty html, or a page without main text, gives an empty text and
``n_chars`` 0; null ids and urls are kept; repeated rows give repeated result rows; an empty
table gives an empty result; columns beside the three are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import slices, table

#: Lines in a window.
WINDOW = 3
#: Without an article element: a surge reaches this many characters, or half the page's highest
#: window if that is less.
SURGE = 80
LINK_SHARE = 0.5

BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary
    table tbody td tfoot th thead title tr ul""".split())
HIDDEN = frozenset("""head title script style noscript template svg iframe object select option button textarea canvas
    video audio map datalist""".split())
FURNITURE = frozenset("nav aside footer form menu dialog search".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Words of class and id values that mark furniture.
MARKS = re.compile(r"""(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|advertising|banner|breadcrumb|breadcrumbs|comment|comments|commentlist
    |consent|cookie|cookies|copyright|disqus|feedback|footer|gdpr|header|login|masthead|menu|modal|nav|navbar|navigation|newsletter
    |notice|notification|pager|pagination|popup|promo|promoted|promotion|recommended|related|replies|respond|share|sharing|sidebar|signup
    |skip|social|sponsor|sponsored|subscribe|tags|teaser|toolbar|topbar|widget|widgets)(?:$|[\s_-])""", re.X)
MARKED = frozenset("div section ul ol li p span table article aside dl details figure td".split())
#: Elements whose end tags of other elements do not reach past.
FENCES = frozenset("article main nav aside footer header form body table".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that the parser keeps track of; all others only separate or decorate text.
TRACKED = HIDDEN | FURNITURE | FENCES | MARKED - {"p", "li", "td", "span"}


#: Elements whose content is text up to their own end tag.
RAW = frozenset("script style textarea title noscript iframe template svg".split())
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
TAG_END = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
ATTRS = re.compile(r"""(?:^|[\s"'])(class|id|role|style|hidden)(?=[\s=]|$)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)


class Lines:
    """Lines of a page: text, characters inside links, furniture, inside an article."""

    def __init__(self):
        self.lines: list[tuple[str, int, bool, bool]] = []
        self.stack: list[tuple[str, bool, bool, bool]] = []  # name, hidden, furniture, article
        self.text: list[str] = []
        self.link_chars, self.in_link = 0, False
        self.open: Counter = Counter()

    def read(self, html: str) -> None:
        """Split a page into tags and text. What never closes (a tag, a comment, a script)
        hides the rest of the page, as in a browser."""
        at, quotes, n = 0, True, len(html)
        while at < n:
            tag = html.find("<", at)
            if tag < 0:
                self.data(html[at:])
                break
            if tag > at:
                self.data(html[at:tag])
            if html.startswith("<!--", tag):
                end = html.find("-->", tag + 4)
                at = end + 3 if end >= 0 else n
                continue
            name = NAME.match(html, tag)
            if name is None:
                if html[tag + 1:tag + 2] in ("!", "?", "/"):
                    end = html.find(">", tag)
                    at = end + 1 if end >= 0 else n
                else:
                    self.data("<")
                    at = tag + 1
                continue
            end = -1
            if quotes:
                closed = TAG_END.match(html, name.end())
                end = closed.end() if closed else -1
                quotes = closed is not None  # a quote left open: from here on a tag ends at the next >
            if end < 0:
                end = html.find(">", name.end()) + 1
                if not end:
                    break
            tag_name = name[1].lower()
            if html[tag + 1] == "/":
                self.end(tag_name)
            else:
                self.start(tag_name, html[name.end():end - 1])
                if tag_name in RAW:
                    close = re.compile(f"</{tag_name}(?=[\\s/>])", re.I).search(html, end)
                    end = close.start() if close else n
            at = end

    def state(self) -> tuple[bool, bool, bool]:
        return self.stack[-1][1:] if self.stack else (False, False, False)

    def cut(self) -> None:
        if self.text:
            line = " ".join("".join(self.text).split())
            if line:
                _, furniture, article = self.state()
                self.lines.append((line, self.link_chars, furniture, article))
            self.text = []
        self.link_chars = 0

    def start(self, tag: str, attrs: str) -> None:
        if tag == "a":
            self.in_link = True
        elif tag in ("br", "img", "wbr"):
            self.text.append(" " if tag == "br" else "")
        if tag in BLOCKS:
            self.cut()
            if self.stack and self.stack[-1][0] == "head" and tag not in ("title", "head"):
                self.open[self.stack.pop()[0]] -= 1  # a head that was not closed
        if tag in VOID or tag not in TRACKED and tag not in MARKED:
            return
        hidden, furniture, article = self.state()
        known = {k.lower(): unescape(x or y or z).lower() for k, x, y, z in ATTRS.findall(attrs)} if attrs else {}
        names = f"{known.get('class', '')} {known.get('id', '')}"
        role = known.get("role")
        marked = tag in MARKED and MARKS.search(names) is not None
        if "hidden" in known or "display:none" in known.get("style", "").replace(" ", ""):
            marked = True
        if tag not in TRACKED and not marked:
            return
        if tag in ("article", "main") and not marked:
            # an article inside a wrapper that looked like furniture, or after a menu left open
            furniture, article = (furniture if article else False), True
        elif marked or tag in FURNITURE or role in ROLES or tag == "header" and not article:
            furniture = True
        self.open[tag] += 1
        self.stack.append((tag, hidden or tag in HIDDEN, furniture, article))

    def end(self, tag: str) -> None:
        if tag == "a":
            self.in_link = False
        if tag in BLOCKS:
            self.cut()
        if not self.open[tag]:
            return
        for k in range(len(self.stack) - 1, -1, -1):
            name = self.stack[k][0]
            if name == tag:
                self.open.subtract(x[0] for x in self.stack[k:])
                del self.stack[k:]
                break
            if name in FENCES and tag not in FENCES:
                break

    def data(self, data: str) -> None:
        if not self.state()[0]:
            if "&" in data:
                data = unescape(data)
            self.text.append(data)
            if self.in_link:
                self.link_chars += len("".join(data.split()))


def page_lines(html: str) -> list[tuple[str, int, bool, bool]]:
    p = Lines()
    p.read(html)
    p.cut()
    return p.lines


def window_sums(weights: np.ndarray, window: int) -> np.ndarray:
    """Sum of the ``window`` weights from each line on."""
    total = np.cumsum(np.r_[0, weights, np.zeros(window, weights.dtype)])
    return total[window:window + len(weights)] - total[:len(weights)]


def main_text(html: str | None, window: int = WINDOW) -> str:
    lines = page_lines(html) if html else []
    if not lines:
        return ""
    marked = any(article and not furniture for _, _, furniture, article in lines)
    weights = np.array([0 if furniture or marked and not article
                        or not article and linked > LINK_SHARE * len("".join(line.split())) else len(line)
                        for line, linked, furniture, article in lines])
    if not weights.any():
        return ""
    sums = window_sums(weights, window)
    least = 1 if marked else min(SURGE, sums.max() / 2)
    regions = []
    at = 0
    while at < len(lines):
        if sums[at] < least or not weights[at]:
            at += 1
            continue
        end = at  # the dive: a whole window without weight
        while end < len(lines) and sums[end] > 0:
            end += 1
        regions.append((at, end))
        at = end
    if not regions:
        return ""
    first = regions[0][0]  # backwards as well, text goes on up to a whole window without weight
    while first and weights[max(0, first - window):first].any():
        first -= 1
    # what lies between the first surge and the last dive stays whatever its size
    kept = [k for k in range(first, regions[-1][1]) if weights[k]]
    return "\n".join(lines[k][0] for k in kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    def run(batches):
        for b in slices(batches, "html"):
            text = [main_text(x) for x in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(text, pa.string()),
                                              pa.array(list(map(len, text)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       F.col(html_col).cast("string").alias("html"))
    return src.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
