"""Main text of web pages by line-block distribution.

Markup is stripped into text blocks, the lengths of the blocks are summed over
sliding windows, and the text between the points where the sums surge and dive
is kept.  Blocks in navigation, advert, form and comment elements take no part.
Where what was kept is mostly in the page's article, its ends are moved to those
of the article, so that short paragraphs there stay.
"""

import re
from collections import Counter
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Blocks in a window, and the characters in a window from which it counts as text.
WINDOW = 3
SURGE = 86
#: Part of the kept text that is in an article, from which the article's ends are taken.
ARTICLE_SHARE = 0.3

# Names of elements, and words in class, id and role, by their part in a page.
RAW = frozenset("script style noscript template textarea select svg iframe object canvas title math video audio".split())
BLOCK = frozenset(
    "html head body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption section article main nav aside header "
    "footer form fieldset blockquote pre figure figcaption address details summary hr dialog menu center".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = frozenset("nav footer aside form menu dialog button head label".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "footer masthead cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login share sharing "
    "social related recommended comment comments disqus respond reply replies toolbar pagination pager widget complementary contentinfo search "
    "alert skip banner".split()
)
COMMENTS = frozenset("comment comments disqus respond reply replies".split())

_MARKUP = re.compile(r"<(?=[!?/A-Za-z])")
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:"[^"]*+"|'[^']*+'|[^>"'])*+)>|<[!?/][^>]*>""", re.S)
_UNQUOTED = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*+)([^>]*)>|<[!?/][^>]*>", re.S)
_NAMED = re.compile(r"""(?:^|[\s"'])(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)


class _Page:
    """Blocks of one page as (text, characters in links, aside, in the article)."""

    def __init__(self) -> None:
        self.blocks: list[tuple[str, int, bool, bool]] = []
        self.parts: list[str] = []
        self.linked = 0
        self.open: list[tuple[str, bool, bool]] = []  # name, aside, article
        self.names: Counter[str] = Counter()

    def state(self) -> tuple[bool, bool]:
        return (self.open[-1][1], self.open[-1][2]) if self.open else (False, False)

    def end_block(self) -> None:
        text = " ".join(unescape("".join(self.parts)).split())
        if text:
            self.blocks.append((text, self.linked, *self.state()))
        self.parts, self.linked = [], 0

    def begin(self, name: str, attributes: str) -> None:
        if name in BLOCK:
            self.end_block()
            while self.open and self.open[-1][0] in ("p", "li", "dt", "dd", "td", "th", "tr") and (self.open[-1][0] == "p" or self.open[-1][0] == name):
                self.names[self.open.pop()[0]] -= 1
        if name in VOID:
            return
        aside, article = self.state()
        marks: set[str] = set()
        hidden = False
        for key, *values in _NAMED.findall(attributes) if attributes else ():
            value, key = "".join(values).lower(), key.lower()
            if key in ("class", "id", "role"):
                marks.update(re.split(r"[^a-z0-9]+", value))
            else:
                hidden |= key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", ""))
        if name in ("html", "body"):
            marks, hidden = set(), False
        if name in ("article", "main"):
            aside, article = aside or bool(marks & COMMENTS), True
        else:
            aside = aside or name in ASIDE or bool(marks & MARKS) or (not article and (name == "header" or "header" in marks))
        self.open.append((name, aside or hidden, article))
        self.names[name] += 1

    def finish(self, name: str) -> None:
        if name in BLOCK:
            self.end_block()
        if not self.names[name]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == name:
                self.names.subtract(x[0] for x in self.open[i:])
                del self.open[i:]
                break
            if name not in BLOCK and self.open[i][0] in BLOCK:
                break

    def text(self, text: str) -> None:
        self.parts.append(text)
        if any(x[0] == "a" for x in self.open[-3:]):
            self.linked += len(text.strip())


def blocks(html: str) -> list[tuple[str, int, bool, bool]]:
    """The text blocks of a page in order; comments, scripts, styles and other raw elements are left out.

    A quoted value may hold ``>``.  From the first tag whose quotes do not close,
    quotes count as other characters.  A last tag without an end is text.
    """
    page, at, last = _Page(), 0, html.rfind(">")
    pattern = _TOKEN
    while markup := _MARKUP.search(html, at):
        start = markup.start()
        if start > last and not html.startswith("<!--", start):
            break
        token = pattern.match(html, start)
        if token is None:
            pattern = _UNQUOTED
            token = pattern.match(html, start)
        if start > at:
            page.text(html[at:start])
        at = token.end()
        if not token[2]:
            continue
        name = token[2].lower()
        if token[1]:
            page.finish(name)
        elif name in RAW:
            if not token[3].endswith("/"):
                end = re.compile(f"</{re.escape(name)}", re.I).search(html, at)
                at = html.find(">", end.end()) + 1 if end else 0
                at = at or len(html)
        elif name == "br":
            page.text(" ")
        else:
            page.begin(name, token[3])
    page.text(html[at:])
    page.end_block()
    return page.blocks


def _spans(weights: list[int]) -> list[tuple[int, int]]:
    """(start, end) of the runs of blocks between a surge of the window sums and the next dive."""
    out: list[tuple[int, int]] = []
    for i in range(len(weights)):
        if sum(weights[i : i + WINDOW]) >= SURGE:
            end = min(i + WINDOW, len(weights))
            if out and i <= out[-1][1]:
                out[-1] = (out[-1][0], end)
            else:
                out.append((i, end))
    return out


def _at_article(span: tuple[int, int], article: list[bool]) -> tuple[int, int]:
    """``span`` with its ends moved to those of the article there: in past other blocks, then out over the article's."""
    start, end = span
    while start < end and not article[start]:
        start += 1
    while end > start and not article[end - 1]:
        end -= 1
    if start < end:
        while start > 0 and article[start - 1]:
            start -= 1
        while end < len(article) and article[end]:
            end += 1
    return start, end


def main_text(html: str | None) -> str:
    """The main text of one page; empty for null, for no text, and where nothing but asides is found.

    Where no window surges, the whole page is the span.
    """
    found = [b for b in blocks(html or "") if not b[2]]
    weights = [max(0, len(text) - 2 * linked) for text, linked, _, _ in found]
    article = [b[3] for b in found]
    spans = _spans(weights) or [(0, len(found))]
    sizes = [(sum(len(found[i][0]) for i in range(*s) if article[i]), sum(len(found[i][0]) for i in range(*s))) for s in spans]
    if 0 < sum(s[0] for s in sizes) >= ARTICLE_SHARE * sum(s[1] for s in sizes):
        spans = [_at_article(s, article) for s in spans]
    keep = {i for s in spans for i in range(*s) if article[i] or weights[i] > 0}
    return "\n".join(found[i][0] for i in sorted(keep))


@F.pandas_udf(T.StringType())
def _main_texts(pages: pd.Series) -> pd.Series:
    return pages.map(main_text, na_action=None)


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``; a null page has an empty text, repeated rows stay.

    Character references are decoded, white space in a block becomes one space,
    and blocks are joined by line feeds.  No rows give no rows.
    """
    text = pages.select("page_id", "url", _main_texts(F.coalesce(F.col(html_column), F.lit(""))).alias("text"))
    return text.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
