"""Main text of pages: by hand, and against the article of the given pages as the standard parser reads it."""

import re
import time
from html.parser import HTMLParser

from cartsight.llm import html

PARAGRAPH = "A paragraph of the article that is long enough to count as running text in any window of lines."
PAGE = f"""<!DOCTYPE html><html><head><title>Not this</title><style>p {{}}</style><script>var t = "</p><p>nor this";</script></head><body class="page nav-open">
<header class="site-header"><a href="/">Home</a></header><nav><ul><li>One<li>Two</ul></nav><div id="cookie-notice">We use cookies &amp; more.</div>
<article><header><h1>The   Title</h1></header><p>{PARAGRAPH}<p>Short &lt;one&gt;.<div class="ad">Buy now</div><p>Third&nbsp;with <b>bold</b><br>line.</p>
<!-- a > comment --><form><label>Mail</label><input></form><section class="comments"><p>{PARAGRAPH} says a reader</p></section></article>
<aside>See also</aside><footer>&copy; 2024</footer></body></html>"""


def test_page():
    assert html.main_text(PAGE) == f"The Title\n{PARAGRAPH}\nShort <one>.\nThird with bold line."


def test_without_article():
    body = f"<body><div class='menu'><a href=x>Menu</a></div><div><a href=y>Link one</a></div><div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div><div id=footer>End</div></body>"
    assert html.main_text(body) == f"{PARAGRAPH}\n{PARAGRAPH}"


def test_odd_pages():
    for page in (None, "", "   ", "<nav>x</nav>", "<!-- x", "<script>x"):
        assert html.main_text(page) == ""
    assert html.main_text("a < b and <p>c") == "a < b and\nc"
    assert html.main_text("<p hidden>no</p><p>yes") == "yes"
    assert html.main_text("<p>" * 50_000 + "x").endswith("x")


class Article(HTMLParser):
    """Blocks of the article element."""

    def __init__(self):
        super().__init__()
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("p", "h1"):
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag in ("p", "h1"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html.extract(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        parser = Article()
        parser.feed(r["html"])
        text = "\n".join(x for x in (" ".join(b.split()) for b in parser.blocks) if x)
        assert got[r["page_id"]] == (text, len(text))


def test_given_pages_without_article_tags(spark):
    """The distribution alone finds the blocks of the article: it decides, the tags move the ends."""
    hits = wrong = missed = same = 0
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for r in pages:
        whole = html.main_text(r["html"]).split("\n")
        bare = html.main_text(re.sub(r"</?(?:article|main)\b[^>]*>", "", r["html"])).split("\n")
        both = sum(b in whole for b in bare)
        hits, wrong, missed, same = hits + both, wrong + len(bare) - both, missed + sum(b not in bare for b in whole), same + (whole == bare)
    assert hits / (hits + wrong) >= 0.99 and hits / (hits + missed) >= 0.99 and same >= 0.9 * len(pages)


def test_text_beside_the_article():
    """A teaser in an article element does not replace the text that the distribution finds."""
    page = f"<body><article><p>Teaser</p></article><nav>x</nav><div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div></body>"
    assert html.main_text(page).endswith(f"{PARAGRAPH}\n{PARAGRAPH}")
    page = f"<body><div>{PARAGRAPH}</div><article><p>{PARAGRAPH}</p><p>End</p></article><div>Beside</div></body>"
    assert html.main_text(page) == f"{PARAGRAPH}\nEnd"


def test_long_odd_pages_take_linear_time():
    """A megabyte that never closes what it opens."""
    began = time.process_time()
    for part in ('<a "', "<a '\"", "<!", "<", "</script", "<script>", "<p", "<div>", "</p>", "<a href=\">"):
        html.main_text("<div>" + part * (1_000_000 // len(part)))
        html.main_text("<script>" + part * (1_000_000 // len(part)) + ">")
    assert time.process_time() - began < 60


def test_unclosed_quotes():
    assert html.main_text('<p title="a>b">one</p><p title="x>two</p>') == "one\ntwo"


def test_extract_edges(spark):
    pages = spark.createDataFrame([(1, "u", None, 5), (None, None, "<p>x</p>", 5), (None, None, "<p>x</p>", 5)], "page_id int, url string, html string, n_chars int")
    rows = html.extract(pages).collect()
    assert sorted(((r["page_id"], r["text"], r["n_chars"]) for r in rows), key=repr) == [(1, "", 0), (None, "x", 1), (None, "x", 1)]
    assert html.extract(pages.limit(0)).count() == 0
