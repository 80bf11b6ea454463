import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow.parquet as pq

from dinerlake.llm import html_text
from dinerlake.llm.html_text import extract, main_text

ARTICLE = (
    "<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t='</p>';</script></head><body>"
    "<header class=top>Site name</header><nav><ul><li><a href=/a>Home</a></li></ul></nav><!-- ad --><div class=\"ad\">"
    "Buy this very good thing now because it is the best thing that anyone has ever sold to you.</div>"
    "<article><h1>A &amp; B</h1><p>First  para\n with <b>bold</b> and <a href=x>link</a>.<p>Second &lt;tag&gt;"
    "<br>after<script>x('<p>')</script></p><aside class='related-posts'>More to read here</aside>"
    "<div id=comments><p>Nice post, I really liked what you have to say about all of it.</p></div></article>"
    "<form><input name=q><button>Go</button></form><footer>&copy; 2020 Someone, all rights are reserved here</footer>"
    "</body></html>"
)


def test_article_without_furniture():
    assert extract(ARTICLE) == "A & B\nFirst para with bold and link.\nSecond <tag> after"


def test_cut_off_and_broken_pages():
    assert extract("<article><p>One two three</p><p>Four &am") == "One two three\nFour &am"
    assert extract("<article><p>One two three</p") == "One two three"
    assert extract("<nav><li>Menu<article><p>Text of the piece") == "Text of the piece"
    assert extract("<article><p>a <!-- never closed") == "a"
    assert extract("<article><script>never closed <p>x") == ""


def test_without_an_article_features_decide():
    text = " ".join(["word"] * 60)
    page = f"<div><a href=1>a</a> <a href=2>b</a></div><div>{text}</div><div>{text}</div><div><a href=3>c</a></div>"
    assert extract(page) == f"{text}\n{text}"


def test_hidden_notices_and_main(spark):
    page = "<div class='cookie-notice'>We use cookies</div><main><p>Body text</p><p style='display:none'>x</p></main>"
    assert extract(page) == "Body text"


def test_text_at_the_end_and_short_blocks_without_an_article():
    long, other = " ".join(["word"] * 300), " ".join(["text"] * 60)
    nav = "<div><a href=1>Home page</a></div><div><a href=2>About us</a></div>"
    assert extract(f"<body><p>{long}</p></body>") == long
    assert extract(f"<body>{nav}<p>{long}</p></body>") == long
    assert extract(f"<body>{nav}<h1>Head line here</h1><p>{other}</p><p>{long}</p>") == f"Head line here\n{other}\n{long}"
    assert extract(f"<p>{other}</p><p>He left.</p><h2>A part</h2><p>{long}</p><p>That is all.</p>") == (
        f"{other}\nHe left.\nA part\n{long}\nThat is all.")
    assert extract(f"<p>{other}</p><ul><li>one thing<li>two things<li>three</ul><p>{other}</p>") == (
        f"{other}\none thing\ntwo things\nthree\n{other}")
    assert extract(f"{nav}<p>{long}</p>{nav}<div>All rights reserved</div>") == long
    assert extract("<p>Just one short line of text</p>") == "Just one short line of text"


def test_link_lists_inside_an_article_go():
    text = " ".join(["word"] * 60)
    links = "<ul>" + "".join(f"<li><a href={i}>Another story of interest</a></li>" for i in range(5)) + "</ul>"
    for end in ("", f"<p>{text}</p>"):
        got = extract(f"<article><h1>Title</h1><p>{text}</p><p>See <a href=x>this</a> too</p>{links}{end}</article>")
        assert got == "\n".join(["Title", text, "See this too", *([text] if end else [])])
    # a linked line among text stays
    assert extract(f"<article><p>{text}</p><p><a href=x>The full report</a></p><p>{text}</p></article>") == (
        f"{text}\nThe full report\n{text}")


def test_no_leaf_rests_on_few_rows():
    table = np.array(html_text.LABELLED, dtype=float)

    def leaves(node, rows):
        if node.feature < 0:
            return [len(rows)]
        low = rows[:, node.feature] <= node.cut
        return leaves(node.low, rows[low]) + leaves(node.high, rows[~low])

    assert min(leaves(html_text.tree(), table)) >= 3


def test_layout_names_keep_the_article():
    story = "<h1>A head line</h1><p>" + "word " * 40 + "end</p>"
    want = "A head line\n" + "word " * 40 + "end"
    for name in ("content-sidebar-wrap", "has-sidebar", "no-sidebar", "layout-two-col sidebar-right", "sidebar-right",
                 "post comments-open", "page-header", "legal-news", "header"):
        assert extract(f"<body><div class='{name}'><main>{story}</main></div>") == want, name
        assert extract(f"<body><div id='{name}'><div><article>{story}</article></div></div>") == want, name
        assert extract(f"<body><article class='{name}'>{story}</article>") == want, name
        assert extract(f"<body><main><div class='{name}'>{story}</div></main>") == want, name
    head = "<article><div class='entry-header'><h1>A head line</h1></div><p>" + "word " * 40 + "end</p></article>"
    assert extract(head) == extract(head.replace("entry-header", "header")) == want


def test_furniture_names_still_drop():
    story = "<p>" + "word " * 80 + "end</p>"
    for name in ("ad", "ad-slot", "sidebar-right", "site-footer", "widget-area", "comment-list", "share-buttons", "related-posts",
                 "newsletter-signup", "cookie-notice", "post-comments", "nav-links", "comments"):
        drop = f"<div class='{name}'><p>Some words that do not belong to the story at all</p></div>"
        assert extract(f"<body>{drop}<article>{story}{drop}</article>{drop}") == "word " * 80 + "end", name
    reply = "<article class='comment-body'><p>I like it a lot</p></article>"
    assert extract(f"<main>{story}<div id=comments>{reply}{reply}</div></main>") == "word " * 80 + "end"


def test_only_raw_elements_swallow_the_rest():
    body = "<article><p>One two three</p><p>Four five</p></article>"
    want = "One two three\nFour five"
    assert extract("<html><head><meta charset=utf-8><title>No</title><style>p{}</style><body>" + body) == want
    assert extract("<head><title>No</title><link href=x>" + body) == want
    for mark in ("<svg width=1 />", "<math/>", "<svg/><svg><text>no</text></svg>", "<button>Go", "<select><option>a<option>b",
                 "<object data=x>", "<canvas>", "<button>Go</button>", "<video><p>no video</p></video>", "<noscript><p>no</p></noscript>",
                 "<svg><path d=x><g>", "<template>"):
        page = f"<article><p>One two three</p>{mark}<p>Four five</p></article>"
        assert extract(page) == want, mark
        assert extract(page + "<div class=ad><button>x</button><svg><text>y</text></svg></div>") == want, mark
    assert extract("<article><p>One two three</p><script>never closed<p>Four five</p></article>") == "One two three"


def test_column_with_nulls_long_and_repeated_pages(spark):
    long = "<article>" + "<p>some words in a row</p>" * 20_000 + "</article>"
    rows = [(1, None), (1, ""), (2, "   "), (3, ARTICLE), (3, ARTICLE), (None, long)]
    df = spark.createDataFrame(rows, "page_id long, html string")
    got = [r[0] for r in df.select(main_text()).collect()]
    assert got[:3] == ["", "", ""] and got[3] == got[4] != ""
    assert got[5] == "\n".join(["some words in a row"] * 20_000)
    assert df.limit(0).select(main_text()).count() == 0


PAGES = "/root/testdata/sf0.001/pages.parquet"


class PlainBlocks(HTMLParser):
    """Blocks of well-formed pages by the parser of the standard library: everything but what stands in ``skipped``."""

    skipped = ("script", "style", "title", "nav", "footer", "aside", "form", "button", "select")

    def __init__(self, source: str) -> None:
        super().__init__(convert_charrefs=True)
        self.out, self.parts, self.depth, self.left_out = [], [], 0, []
        self.feed(source)
        self.close()
        self.end()

    def end(self):
        text = " ".join("".join(self.parts).split())
        self.out += [text] if text else []
        self.parts = []

    def handle_starttag(self, tag, attributes):
        if tag == "br":
            self.parts.append(" ")
        if tag not in html_text.INLINE:
            self.end()
        if tag in self.skipped or self.left_out and tag == self.left_out[-1] or "ad" in dict(attributes).get("class", "").split():
            self.left_out.append(tag)

    def handle_endtag(self, tag):
        if tag not in html_text.INLINE:
            self.end()
        if self.left_out and self.left_out[-1] == tag:
            self.left_out.pop()

    def handle_data(self, data):
        if not self.left_out:
            self.parts.append(data)


def without_names(page: str) -> str:
    """The page with neutral elements and no class, id or role."""
    page = re.sub(r"\s(?:class|id|role)\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]+)", "", page, flags=re.I)
    return re.sub(r"<(/?)(article|main|nav|header|footer|aside|form|section|menu)\b", r"<\1div", page, flags=re.I)


def test_blocks_equal_a_plain_parser():
    pages = pq.read_table(PAGES, columns=["html"])["html"].to_pylist()
    assert len(pages) >= 20
    for page in pages:
        assert [b.text for b in html_text.Page(page).blocks] == PlainBlocks(page).out
    page = "<div class=ad>x <p>y</p></div><p>a &lt;b&gt; &eacute;<br>c</p><ul><li>d<li>e <b>f</b>g</ul><nav>h</nav>i"
    assert [b.text for b in html_text.Page(page).blocks] == PlainBlocks(page).out == ["a <b> é c", "d", "e fg", "i"]


def test_the_tree_knows_no_markup_and_finds_the_text_of_pages_without_any():
    """Words are right if their block is kept or dropped as on the page with its article and names."""
    assert {"words", "links", "words_before", "links_before", "words_after", "links_after"} < set(html_text.FEATURES)
    assert len(html_text.LABELLED[0]) == len(html_text.FEATURES) + 1
    right = every = 0
    for page in pq.read_table(PAGES, columns=["html"])["html"].to_pylist():
        bare = without_names(page)
        want, got = (Counter(extract(p).split("\n")) for p in (page, bare))
        for text, n in Counter(b.text for b in html_text.Page(bare).blocks).items():
            every += n * len(text.split())
            right += (n - abs(min(n, want[text]) - min(n, got[text]))) * len(text.split())
    assert right >= 0.9 * every > 0


def test_other_columns_may_have_any_name(spark):
    rows = [(1, ARTICLE, "t", 5, -1.0), (2, None, "t", 6, None)]
    df = spark.createDataFrame(rows, "page_id long, html string, text string, n_chars int, place double")
    got = df.select("*", main_text().alias("main")).collect()
    assert [r.main for r in got] == [extract(ARTICLE), ""] and [r.text for r in got] == ["t", "t"]
