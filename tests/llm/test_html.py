import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import html_extract, html_text

FULL = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="page-7">
<header><h2>Site</h2></header><nav><ul><li><a href="/a">menu one</a></li></ul></nav><!-- note --><div class="cookie-notice">we use cookies</div>
<div class="layout"><div class="post-12 content"><h1>Head &amp; line</h1><p>First  <b>bo</b>ld &eacute;&#33; text,
with enough words to be the article of this page, said once more.<br>after break<div class="ad">buy now</div>
<p>Second<p>Third &lt;tag&gt; <a href="x">a link</a> 1 < 2<form><input value="x>y">subscribe</form><ul><li>one<li>two</ul>
<div id="comments"><p>what a long and boring comment by a reader, much longer than anything else that stands on this page at all</p></div>
</div><aside>see also</aside></div><footer>&copy; foot</footer></body></html>"""
MAIN = (
    "Head & line First bold é! text, with enough words to be the article of this page, said once more. after break "
    "Second Third <tag> a link 1 < 2 one two"
)


def test_the_article_without_the_rest():
    page = html_text.read(FULL)
    assert html_text.text_under(page, "/html/body.page-0/div.layout/div.content.post-0") == MAIN


@pytest.mark.parametrize(
    "raw", ["", "<", "<p", "<p>a<b", "&", "</p>x", "<!-- x", "<script>x", '<p class="a>b</p>', "<a " * 5000, "<p>" * 3000, "a" * 50_000, "<div>" * 2000 + "x"]
)
def test_broken_pages_do_not_fail(raw):
    html_text.text_under(html_text.read(raw), None)


def site(host, number, body):
    return [(f"https://{host}/{i}", body.replace("#", str(i))) for i in range(number)]


def test_a_host_agrees_on_a_path(spark):
    article = '<html><body><div id="x"><div class="story-#"><p>' + "real text of the page " * 20 + "#</p></div><div class=\"tail\"><p>end</p></div></div></body></html>"
    odd = article.replace("real text of the page ", "r ").replace("end", "a very long tail of the page that is longer " * 10)
    pages = site("a.org", 12, article) + [("http://www.a.org/odd", odd)]
    pages += [("http://b.org/1", "<html><body><p>only body</p></body></html>"), (None, "<p>no url</p>"), ("http://c.org", None), ("x", "")]
    table = spark.createDataFrame([(i, u, h, "old") for i, (u, h) in enumerate(pages)], "page_id long, url string, html string, text string")
    rows = {r.url: r.text for r in html_extract.extract(table).collect()}
    assert rows["https://a.org/3"] == ("real text of the page " * 20 + "3")
    assert rows["http://www.a.org/odd"].startswith("r r")  # its own best container would be the tail
    assert rows["http://b.org/1"] == "only body" and rows[None] == "no url"
    assert rows["http://c.org"] == "" and rows["x"] == ""
    assert html_extract.extract(table.limit(0)).isEmpty()
    assert html_extract.extract(table.unionAll(table)).count() == 2 * table.count()


def test_hosts(spark):
    urls = ["HTTP://www.A.org:80/x?y#z", "//u:p@b.org", "https://c.org#d", "nothing", None]
    got = spark.createDataFrame([(u,) for u in urls], "u string").select(html_extract.host_of(F.col("u")))
    assert [r[0] for r in got.collect()] == ["a.org", "b.org", "c.org", "", ""]


ARTICLE = "the text of the article of this page, said in so many words. " * 8


@pytest.mark.parametrize("quote", ["'", '"'])
def test_long_attribute_values_are_no_text(quote):
    inner = {"'": '"', '"': "'"}[quote]
    value = f"data:image/svg+xml,<svg><path d={inner}M0{inner}/></svg></div></article><p>foreign text " + "<i>x</i> = {} " * 1500
    page = f"<html><body><article><p data-more={quote}{value}{quote} id=a>{ARTICLE}</p><img src = {quote}{value}{quote}><p>tail</article><p>after</body></html>"
    assert html_text.text_under(html_text.read(page), "/html/body/article") == f"{ARTICLE.strip()} tail"
    assert "foreign" not in " ".join(text for text, _, _ in html_text.read(page).blocks)


@pytest.mark.parametrize("tag", ["<p class=x\">", "<p it's>", "<p \"a' b>", "<p title=a?b=\"c>", "<p class=\"open>", "<p a = \"x>y\" b='>'>", "<p a==\"b>"])
def test_a_quote_is_stray_by_its_place(tag):
    page = html_text.read(f"<body>{tag}one</p><p>two</p></body>")
    assert [text for text, _, _ in page.blocks] == ["one", "two"]


def test_many_quoted_ends_take_linear_time():
    page = "<p a=\"" + ">" * 200_000 + "\">x" + "<b c='>'>" * 20_000
    assert html_text.text_under(html_text.read(page), None) == "x"


@pytest.mark.parametrize("levels, classes", [(13, 15), (700, 1)])
def test_long_paths_vote(spark, levels, classes):
    utility = " ".join(f"md:w-{'x' * n}/2" for n in range(classes))
    opened = "".join(f'<div class="{utility} l{"abcdefghijklmnopqrstuvwxyz"[k % 26]}">' for k in range(levels))
    teaser = '<div class="box"><p>' + "teaser text of another page " * 20 + "</p></div>"
    article = f'<div class="prose {utility}"><p>' + "real text of the page " * 40 + "#</p></div>"
    page = f"<html><body>{opened}{article}{teaser}{'</div>' * levels}</body></html>"
    short = page.replace("real text of the page ", "")  # its own best container is the teaser
    pages = site("a.org", 10, page) + [("http://a.org/short", short)]
    table = spark.createDataFrame([(i, u, h, "") for i, (u, h) in enumerate(pages)], "page_id long, url string, html string, text string")
    rows = {r.url: r.text for r in html_extract.extract(table).collect()}
    assert rows["https://a.org/3"] == "real text of the page " * 40 + "3"
    assert rows["http://a.org/short"] == "#"


def test_keys_have_one_size_and_tell_paths_apart():
    page = html_text.read("<div class='a/b'><div><div>x" + "</div>" * 3 + "<div class='a'><div class='b'>y")
    keys = [key for key, _ in page.containers]
    assert {len(key) for key in keys} == {32} and len(set(keys)) == len(keys)
    assert html_text.text_under(page, "/div.a/b/div/div") == "x" and html_text.depths(page) == [0, 1, 2, 3, 1, 2]


def main_text(body):
    return html_text.text_at(html_text.read(f"<html><body>{body}</body></html>"), None)


SHORT = "A first sentence that leads in."
LONG = "said once more and at some length by the one who is quoted here. " * 12


@pytest.mark.parametrize("name", ["form-group", "header", "notice", "related", "social", "banner", "toolbar", "search-results"])
def test_most_of_a_page_is_content_whatever_its_name(name):
    assert main_text(f'<nav>menu</nav><div class="{name}"><p>{ARTICLE}</p></div>') == ARTICLE.strip()
    assert main_text(f'<div class="post"><p>{ARTICLE}</p><div class="{name}"><p>short</p></div></div>') == ARTICLE.strip()


@pytest.mark.parametrize(
    "name",
    ["ad-container", "comment-body", "sidebar-content", "cookie-text", "footer-wrapper", "advert-body", "promo-story", "adContent"],
)
def test_what_is_no_content_by_its_name(name):
    assert main_text(f'<div class="post"><p>{ARTICLE}</p><div class="{name}"><p>{LONG * 3}</p></div></div>') == ARTICLE.strip()
    assert main_text(f'<div class="post has-{name}"><p>{ARTICLE}</p></div>') == ARTICLE.strip()


def test_names_of_wrappers():
    around = f'<div class="content-sidebar-wrap"><article class="post no-sidebar comment-open"><p>{ARTICLE}</p></article>'
    assert main_text(around + '<div class="sidebar">side</div></div>') == ARTICLE.strip()
    comment = f'<article class="comment"><h1>x</h1><p>{LONG}</p></article>'
    assert main_text(f'<article><p>{ARTICLE}</p></article><div class="comments">{comment * 9}</div>') == ARTICLE.strip()


def test_forms():
    page = f'<form id="aspnetForm"><input type="hidden"><div class="page"><p>{ARTICLE}</p></div></form>'
    assert main_text(page) == ARTICLE.strip()
    mail = "<form><label>Your address</label><input><p>We write once a week.</p></form>"
    assert main_text(f'<div class="page"><p>{ARTICLE}</p>{mail}</div>') == ARTICLE.strip()
    assert main_text(mail) == ""


def test_a_text_is_read_whole():
    long, short = LONG.strip(), ARTICLE.strip()
    assert main_text(f'<div class="s"><p>{SHORT}</p><blockquote><p>{LONG}</p></blockquote><p>end</p></div>') == f"{SHORT} {long} end"
    assert main_text(f'<div class="s"><section class="a">{LONG}</section><section class="b">{ARTICLE}</section></div>') == f"{long} {short}"
    assert main_text(f'<div class="s"><p>{ARTICLE}</p><div class="more">{LONG}</div></div>') == f"{short} {long}"
    head = "<header><h1>Head</h1><p>The standfirst.</p><div>share this</div></header>"
    assert main_text(f"<article>{head}<p>{ARTICLE}</p></article><footer>f</footer>") == f"Head The standfirst. {short}"
    assert main_text(f"<article><details><summary>more</summary><p>{LONG}</p></details><p>{ARTICLE}</p></article>") == f"more {long} {short}"


@pytest.mark.parametrize("empty", ["<!-->", "<!--->", "<!---->"])
def test_empty_comments(empty):
    assert main_text(f"<p>one{empty}</p><p>two</p><!-- > no --><p>three") == "one two three"


@pytest.mark.parametrize(
    "page",
    ["<div>" * 100_000 + "x", "<i>" * 100_000 + "x", "<i>" * 50_000 + "<p>x" * 50_000, "<b>" * 50_000 + "x</q>" * 50_000,
     "<form>" * 50_000 + "x", "<div class=menu>" * 50_000 + "x", "<li>" * 50_000 + "<p>x" * 50_000, "<div><p>x" * 50_000 + "</div>" * 50_000],
)
def test_deep_pages_take_linear_time(page):
    began = time.process_time()
    html_text.text_at(html_text.read(page), None)
    assert time.process_time() - began < 20  # a quadratic reader takes many minutes


class Plain(HTMLParser):
    """Another reader: what stands in article elements, by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.inside, self.parts = False, []

    def handle_starttag(self, tag, attrs):
        self.inside = self.inside or tag == "article"
        self.handle_data(" " if tag in html_text.BLOCKS else "")

    def handle_endtag(self, tag):
        self.inside = self.inside and tag != "article"
        self.handle_data(" " if tag in html_text.BLOCKS else "")

    def handle_data(self, data):
        if self.inside:
            self.parts.append(data)


def test_against_another_reader(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {(r.page_id, r.url): r.text for r in html_extract.extract(pages).collect()}
    for row in pages.collect():
        plain = Plain()
        plain.feed(row.html or "")
        plain.close()
        assert got[row.page_id, row.url] == " ".join("".join(plain.parts).split())
