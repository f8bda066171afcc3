import html
import re
import time

from pyspark.sql import functions as F

from ticksmith.llm import htmltext
from ticksmith.llm.queries import op7_html_text

TREE = htmltext.grow(htmltext.LABELLED)
LONG = "these are the many words of a paragraph that goes on and on for quite a while so that nobody takes it for a label"


def text(page):
    return htmltext.main_text(page, TREE)


def test_tree_fits_its_table():
    assert all(htmltext.decide(TREE, x) == y for x, y in htmltext.LABELLED)


def test_furniture_goes_and_main_text_stays():
    page = f"""<html><head><title>T</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href=x>Menu one</a></ul></nav>
      <div class="cookie-notice">We use cookies {LONG}</div><main><article><header><h1>Head &amp; line</h1></header><p>{LONG}<p>Short.
      <div class="ad">Buy {LONG}</div><p>a&nbsp;<b>b</b>c<br>d &lt;x&gt;</p><script>var x = "</p>";</script><form><label>Name</label><input></form></article>
      <section id="comments"><article><p>{LONG}</p></article></section></main><aside>{LONG}</aside><footer>&copy; {LONG}</footer></body></html>"""
    assert text(page) == "\n\n".join(["Head & line", LONG, "Short.", "a bc d <x>"])


def test_pages_without_an_article():
    page = f"<body><ul><li><a>Home</a><li><a>News</a></ul><h1>A heading</h1><div>{LONG}</div><div>{LONG}</div><div class=sidebar>{LONG}</div><div>© 2020</div>"
    assert text(page) == "\n\n".join(["A heading", LONG, LONG])


def test_broken_markup():
    assert text(None) == text("") == text("<p") == text("<!-- <article>x") == ""
    assert text(f"<nav><a>x</a><article><p>{LONG}</div></p><script>never closed") == LONG
    assert text(f"<article><p title='a>b'>{LONG} < 3") == LONG + " < 3"
    assert len(text("<article>" + "<p>word " * 200000)) == 200000 * 6 - 2
    assert text("<div " * 100000) == "" and text("<a href=\"" * 50000) == ""


def test_extra_columns_and_empty(spark):
    pages = spark.createDataFrame([(1, f"<article>{LONG}", "t"), (None, None, "u")], "page_id long, html string, text string")
    got = pages.withColumn("out", htmltext.extract(F.col("html"))).collect()
    assert [r.out for r in got] == [LONG, ""]
    assert pages.limit(0).select(htmltext.extract(F.col("html"))).count() == 0


def test_query_gives_the_article(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in op7_html_text(spark, sf).collect():
        inner = re.search(r"(?s)<article>(.*?)</article>", pages[r.page_id]).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?(?:b|i|em|a|span)\b[^>]*>", "", b))).split()) for b in re.split(r"</?(?:p|h\d|div|ul|li)\b[^>]*>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


PARA = [f"paragraph {k} " + LONG for k in range(3)]
BODY = "".join(f"<p>{p}</p>" for p in PARA)
WANT = "\n\n".join(PARA)
FOOT = f"<footer>{LONG}</footer>"


def test_shapes_of_pages_keep_their_article():
    shapes = [
        f'<div class="content has-sidebar">{BODY}</div>', f'<div class="page-header-fixed">{BODY}</div>', f'<article class="post no-sidebar">{BODY}</article>',
        f"<form action=x>{BODY}</form>", f"<form><div id=wrap><article>{BODY}</article></div></form>", f"<nav><a>Menu</a><button>Open</nav>{BODY}",
        f"<button>Open<div>{BODY}</div>", f'<section id="related-work">{BODY}</section>',
        f'<div class="nav-open js-menu-ready">{BODY}</div>', f'<div id="search-and-read">{BODY}</div>', f'<div class="header-image-post">{BODY}</div>',
        f'<div class="widgets">{BODY}</div>', f'<div class="form">{BODY}</div>{FOOT}', f"<main><div class='with-comments'>{BODY}</div></main>",
        f'<table class="layout"><tr><td class="sidebar"><a>One</a> <a>Two</a></td><td>{BODY}</td></tr></table>',
        f'<div class="sidebar">Short note</div>{BODY}', f'{BODY}<div class="comments-area">{LONG}</div>', f'<div class="siteFooter">{LONG}</div>{BODY}',
        f'<div class="cookie-notice">{LONG}</div>{BODY}', f'{BODY}<div class="main-nav">{LONG}</div>', f'<aside>{LONG}</aside>{BODY}',
        f'<article>{BODY}</article><div id="comments">{LONG * 20}</div>', f'<article>{BODY}<div class="share-box">Share {LONG}</div></article>',
        f'{BODY}<div class="ad-box">{LONG}</div>', f'{BODY}<p class="disclaimer">{LONG}</p>', f'<div class="top-banner">{LONG}</div><article>{BODY}</article>',
        f'<header>{LONG}</header><article>{BODY}</article>', f'<article>{BODY}</article><section class="related-items">{LONG}</section>',
        f'<div class="breadcrumbs">{LONG}</div><main>{BODY}</main>', f'<div role="complementary">{LONG}</div><article>{BODY}</article>',
    ]
    for page in shapes:
        for whole in (page, f"<html><body>{page}</body></html>"):
            assert text(whole) == WANT, page


def test_a_teaser_in_an_article_is_not_the_page():
    assert text(f"<article>Teaser one</article><div>{BODY}</div>").endswith(WANT)


def test_headings_with_names_and_paragraphs_with_fields_stay():
    assert text(f'<article><h2 id="search">Search trees</h2>{BODY}</article>') == "Search trees\n\n" + WANT
    assert text(f"<article>{BODY}<p>Type <input name=x> here {LONG}</p></article>") == WANT + f"\n\nType here {LONG}"


def test_unmatched_tags_take_linear_time():
    began = time.process_time()
    n = 200_000
    assert text("<div>" * n + "</section>" * n + f"<p>{LONG}</p>") == LONG
    assert text("<div class=nav>" * n + "</div>" * n + f"<article>{BODY}</article>") == WANT
    text("<header>" * n + "<article>" * n)
    text("<div>x<section class=menu>" * n)
    assert time.process_time() - began < 40
