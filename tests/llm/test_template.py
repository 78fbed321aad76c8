from __future__ import annotations

import html
import re

from plumbline.llm.template import extract_main_text, main_text

BODY = (
    '<!DOCTYPE html><html><head><title>T&amp;</title><style>p{{}}</style><script>var t="</p>";</script></head><body>'
    '<nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- x --><div class="ad">Buy this.</div>{main}'
    '<div id="comments"><p>First!</p></div><aside>Side</aside><footer>&copy; me</footer></body></html>'
)


def rows(spark, pages):
    return spark.createDataFrame([(i, u, h, "x") for i, (u, h) in enumerate(pages)], "page_id long, url string, html string, host string")


def texts(spark, pages):
    got = extract_main_text(rows(spark, pages)).collect()
    assert all(r.n_chars == len(r.text) for r in got)
    return {r.page_id: r.text for r in got}


def test_article(spark):
    page = lambda i: BODY.format(main=f"<article><h1>Title {i} &lt;</h1><p><b>One\n two<br><p>  th<i>r</i>ee &quot;</p>Buy this.</article>")
    pages = [(f"http://a.b/{i}", page(i)) for i in range(4)]
    pages += [("http://a.b/cut", page(9).split("</article>")[0]), ("http://a.b/0", page(0)), ("http://a.b/n", None), ("http://a.b/e", ""), (None, page(5))]
    got = texts(spark, pages)
    want = {i: f'Title {i} < One two three " Buy this.' for i in range(4)}
    assert got == want | {4: want[0].replace("0", "9"), 5: want[0], 6: "", 7: "", 8: want[0].replace("0", "5")}


def test_host_without_article(spark):
    page = lambda i: BODY.format(main=f"<div class='wrap'><div class='top'>Our site</div><div class='story'><p>Story {i * 7919}</p><p>More {i}</p></div></div>")
    got = texts(spark, [(f"http://c.d/{i}", page(i)) for i in range(30)])
    assert got == {i: f"Story {i * 7919} More {i}" for i in range(30)}


def test_equivalence_classes_say_where_rare_content_stands(spark):
    rare = lambda i, name: f"<blockquote class='{name}{i}'>Seldom {name} {i}</blockquote>" if i in (3, 4) else ""
    page = lambda i: BODY.format(main=(
        f"<div class='wrap'>{rare(i, 'out')}<div class='top'>Our site</div><div class='story'><p>Story {i * 7919}</p>{rare(i, 'in')}<p>More {i}</p></div></div>"
    ))
    got = texts(spark, [(f"http://c.d/{i}", page(i)) for i in range(30)])
    assert got == {i: f"Story {i * 7919} " + (f"Seldom in {i} " if i in (3, 4) else "") + f"More {i}" for i in range(30)}


def test_single_page_host_and_plain_text(spark):
    got = texts(spark, [("http://e.f/", BODY.format(main="<p>Alone</p>")), ("http://g.h/", "just text"), ("::bad", "<p>a<p>b")])
    assert got == {0: "Alone", 1: "just text", 2: "a b"}


def test_broken_markup():
    assert main_text("<article><p>a <b>b</article><footer>x", set()) == "a b"
    assert main_text("a < b <3 <p class='x>y", set()) == "a < b <3 <p class='x>y"
    assert main_text("<script>if (a<b) '</p>'", set()) == ""
    assert main_text("<p>x</p><!-- never closed <p>y", set()) == "x"


def test_no_pages(spark):
    assert texts(spark, []) == {}


def test_shared_pages_equal_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in extract_main_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", article)]
        assert got[r.page_id] == " ".join(b for b in blocks if b)
