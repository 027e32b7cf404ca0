import html
import re

from coverloom.llm import html_text
from coverloom.llm.html_text import blocks_of, main_text

from conftest import TESTDATA


def test_article_stays_and_the_rest_goes():
    page = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
    <header><h1>Site</h1><a href=/>home</a></header><nav><ul><li><a href="/a">a</a></li><li><a href="/b">b</a></ul></nav>
    <div class="cookie-notice">We use cookies for everything you do here, and more than that.</div><!-- ad 1 --><div class="ad">Buy this now, it is cheap.</div>
    <article><header><h1>Title&nbsp;here</h1></header><p><b>First   par.<br><p>Second &lt;p&gt; &#233;
    line <a href="x">with link</a>.</p><div class="advert"><p>Inner advert text of some length, to be dropped.</p></div><ul><li>One</li><li>Two</li></ul>
    <form><label>Name</label><button>Send</button></form><aside>Read also: this other story of ours.</aside><p>End.</p></article>
    <section id="comments"><article class="comment"><p>I read this long article with much joy and left a comment that is quite long.</p></article></section>
    <footer>&copy; site</footer></body></html>"""
    assert main_text(page) == "Title here\nFirst par.\nSecond <p> é line with link .\nOne\nTwo\nEnd." or main_text(page).split("\n") == [
        "Title here", "First par.", "Second <p> é line with link.", "One", "Two", "End.",
    ]


def test_pages_without_article_marks():
    long = "This is a paragraph of plain text that goes on for a while and tells something to its readers today. " * 2
    links = "".join(f'<a href="/{k}">Link {k}</a> ' for k in range(9))
    page = f"<div>{links}</div><div><p>{long}</p><p>{long}</p></div><div>{links}</div>"
    assert main_text(page).split("\n") == [" ".join(long.split())] * 2


PARAGRAPHS = "<p>" + "A paragraph of plain text that tells something to its readers, at some length, for a while. " * 3 + "<p>" + "More of it, in other words. " * 9
WANTED = [" ".join(x.split()) for x in PARAGRAPHS.split("<p>")[1:]]


def test_links_and_notices_go_from_inside_an_article():
    for holder in ("main", "article"):
        menu = "<div><a href=/>Home</a> | <a href=/a>About</a> | <a href=/c>Contact</a></div>"
        related = "<ul><li><a href=/1>Another story of ours</a><li><a href=/2>One more story</a></ul>"
        notice = "<div>(c) 2024 All rights reserved. Subscribe to our newsletter now.</div>"
        for before, after in ((menu, ""), ("", related), ("", notice), (menu, related + notice)):
            assert main_text(f"<{holder}>{before}<h1>The title of it</h1>{PARAGRAPHS}{after}</{holder}>").split("\n") == ["The title of it", *WANTED]


def test_names_on_wrappers_do_not_empty_the_page():
    for wrapper in ("post promoted", "content search-page", "related post", "sidebar", "widget"):
        page = f'<nav><a href=/>home</a></nav><div class="{wrapper}"><article><h1>Title</h1>{PARAGRAPHS}</article></div><footer>imprint</footer>'
        assert main_text(page).split("\n") == ["Title", *WANTED], wrapper
    for name in ("comments", "comment-content", "post comments", "promoted", "search", "sidebar content"):
        page = f'<article><h1>Title</h1>{PARAGRAPHS}</article><div class="{name}">{PARAGRAPHS * 2}</div>'
        assert main_text(page).split("\n") == ["Title", *WANTED], name


def test_neighbours_decide_in_the_tree():
    def cuts(tree):
        return set() if isinstance(tree, int) else {html_text.FEATURES[tree[0]]} | cuts(tree[2]) | cuts(tree[3])

    tree = html_text.trained()
    used = cuts(tree)
    assert {"words", "density"} < used and len(used & {"words_before", "words_after", "density_before", "density_after"}) >= 2, used
    features, labels = html_text.labelled_blocks()
    right = [html_text.is_main(tree, f) == bool(k) for f, k in zip(features, labels, strict=True)]
    assert sum(right) > 0.97 * len(right) and 0.3 < sum(labels) / len(labels) < 0.8
    # Equal blocks outside any article, told apart by what stands next to them.
    between = html_text.features_of(blocks_of(f"<div>{PARAGRAPHS}</div><div>Four words of text</div><div>{PARAGRAPHS}</div>"))
    among = html_text.features_of(blocks_of("<div><a>One two three</a></div><div>Four words of text</div><div><a>One two three</a></div>"))
    assert between[2][:2] == among[1][:2] and html_text.is_main(tree, between[2]) and not html_text.is_main(tree, among[1])


def test_broken_and_empty_pages():
    assert main_text(None) == main_text("") == main_text("<nav>a</nav>") == main_text("<article><script>x") == ""
    assert main_text("<article><p>One</div></p></section>two<p>three") == "One\ntwo\nthree"
    assert main_text("<article>a < b and <b>c</b>d<!-- no -->e<br/>f</article>").replace("\n", " ") == "a < b and cde f"
    assert [b.linked for b in blocks_of("<p><a>x y</a> z</p><p>w</p>")] == [2, 0]


def test_unclosed_elements_do_not_cut_the_article():
    assert main_text("<head><title>x</title><body><article><p>One<p>Two</article>") == "One\nTwo"
    assert main_text("<head><title>x</title><meta a><script>'<p>'</script><article>One</article>") == "One"
    assert main_text("<html><head><title>x<article>One</article>") == "One"
    for name in ("noscript", "template", "svg", "math", "iframe", "object", "canvas"):
        assert main_text(f"<article><p>One<{name}>no<p>Two</p>") == "One\nTwo", name
        assert main_text(f"<article><p>One<{name} a=1>no<p>Two</p><{name}>no</{name}><p>Three") == "One\nTwo\nThree", name
        assert main_text(f"<article><p>One<{name}><p>no<{name}>no</{name}>no</{name}><p>Two") == "One\nTwo", name
    assert main_text("<article><p>One<select><option>no<option>no<p>Two") == "One\nTwo"
    assert main_text("<article><p>One<object><script>'<p>no'</script>no<p>Two") == "One\nTwo"
    assert main_text("<article><p>One<textarea><p>no") == main_text("<article><p>One<style><p>no") == main_text("<article><p>One<!--<p>no") == "One"
    assert main_text("<article>" + "<p>x<object>" * 20_000).count("\n") == 19_999


def test_very_long_page():
    page = "<article>" + "<p>some words in a row</p>" * 50_000 + "</article>"
    assert main_text(page).count("\n") == 49_999


def test_query_equals_the_article_markup(spark):
    given = spark.read.parquet(f"{TESTDATA}/pages.parquet")
    found = html_text.extract(given).collect()
    pages = {r.page_id: r.html for r in given.collect()}
    assert len(found) == len(pages)
    for r in found:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        parts = re.split(r"</?(?:p|h1|h2|ul|li)\b[^>]*>", article.replace("<br>", " "))
        clean = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts]
        assert r.text == "\n".join(c for c in clean if c) and r.n_chars == len(r.text)


def test_columns_by_any_name(spark):
    frame = spark.createDataFrame([(1, "u", "<article>x", "t"), (1, "u", None, None)], "c0 int, page string, body string, text string")
    found = html_text.extract(frame, "body", keep=("c0", "page"))
    assert sorted(map(tuple, found.collect())) == [(1, "u", "", 0), (1, "u", "x", 1)]
    assert html_text.extract(frame.limit(0), "body", keep=("c0",)).count() == 0
