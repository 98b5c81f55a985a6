import re

from conftest import SF

from eventcanon.llm import html_text

SCHEMA = "page_id bigint, url string, html string"
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body class="has-sidebar">
<nav><ul><li><a href="/x">menu</a></li></ul></nav><div class="ad">advert</div><div id="cookieNotice">cookies</div>
<div class="post post-%d"><h1>Title &amp; more</h1><p>First   <b>bold</b>&nbsp;text<br>next<p>Second &lt;p&gt; &eacute;<ul><li>one<li>two</ul><!-- <p>hidden</p> -->
<aside>side</aside><form>form <input><select><option>a<option>b</select></form></div>
<div class="comments"><p>A reader's very long comment that is longer than the article itself, by far, so that it would win by its length alone. %s</p></div>
<footer>&copy; foot</footer></body></html>"""
TEXT = "Title & more\nFirst bold text next\nSecond <p> é\none\ntwo"


def test_rules(spark):
    pages = [(1, "https://h.example/1", PAGE % (1, "x" * 500)), (2, "https://H.example:80/2?a", PAGE % (22, "y")), (3, None, None), (4, "https://h.example/4", ""), (5, "no url", "just text & <i>more</i>"),
             (5, "no url", "just text & <i>more</i>"), (6, "https://h.example/6", "<body><main><p>Other shape</main>"), (None, "https://deep.example/", "<div>" * 30_000 + "deep" + "</div>" * 30_000),
             (8, "https://long.example/", "<article>" + "<p>word</p>" * 20_000 + "</article>"), (9, "https://b.example/", "<p>a < b <p title='>'>c</p")]
    df = spark.createDataFrame(pages, SCHEMA).selectExpr("*", "1 AS path", "2 AS host", "3 AS text")
    out = {r.page_id: r for r in html_text.extract(df).collect()}
    assert out[1].text == out[2].text == TEXT and out[1].n_chars == len(TEXT) and out[1].path.endswith("div.post.post-")
    assert [out[i].text for i in (3, 4)] == ["", ""] and out[3].url is None
    assert out[5].text == "just text & more" and out[6].text == "Other shape" and out[None].text == "deep"
    assert out[8].text.count("\n") == 19_999 and out[9].text.startswith("a < b")
    assert html_text.extract(df).count() == len(pages) and html_text.extract(df.limit(0)).count() == 0


def test_hosts_vote(spark):
    usual = "<body><div class='story'><p>" + "Good words here. " * 20 + "</p></div><div class='box'><p>short</p></div></body>"
    odd = "<body><div class='story'><p>Brief.</p></div><div class='box'><p>" + "Much longer boxed words. " * 20 + "</p></div></body>"
    pages = [(i, "http://v.example/", usual) for i in range(5)] + [(9, "http://v.example/", odd), (10, "http://w.example/", odd)]
    out = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert out[9] == "Brief." and out[10].startswith("Much longer")


def test_given_pages(spark):
    """On the given pages the main text is the article; a plain reading of that element gives the same."""
    import html

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", body)
        said = [" ".join(html.unescape(re.sub(r"</?b>", "", p).replace("<br>", " ")).split()) for p in parts]
        want[r.page_id] = "\n".join(s for s in said if s)
    assert {r.page_id: r.text for r in html_text.extract(pages).collect()} == want


LONG = "Prose of the article. " * 10
SAID = LONG.strip()
CELLS = "cell " * 80
FORMS = [
    (f"<article><h1>T</h1><p>lead</p><div class=body><p>{LONG}</p></div></article>", f"T\nlead\n{SAID}"),
    (f"<section class='intro'><p>Intro text here.</p></section><section class='story'><p>{LONG}</p></section>", f"Intro text here.\n{SAID}"),
    (f"<article><p>{LONG}</p><table><tr><td>{CELLS}</td><td>x</td></tr></table></article>", f"{SAID}\n{CELLS.strip()}\nx"),
    (f"<p>{LONG}</p><table><tr><td>{CELLS}</td></tr></table>", f"{SAID}\n{CELLS.strip()}"),
    (f"<div class='layout has-sidebar'><article><p>{LONG}</p></article><div class=sidebar>side</div></div>", SAID),
    (f"<div class='sidebar layout'><article><p>{LONG}</p></article></div>", SAID),
    (f"<div id='page' class='with-header'><div class='post'><p>{LONG}</p></div></div>", SAID),
    (f"<section class='no-comments'><p>{LONG}</p></section>", SAID),
    (f"<div class='search-result'><p>{LONG}</p></div><div class='related-work'>Short.</div>", SAID),
    (f"<div class='form'><p>{LONG}</p></div><div class='sidebar-left'>left side</div>", SAID),
    (f"<div class=post><p>{LONG}</p></div><div class=comments><article class=comment><p>{LONG * 3}</p></article></div>", SAID),
    (f"<div class=wrap><div class=story><p>{LONG}</p></div><ul class=menu><li><a href=x>menu</a></ul><div><a href=1>one</a> <a href=2>two</a></div></div>", SAID),
    (f"<div class=ad-slot>buy</div><div class=cookieBanner>cookies</div><main><p>{LONG}</p><div class='share-buttons'>share</div></main>", f"{SAID}"),
]


def test_usual_forms():
    from eventcanon.llm.html_text import Page

    for source, want in FORMS[:-1]:
        page = Page(f"<html><body>{source}</body></html>")
        assert page.text(page.best()) == want, source
    page = Page(FORMS[-1][0])
    assert page.text(page.best()).startswith(SAID) and "buy" not in page.text(page.best()) and "cookies" not in page.text(page.best())


def test_names_of_what_is_no_main_text():
    from eventcanon.llm.html_text import mark_of

    assert [mark_of(n) for n in ("sidebar", "page-sidebar", "sidebar-left", "ad-slot", "cookieNotice", "footer_links", "comment-list", "comments")] == [2, 2, 2, 2, 1, 2, 3, 3]
    assert not any(map(mark_of, ("has-sidebar", "with-header", "no-comments", "search-result", "related-work", "content", "left", "", "42", "padding", "main-content")))


def test_time_is_linear_in_what_is_left_open():
    import time

    from eventcanon.llm.html_text import Page

    for part in ("<div ", "<div \"", "<a '<b \"", "<!", "</script ", "<script></script ", "<div>", "</p>", "<li>", "<span><li>", "<a href=\"x>", "<!--", "<p class=\"", "<?"):
        start = time.perf_counter()
        Page(part * 20_000)
        assert time.perf_counter() - start < 10, part
    assert Page("<p>a <b class=x>b</b> c").text("html") == "a b c"


def test_many_hosts_are_joined_over_salted_keys(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://h{i % 3}.example/{i}", PAGE % (i, "y")) for i in range(12)], SCHEMA)
    want = sorted(map(tuple, html_text.extract(pages).collect()))
    monkeypatch.setattr(html_text, "WINNER_BYTES", 0)
    assert sorted(map(tuple, html_text.extract(pages).collect())) == want
