import html
import random
import re
from itertools import product

from martlib.llm import mincut


def cost(labels, scores, links):
    return sum(-s if s < 0 and ok else s if s > 0 and not ok else 0 for s, ok in zip(scores, labels, strict=True)) + sum(w for i, j, w in links if labels[i] != labels[j])


def test_cut_is_the_minimum():
    rng = random.Random(1)
    for _ in range(400):
        n = rng.randint(1, 9)
        scores = [rng.choice([-3, -2, -1, -0.5, 0, 0.5, 1, 2, 3]) for _ in range(n)]
        links = [(rng.randrange(n), rng.randrange(n), rng.choice([0.1, 0.5, 1, 2])) for _ in range(rng.randint(0, 2 * n))]
        got = mincut.minimum_cut(scores, links)
        assert abs(cost(got, scores, links) - min(cost(x, scores, links) for x in product([True, False], repeat=n))) < 1e-6


HEAD = '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body class="has-sidebar comment-page">'
LONG = "This is a sentence of the article that has quite a number of words in it, so it is long."


def test_leaves_out_what_is_not_the_article():
    page = HEAD + f"""<header><a href="/">Site name of the page</a><p>{LONG}</p></header><nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav>
    <!-- a comment <p>hidden</p> --><div class="cookie-notice"><p>{LONG}</p></div><div id="wrap-with-sidebar"><article><header><h1>The &amp; title</h1></header><p>{LONG}</p>
    <p>Er.</p><div class="ad">Buy now. {LONG}</div><p>It is <b>bold</b>ly &lt;said&gt;&nbsp;&#233;.<br>New   line</p><aside><p>{LONG}</p></aside><form><label>Name</label><button>Send</button></form>
    <ul><li>One point of the text.</li><li>Two.</li></ul></article><div class="sidebar"><p>{LONG}</p></div></div>
    <div class="commentlist"><p>{LONG}</p></div><div id="rightSidebar"><p>{LONG}</p></div><div role="alert"><p>{LONG}</p></div><p class="notice">{LONG}</p>
    <section id="comments"><article class="comment"><p>{LONG}</p></article></section><footer>&copy; Site. {LONG}</footer></body></html>"""
    assert mincut.main_text(page) == f"The & title {LONG} Er. It is boldly <said> é. New line One point of the text. Two."


def test_other_layouts():
    body = f"<p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
    want = f"{LONG} Short. {LONG}"
    for a, b in (("<main>", "</main>"), ('<div class="entry-content">', "</div>"), ('<div id="content">', "</div>"), ("<div>", "</div>"), ("<table><tr><td>", "</td></tr></table>")):
        assert mincut.main_text(HEAD + '<div id="topNav"><a href=1>Home page</a> <a href=2>All news</a></div>' + a + body + b + '<div class="footer">About us</div></body>') == want, a


def test_names_are_weighed():
    nav, foot = '<div id="topNav"><a href=1>Home page</a> <a href=2>All news</a></div>', '<div class="footer">About us</div></body>'
    body, other = f"<h1>The title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p><p>{LONG}</p>", "Other words of nobody that fill a whole line, and then some more of them."
    want = f"The title {LONG} Short. {LONG} {LONG}"
    for start in ('class="content has-sidebar"', 'id="post-with-comments"', 'class="layout sidebar-right"', 'class="wrapper withSidebar"', 'class="content sidebar-left"', 'class="postWithComments"'):
        for after in ("", f'<div class="sidebar"><p>{other}</p></div>', f'<div id="comments"><p>{other}</p></div>'):
            assert mincut.main_text(f"{HEAD}{nav}<div {start}>{body}{after}</div>{foot}") == want, (start, after)
            assert mincut.main_text(f"{HEAD}{nav}<div {start}>{body}</div>{after}{foot}") == want, (start, after)
    for head in ("entry-header", "post-header", "article-head"):
        page = f'<article><div class="{head}"><h1>The title</h1></div><p>{LONG}</p><div class="post-comments"><p>{other}</p></div><div class="entry-footer"><a href=x>Politics</a></div></article>'
        assert mincut.main_text(f"{HEAD}{nav}{page}{foot}") == f"The title {LONG}", head


def test_broken_pages():
    assert mincut.main_text(None) == mincut.main_text("") == mincut.main_text("<") == mincut.main_text("<p></p>") == ""
    assert mincut.main_text(f"<article><p>{LONG}<p>Next &bogus; & <b>x<p>a < b") == f"{LONG} Next &bogus; & x a < b"
    assert mincut.main_text(f"<article><p>{LONG}</p></div></span></article></p><script>never closed <p>x</p>") == LONG
    assert mincut.main_text(f'<article><p title="a > b">{LONG}</p><p class="x>{LONG}</p></article>').startswith(LONG)
    assert mincut.main_text("<div>" * 3000 + f"<p>{LONG}") == LONG
    long = " ".join(f"<p>{LONG}</p>" for _ in range(5000))
    assert mincut.main_text(f"<article>{long}</article>") == " ".join([LONG] * 5000)
    assert mincut.main_text("<a '" * 20_000 + LONG) is not None


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = mincut.extract(pages).collect()
    assert len(rows) == pages.count()
    by = {r["page_id"]: r["text"] for r in rows}
    for r in pages.collect():
        inner = r["html"].split("<article>", 1)[-1].split("</article>", 1)[0].split("<footer>", 1)[0]
        want = " ".join(" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|article|br)[^>]*>", inner))
        assert by[r["page_id"]] == " ".join(want.split())


def test_rows_and_columns(spark):
    df = spark.createDataFrame([(1, None, "u", "x"), (1, f"<p>{LONG}", None, "y"), (None, f"<p>{LONG}", "u", None)], "page_id long, html string, url string, n_chars string")
    got = mincut.extract(df)
    assert got.columns == ["page_id", "url", "n_chars", "text"]
    assert [r["text"] for r in got.collect()] == ["", LONG, LONG]
    assert mincut.extract(df.limit(0)).count() == 0


def test_a_form_around_the_page_keeps_its_text():
    body = f"<h1>The title</h1><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p>"
    search = "<form class=find><input name=q><label>Search this site</label><button>Go</button></form>"
    login = f"<form action=/login><fieldset><legend>Your account</legend><p>Please enter your name and your password here.</p><p>Name</p></fieldset></form>"
    want = f"The title {LONG} {LONG} {LONG}"
    for page in (
        f"<form action=/x><div id=wrap>{body}</div></form>", f"<form id=aspnetForm><nav><a href=/>Home</a></nav><div>{body}</div><footer>Site. {LONG}</footer></form>",
        f"{search}<div>{body}</div>{login}", f"<div role=form><fieldset>{body}</fieldset></div>", f"<article>{body}{login}</article>", f"<main>{search}{body}</main>",
    ):
        assert mincut.main_text(f"<html><body>{page}</body></html>") == want, page
    assert mincut.main_text(f"<html><body>{search}</body></html>") == ""


def test_deep_pages_and_long_cuts_take_time_in_proportion():
    import time
    t = time.perf_counter()
    assert mincut.main_text("<div>" * 100_000 + f"<p>{LONG}</p><p>{LONG}</p>").count(LONG) == 2
    mincut.main_text("<div>" * 50_000 + "</section>" * 50_000 + "<li>x" * 20_000)
    assert time.perf_counter() - t < 8
    rng = random.Random(4)
    n = 20_000
    scores = [rng.uniform(-1, 1) for _ in range(n)]
    links = [(i, i + k, rng.uniform(0.3, 1.5)) for i in range(n) for k in (1, 2) if i + k < n]
    t = time.perf_counter()
    got = mincut.minimum_cut(scores, links)
    assert time.perf_counter() - t < 8
    # no single flip, and no flip of a run, is cheaper
    base = cost(got, scores, links)
    for _ in range(60):
        a = rng.randrange(n)
        b = min(n, a + rng.randint(1, 40))
        other = got[:a] + [not x for x in got[a:b]] + got[b:]
        assert cost(other, scores, links) >= base - 1e-6
