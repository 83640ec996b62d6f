import html
import re

import duckdb

from tidemark.llm.extract import extract, learn_weights, main_text, sequence, weights_of

WEIGHTS = weights_of({})
SCHEMA = "page_id long, url string, html string, text string, n_chars int"


def brute_region(values):
    sums = [(sum(values[i:j]), -i, -j) for i in range(len(values)) for j in range(i + 1, len(values) + 1)]
    return max(sums, default=(0, 0, 0))[0]


def test_article_of_the_tables(spark):
    folder = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    got = {r.page_id: r.text for r in extract(pages).collect()}
    rows = duckdb.sql(f"SELECT page_id, html FROM '{folder}/pages.parquet'").fetchall()
    assert len(got) == len(rows)
    for page_id, page in rows:
        inner = re.search("<article>(.*)</article>", page, re.S)[1]
        blocks = re.split(r"<(?:/?p|/?h1)>", inner)
        lines = [" ".join(html.unescape(re.sub("<[^>]*>", lambda m: " " if m[0] == "<br>" else "", b)).split()) for b in blocks]
        assert got[page_id] == "\n\n".join(x for x in lines if x)


def test_unwanted_parts():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
    <header><h1>Site</h1></header><nav><ul><li><a href="x">Menu one two three</a></li></ul></nav>
    <div id="cookie-notice">We use cookies on this page to serve you</div>
    <div class="content"><header><h2>Head</h2></header><p>First&nbsp;block  of&amp;amp; <b>b</b>old<br>line
    <p>Second 1 &lt; 2 <script>var a = "</p>";</script>end</p><!-- no > comment -->
    <div class='ad-slot'><div>Buy</div> now</div><table><tr><td>a</td><td>b</td></tr></table>
    <form><input name="q"><label>Mail</label></form><p>Third long block with a number of words in it</p></div>
    <section class="commentList"><p>A reader says a lot of words here that are not the article</p></section>
    <aside><p>Side bar words</p></aside><footer>&copy; all rights</footer></body></html>"""
    assert main_text(page, WEIGHTS) == (
        "First block of&amp; bold line\n\nSecond 1 < 2 end\n\na b\n\nThird long block with a number of words in it"
    )
    main = "<main><header><h2>Head</h2></header><p>One</p><aside>x</aside><p>Two</p><div class=ad>y</main><p>z"
    assert main_text(main, WEIGHTS) == "Head\n\nOne\n\nTwo\n\nz"


def test_marks_around_and_inside_the_article():
    page = """<body><div class="page with-sidebar"><div id="menu">m</div><article class="post comments-open"><p>One two three</p>
    <section id="c"><article class="comment"><p>Reader words</p></article></section><p>Four five</p></article>
    <div class="comments"><article><p>More reader words than the whole article has in its text</p></article></div>
    <article class="related"><p>Other story</p></article></div></body>"""
    assert main_text(page, WEIGHTS) == "One two three\n\nFour five"


def test_scan_is_the_best_region():
    import random

    random.seed(1)
    for _ in range(200):
        page = "".join(random.choice(["w ", "<p>", "<li>", "</b>", "w w w ", "<a>"]) for _ in range(12))
        weights = {"word": 1.0, "link word": 0.5, "p": -1.5, "li": -3.0, "b": -0.7, "a": -1.0}
        values, links = [], 0
        for name, value, _ in sequence(page):
            if name == "a":
                links += 1
            values.append(weights[name] if name else weights["link word" if links else "word"] * len(value.split()))
        text, links, best = main_text(page, weights), 0, brute_region(values)
        assert (best > 0) == bool(text)


def test_odd_pages(spark):
    big = "<article>" + "<p>word one &amp; two</p>" * 30_000 + "</article>"
    odd = ["", None, "<", "plain words", "<p", "<p><b>open <a href='x", "<script>x", "<!-- open", "<a \"" * 2000, "<div class=ad>only"]
    rows = [(i, None, page, "x", 1) for i, page in enumerate(odd)] + [(None, "u", big, None, None)] * 2
    pages = spark.createDataFrame(rows, SCHEMA)
    got = {r.page_id: r for r in extract(pages).collect()}
    assert [got[i].text for i in range(4)] == ["", "", "<", "plain words"]
    assert got[5].text.startswith("open") and got[6].text == got[7].text == got[9].text == ""
    assert got[None].text.split("\n\n") == ["word one & two"] * 30_000 and got[None].n_chars == len(got[None].text)
    assert extract(pages).count() == len(rows)
    assert extract(pages.limit(0)).count() == 0
    assert learn_weights(pages.limit(0)) == WEIGHTS
