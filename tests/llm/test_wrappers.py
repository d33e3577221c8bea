"""Article extraction and wrapper inference."""

import random

from lexmill.llm.html_blocks import page_blocks
from lexmill.llm.wrappers import Extractor, Wrapper, align, extract_articles, page_wrapper

PAGE = """<!DOCTYPE html><html lang="en"><head><title>T &amp; x</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li></ul></nav><!-- ad <p>no</p> -->
<div class="cookie-notice">We use cookies</div><div id="ad_1">Buy</div>{body}<div class="sidebar">Side</div>
<section class="reader-comments"><article><p>First!</p></article></section><form><p>Mail</p><input></form>
<footer>&copy; x</footer></body></html>"""


def plain(html):
    blocks = page_blocks(html)
    return Extractor(page_wrapper(blocks)).text(blocks)


def test_article_blocks():
    body = '<article><h1>Head&amp;line</h1><p><b>One  two.<br><p>Three&nbsp;four &#x41;</p>\n<ul><li>x<li>y <i>z</i></ul><aside>no</aside>'
    body += '<div class="share">tweet</div><script>if (a < b) "<p>"</script><p>five<br>six</p></article>'
    assert plain(PAGE.format(body=body)) == "Head&line\nOne two.\nThree four A\nx\ny z\nfive six"


def test_page_without_article_and_odd_pages():
    assert plain("<p>a<p>b") == "a\nb"
    assert plain(None) == plain("") == plain("<nav>x</nav>") == plain("<script>x") == ""
    assert plain("just text &lt;b&gt; < 5") == "just text <b> < 5"
    assert plain("<div><p>real text</p><p><a href=x>only a link</a></p></div>") == "real text"
    assert plain('<main class="sidebar"><p hidden>x</p><p>y</p></main>') == "y"
    assert plain("<p " + "a " * 20_000 + "'") != 1 and plain("<div>" * 5_000 + "deep" + "</div>" * 5_000) == "deep"
    assert plain("<p>" + "<a " * 200_000).startswith("<a <a") and plain("<p " + "a" * 300_000 + "><i " + "b" * 300_000 + ">x") == "x"
    assert plain("<article>" + "<p>w</p>" * 30_000 + "</article>").count("\n") == 29_999


def test_alignment_finds_optional_repeated_and_slots():
    a = page_wrapper(page_blocks("<h1>A</h1><p>x</p><p>y</p><div class=note>same</div>"))
    b = page_wrapper(page_blocks("<h1>B</h1><p>z</p><ul><li>1</ul><div class=note>same</div>"))
    w = align(a, b)
    assert [(i.key, i.optional, i.repeated, i.constant is None) for i in w.items] == [
        ("-/h1", False, False, True), ("-/p", False, True, True), ("-/ul/li", True, False, False), ("-/div.note", False, False, False)]
    assert w.pages == 2 and Wrapper.from_json(w.to_json()) == w
    pairs = page_wrapper(page_blocks("<dl><dt>a<dd>b<dt>c<dd>d</dl>"))
    assert [(i.key, i.repeated) for i in pairs.items] == [("(-/dl/dt -/dl/dd)", True)]


def test_template_of_a_host_is_dropped_but_copies_are_kept(spark):
    r = random.Random(1)
    rows = []
    for i in range(12):
        text = " ".join(r.choices(["red", "green", "blue", "sky"], k=9))
        extra = "<div class=x>sometimes</div>" if i % 3 == 0 else ""
        rows.append((i, f"http://Host.org/{i}", f"<div>Welcome to us</div>{extra}<div class=b><p>{text}</p><p>{text[::-1]}</p></div><div>All rights</div>", "t"))
    rows += [(100 + i, f"http://copy.org/{i}", "<div>same</div><p>everywhere</p>", "t") for i in range(5)]
    rows += [(200 + i, f"http://art.org/{i}", "<article><p>same</p></article><p>out</p>", "t") for i in range(5)]
    rows += [(300, None, None, "t"), (None, "http://one.org/", "<p>alone</p>", "t"), (301, "http://one.org/", "", "t"), (301, "http://one.org/", "", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(4)
    got = {}
    for x in extract_articles(df).collect():
        got.setdefault(x.page_id, []).append(x)
    for i in range(12):
        lines = got[i][0].text.split("\n")
        assert "Welcome to us" not in lines and "All rights" not in lines and len(lines) == 2 + (i % 3 == 0)
        assert got[i][0].n_chars == len(got[i][0].text) and got[i][0].url == f"http://Host.org/{i}"
    assert {got[100 + i][0].text for i in range(5)} == {"same\neverywhere"}
    assert {got[200 + i][0].text for i in range(5)} == {"same"}
    assert got[300][0].text == "" and got[None][0].text == "alone" and [x.n_chars for x in got[301]] == [0, 0]
    assert len(extract_articles(df.repartition(60)).collect()) == len(rows)
    assert extract_articles(df.limit(0)).count() == 0


def test_layout_words_on_or_around_the_article():
    article = "<article><h1>Title</h1><p>A long enough text of the page.</p><div class=share>tweet</div></article>"
    want = "Title\nA long enough text of the page."
    for name in ("has-sidebar", "no-ads", "page-with-sidebar"):
        assert plain(f'<body><div class="{name}">{article}<div class=sidebar>x</div></div></body>') == want
        assert plain(f'<body><div id="{name}"><main>{article}</main></div></body>') == want
        assert plain(f'<body><main><div id="{name}">{article}</div></main></body>') == want
    assert plain(article.replace("<article>", '<article class="post comments-open">')) == want
    comments = "<section class=comments><article class=comment><p>First!</p></article></section>"
    assert plain(f'<div class="has-sidebar">{article}{article}{comments}</div>') == f"{want}\n{want}"
    assert plain(f"<p>A page of plain text, longer than its comments.</p>{comments}") == "A page of plain text, longer than its comments."


def test_names_inside_an_article_lose_no_text():
    body = (
        '<article><h1>A</h1><h2 id="related-work">Related work</h2><p>We read much.</p><p class="teaser">The lead says more.</p>'
        '<section id="search-methods"><p>How to search.</p></section><div class="related-posts">Other</div><div class="shareButtons">Tweet</div>'
        '<ul class="social"><li>x</li></ul><div class="ad"><p>Buy</p></div><aside>no</aside></article>')
    assert plain(body) == "A\nRelated work\nWe read much.\nThe lead says more.\nHow to search."


def test_wrapper_drops_a_notice_inside_articles(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows, want = [], {}
    for i in range(24):
        paragraphs = [" ".join(r.choices(words, k=12)) for _ in range(r.randrange(2, 6))]
        at = r.randrange(len(paragraphs) + 1)
        notice = ["Subscribe to our weekly letter now!"] if i < 20 else []
        lines = ["Summary", *paragraphs[:at], *notice, *paragraphs[at:]]
        html = "<article><h2>Summary</h2>" + "".join(f"<p>{x}</p>" for x in lines[1:]) + "</article>"
        rows.append((i, f"http://a.org/{i}", html))
        want[i] = "\n".join(["Summary", *paragraphs])
    # Copies of one page are no proof, and three pages are too few.
    rows += [(100 + i, "http://b.org/x", "<article><p>one text</p><p>two text</p></article>") for i in range(30)]
    rows += [(200 + i, f"http://c.org/{i}", f"<article><p>same</p><p>text {i}</p></article>") for i in range(3)]
    want |= {100 + i: "one text\ntwo text" for i in range(30)} | {200 + i: f"same\ntext {i}" for i in range(3)}
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
        assert {x.page_id: x.text for x in extract_articles(df).collect()} == want


def test_wrappers_stay_small():
    r = random.Random(3)
    w = Wrapper()
    for _ in range(300):
        html = "<article><h1>T</h1>" + "".join(f'<div class="k{r.randrange(10**6)}">t</div>' for _ in range(20)) + "</article>"
        w = align(w, page_wrapper(page_blocks(html)))
    assert len(w.items) <= 20 * 21 and w.items[0].key == "R/article/h1" and w.items[0].pages == 300


def test_order_of_pages_does_not_matter(spark):
    r = random.Random(6)
    rows = [(i, "http://a.org/", f"<div>Top</div><div class=c><p>{r.random()}</p></div>" + "<div>End</div>" * (i % 4 > 0)) for i in range(40)]
    want = None
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = {x.page_id: x.text for x in extract_articles(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
        want = want or got
        assert got == want and all("Top" not in t and "End" not in t for t in got.values())
