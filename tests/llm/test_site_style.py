import re

import pytest
from rxcover.llm import site_style as ss

SCHEMA = "page_id long, url string, html string, host string, low string"


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("plain  text ", "plain text"), ("<p>a<p>b", "a b"),
    ("<article><h1>T</h1><p>x <b>y</b>z<br>w</p></article><footer>f</footer>", "T x yz w"),
    ("<nav>m</nav><article><p>a &amp; b &lt;c&gt; &#233; &am</p></article>", "a & b <c> é &am"),
    ("<head><title>t</title></head><body><script>var x='</p>'; y()</script><style>p{}</style><p>a</p><!-- c --></body>", "a"),
    ("<div class='side-bar sidebar'>s</div><div id=main><p>text", "text"),
    ("<article><p>a</p><div class=\"comments\"><article><p>c</p></article></div></article>", "a"),
    ("<article class='comment'>c</article><article>a</article>", "a"),
    ("<header>h</header><main><header><h1>T</h1></header>x<form>f</form><aside>s</aside></main>", "T x"),
    ("<article><p>a</p></article><foo", "a"), ("a < b <", "a < b <"), ("<p>1 <3 4</p>", "1 <3 4"),
    ("<ul><li>a<li>b</ul>c", "a b c"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
    ("<p hidden>x</p><p style='display: none'>y</p>z", "z"), ("<div class=ad>x</div><p>y</p>", "y"),
    ("<p>a<b>b<p>c</b>d", "ab cd"), ("<textarea>t</textarea>u", "u"), ("<a title='x>y'>q</a>r", "qr"),
])
def test_page(html, text):
    assert ss.extract(html) == text


def site(n=30):
    """Pages of one host with an unnamed repeated box inside the article."""
    rows = []
    for i in range(n):
        words = " ".join(f"w{i}x{k}" for k in range(40))
        rows.append((i, f"https://h.example/{i}", f"<body><div><p>Title {i}</p><p>{words}</p>"
                     f"<section><span>Read our offer {i % 2}</span><a>Go on</a></section></div></body>", "clash", "clash"))
    return rows


def brute(rows):
    return {i: f"Title {i} " + re.search(r"<p>(w[^<]*)</p>", h)[1] for i, _, h, *_ in rows}


def test_repeated_branch_is_removed(spark):
    rows = site()
    got = ss.extract_pages(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.page_id: r.text for r in got} == brute(rows)
    assert all(r.n_chars == len(r.text) for r in got)


def test_alike_pages_and_edges(spark):
    same = [(i, "http://same/", "<div><p>all alike</p><div>box</div></div>", "", "") for i in range(20)]
    rows = same + [(50, None, None, "", ""), (50, None, None, "", ""), (51, "x", "<p>t" + " long" * 60000, "", ""),
                   (None, "http://one/", "<nav>n</nav>k", "", "")]
    got = ss.extract_pages(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got}
    assert by[3] == "all alike box" and by[50] == "" and len(by[51]) == 1 + 5 * 60000 and by[None] == "k"
    assert ss.extract_pages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_given_pages_match_article_paragraphs(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in ss.extract_pages(pages).collect()}
    from html import unescape
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        body = re.sub(r"<[a-z/][^<>]*$", "", body)
        plain = " ".join(unescape(re.sub(r"</?(?:p|h1|br)[^<>]*>", " ", body).replace("<b>", "").replace("</b>", "")).split())
        assert got[r.page_id] == plain, r.page_id


def own(i, n=40):
    return " ".join(f"w{i}x{k}" for k in range(n))


@pytest.mark.parametrize("n", [2, 3, 5, 7])
def test_small_hosts_are_judged(spark, n):
    rows = [(i, f"https://small{n}.example/{i}", f"<body><div><p>{own(i)}</p><div class=lead>{own(i + 90)}</div></div>"
             "<section><span>Read our offer</span><a>Go on</a></section></body>", "", "") for i in range(n)]
    got = ss.extract_pages(spark.createDataFrame(rows + [(99, "https://one.example/", rows[0][2], "", "")], SCHEMA)).collect()
    assert {r.page_id: r.text for r in got} == {i: f"{own(i)} {own(i + 90)}" for i in range(n)} | {99: f"{own(0)} {own(90)} Read our offerGo on"}


def test_box_on_few_pages_and_boilerplate_paragraph(spark):
    """A box on two of 30 pages goes, as does a paragraph of its own class
    that all pages repeat; varied paragraphs with a class stay."""
    rows = [(i, f"https://big.example/{i}", f"<body><article><h1>T{i}</h1><p class=lead>{own(i)}</p><p>{own(i + 50)}</p>"
             + ("<div class=extra>Only today<br>Buy it</div>" if i in (4, 17) else "")
             + "<p class=legal>No advice is given.</p></article></body>", "", "") for i in range(30)]
    got = ss.extract_pages(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.page_id: r.text for r in got} == {i: f"T{i} {own(i)} {own(i + 50)}" for i in range(30)}


LONG = "This is the text of the page, and it goes on for a while."


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "post with-comments", "article-share-wrap", "related-topic"])
@pytest.mark.parametrize("body", ["<article><h1>T</h1><p>{0}</p></article>", "<h1>T</h1><p>{0}</p>", "<main><header><h1>T</h1></header>{0}</main>"])
def test_name_around_the_text_is_evidence_only(name, body):
    inner = f"<div class={name!r}>{body.format(LONG)}<div class='sidebar'>s</div><div class=ad>a</div></div>"
    assert ss.extract(f"<body><nav>n</nav>{inner}</body>") == f"T {LONG}"
    assert ss.extract(f"<body><nav>n</nav><div class=top><p>x</p></div>{inner}</body>").endswith(f"T {LONG}")
    assert ss.extract(f"<div class='page-header'><div id='with-menu'>{inner}</div></div>") == f"T {LONG}"


@pytest.mark.parametrize("html,text", [
    (f"<article class='post with-comments'><header><h1>T</h1></header><p>{LONG}</p></article>", f"T {LONG}"),
    (f"<article><div class='article-share-wrap'><p>{LONG}</p></div><div class=share>Share</div></article>", LONG),
    (f"<h1>T</h1><div class=notice>{LONG}</div>", f"T {LONG}"),
    (f"<h1><a href=x>T</a></h1><div class=notice>{LONG}</div>", f"T {LONG}"),
    (f"<h1>T</h1><p>short</p><div class=comments>{LONG}</div>", "T short"),
    (f"<div><h1>T</h1><p>{LONG}</p></div><div class=comments-area><article>c</article></div>", f"T {LONG}"),
    (f"<article><p>a</p></article><div class='related-items'><article>{LONG}</article></div>", "a"),
    ("<div class=menu>m</div><div hidden>h</div>", "m"), ("<form>f</form>", "f"), ("<body style='display:none'><p>x</p></body>", "x"),
])
def test_names_and_what_is_left(html, text):
    assert ss.extract(html) == text
