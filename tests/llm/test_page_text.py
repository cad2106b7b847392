import re
import time
from collections import defaultdict
from html import unescape

import pytest

from hitscope.llm import page_text


def text(markup, template=()):
    return page_text.main_text(page_text.parse(markup), set(template))


@pytest.mark.parametrize(
    "markup, want",
    [
        ("", ""),
        ("plain  &amp;\n text", "plain & text"),
        ("<article><h1>A</h1><p><b>one<br><p>two &lt;b&gt; t<i>hr</i>ee</p></article><footer>f</footer>", "A one two <b> three"),
        ("<nav>m</nav><header>h</header><p>x<p>y<script>var t='</p>';</script><!-- c --><style>p{}</style>", "x y"),
        ("<main><header><h1>T</h1></header>a<div class='comments'>no</div><aside>s</aside>b</main><p>out", "T a b"),
        ("<body><div id=sidebar>no</div><div class='cookie-notice'>no</div><form>f<input></form><ul><li>a<li>b</ul>", "a b"),
        ("<p title='a>b'>x</p><p data-a=\"unclosed>y</p>", "x y"),
        ("<p hidden>no</p><div style='display: none'>no</div>a<table><tr><td>1<td>2</table>", "a 1 2"),
        ("<article class='post has-comments'>yes<article class='comment'>no</article></article>", "yes"),
        ("a</b></div></p>b <unclosed", "a b <unclosed"),
        ("<title>t</title><textarea><p>x</p></textarea>z<script>never ends", "z"),
        ("a&nbsp;b&#233;&#x1F600;&unknown;", "a bé😀&unknown;"),
    ],
)
def test_markup(markup, want):
    assert text(markup) == want


def page(body, menu="<div>Home About</div>"):
    return f"<html><body>{menu}<div><p>{body}</p></div><div>(c) site</div></body></html>"


def test_template_of_a_host_goes(spark):
    rows = [(i, "http://a.example/x", page(f"text {i}"), 1) for i in range(6)] + [(9, "http://b.example/x", page("other"), 1)]
    rows += [(20 + i, "http://c.example", page("a copy"), 1) for i in range(8)] + [(30, None, None, 1), (None, "x", "", 1)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    out = page_text.extract(frame)
    got = {r.page_id: (r.text, r.n_chars) for r in out.collect()}
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    for i in range(6):
        assert got[i] == (f"text {i}", 6)
    # one page of a host, and copies of one page, show no template
    assert got[9][0] == "Home About other (c) site"
    assert got[25][0] == "Home About a copy (c) site"
    assert got[30] == ("", 0) and got[None] == ("", 0)


def test_pages_table_against_its_article(spark):
    """The given pages have one article each; a plain rendering of it is the expected text."""
    frame = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in page_text.extract(frame).collect()}
    for r in frame.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        want = " ".join(unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)[^>]*>", " ", inner))).split())
        assert got[r.page_id] == want


def test_empty_table(spark):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    assert page_text.extract(frame).collect() == []


def test_template_inside_an_article_goes(spark):
    """A subscribe box without a telling class recurs in the articles of a host, and no other part does."""
    body = "<body><div>Top</div><article><h1>Title {0}</h1><p>Some longer text of page {0}.</p><div class=x1><p>Get our letter</p></div></article></body>"
    rows = [(i, "http://a.example/x", body.format(i)) for i in range(6)]
    # an article that recurs as a whole, its pages differing in a menu, is content
    rows += [(20 + i, "http://b.example/x", f"<div>Menu {i}</div><main><h1>One</h1><p>The same text</p></main>") for i in range(6)]
    got = {r.page_id: r.text for r in page_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(6):
        assert got[i] == f"Title {i} Some longer text of page {i}."
        assert got[20 + i] == "One The same text"


def test_pages_are_not_shuffled(spark):
    """Only hashes are exchanged: the markup meets a broadcast table of templates."""
    frame = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = page_text.extract(frame)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_template_is_a_share_of_the_host(spark):
    """What occurs in a few of many pages is content, and a host of three pages has templates."""
    rows = [(i, "http://a.example/x", page(f"text {i}</p><h2>Summary</h2><p>" if i % 4 == 0 else f"text {i}")) for i in range(32)]
    rows += [(100 + i, "http://b.example/x", page(f"text {i}")) for i in range(3)]
    # one long text under pages that differ in a menu and a date
    long = "<div><h2>One</h2><p>The same long text of the host</p></div>"
    rows += [(200 + i, "http://c.example/x", f"<body><div>Menu {i}</div>{long}<div>day {i}</div></body>") for i in range(8)]
    got = {r.page_id: r.text for r in page_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(32):
        assert got[i] == (f"text {i} Summary" if i % 4 == 0 else f"text {i}")
    for i in range(3):
        assert got[100 + i] == f"text {i}"
    for i in range(8):
        assert got[200 + i] == f"Menu {i} One The same long text of the host day {i}"


@pytest.mark.parametrize(
    "markup, want",
    [
        ("<div class='layout has-sidebar'><article>a</article></div>", "a"),
        ("<div id='page-menu-wrap'><div>Menu Home</div><main><p>a</p><div class=share>no</div></main></div>", "a"),
        ("<div class='no-share'><div><p>A long enough text</p></div></div><div class=share>no</div>", "A long enough text"),
        ("<form id=aspnet><div class=nav>no</div><div><h1>A</h1><p>long enough text</p></div><form>f</form></form>", "A long enough text"),
        ("<form><article>a</article><input></form>", "a"),
        # beside the main part, and where a list of other things has the only article, the words hold
        ("<article>The text</article><div class='has-sidebar'><article>no</article></div>", "The text"),
        ("<div>The text of the page</div><div class='related-posts'><article>no</article></div>", "The text of the page"),
        ("<div class=comments><article>no</article></div><p>a</p>", "a"),
    ],
)
def test_words_of_a_container_around_the_text(markup, want):
    assert text(markup) == want


def recount(rows, min_pages=3):
    """Menus, adverts and footers of the given pages by host, counted without the operator: outermost elements beside the article."""
    pages, found = defaultdict(set), {}
    for r in rows:
        host = re.match(r"https?://([^/?#:]*)", r.url)[1].lower()
        beside = re.sub(r"<article>.*</article>|<(script|style|title)>.*?</\1>|<head>.*?</head>", "", r.html, flags=re.S)
        found[r.page_id] = [(host, x[0]) for x in re.finditer(r"<(nav|footer|div)\b[^>]*>.*?</\1>", beside, re.S)]
        for x in found[r.page_id]:
            pages[x].add(re.sub(r"<(script|style|title)>.*?</\1>", "", r.html, flags=re.S))
    return {i: (sum(len(pages[x]) >= min_pages for x in own), sum(len(pages[x]) < min_pages for x in own)) for i, own in found.items()}


def test_counts_delete_before_rules(spark):
    """Against a recount; on this table a part of the menus, adverts and footers recurs, and the rules take the others."""
    frame = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = frame.select("page_id", "url", "html").collect()
    got = {r.page_id: (r.by_counts, r.by_rules) for r in page_text.removals(frame).collect()}
    want = recount(rows)
    whole = {i: (a, b) for i, (a, b) in got.items()}
    assert sum(a for a, _ in want.values()) > 0
    # single items of a menu recur where the menu as a whole does not: they count besides
    assert all(whole[i][1] == b and whole[i][0] >= a for i, (a, b) in want.items())


@pytest.mark.parametrize(
    "make",
    [
        lambda n: "<a " * n, lambda n: "<a " * n + ">", lambda n: "<div>x" * n, lambda n: "<div>" * n + "</x>" * n, lambda n: "<a \"x'>" * n, lambda n: "<a '\"><p>" * n + '"',
        lambda n: "<!" * n, lambda n: "<a" * n, lambda n: "<div>" * n + "<p>t</p>" * n, lambda n: "<!--" * n, lambda n: "<ul><li><ul>" + "<h1>" * n + "<li>x" * n, lambda n: "<p>" + "word " * (20 * n),
    ],
)
def test_broken_and_deep_pages_take_linear_time(make):
    page_text.parse(make(1000))
    before = time.process_time()
    page_text.main_text(page_text.parse(make(60_000)), set())
    assert time.process_time() - before < 20


def test_a_very_long_page(spark):
    body = "<nav>m</nav><article>" + "".join(f"<p>part {i}</p>" for i in range(60_000)) + "</article>"
    got = page_text.extract(spark.createDataFrame([(1, "http://a.example", body)], "page_id long, url string, html string")).first()
    assert got.text == " ".join(f"part {i}" for i in range(60_000))
