import re
from html.parser import HTMLParser

import pytest

from dockcast.llm import html as h

SCHEMA = "page_id long, url string, html string"


class Article(HTMLParser):
    """Independent reading: all text inside <article>, blocks apart, white space folded."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag in ("p", "h1", "br", "div"):
            self.out.append(" ")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        if tag in ("p", "h1", "div"):
            self.out.append(" ")

    def handle_data(self, data):
        if self.depth:
            self.out.append(data)


def article(page):
    p = Article()
    p.feed(page)
    return " ".join("".join(p.out).split())


def test_driver_pages_equal_an_independent_reading(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in h.html_query(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.page_id].text == article(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text)


def soup(i):
    """A host without article tags: template text, menus, adverts, comments around differing paragraphs."""
    ps = "".join(f"<p>Body {i} para {k} &amp; <b>more</b>,<i>text</i>&#8212;end" + ("</p>" if k % 2 else "") for k in range(1 + i % 4))
    ad = "<div class='sponsored box'>Buy now</div>" if i % 2 else ""
    return (f"<html><head><title>t</title><style>p{{}}</style></head><body><div id=top-menu><a href=/>Home</a> | <a href=/x>X</a></div>"
            f"<div class=\"wrap\"><div>Example site, all rights</div>{ad}<h1>Head {i}</h1>{ps}<ul><li><a href=/a>A {i}</a><li><a href=/b>B</a></ul></div>"
            f"<!-- c --><form><p>Your mail <input></p></form><section id='user-comments'><p>Nice {i}!</p></section>"
            f"<script>document.write('<p>no</p>')</script><footer><p>&copy; {i}</p></footer></body></html>")


def test_soup_host_and_edge_pages(spark):
    rows = [(i, f"https://soup.example/{i}", soup(i)) for i in range(12)]
    rows += [(100, None, None), (101, "no url", ""), (102, "http://one.example/", "plain &lt;text&gt; <b>only"), (103, "http://x.example/", "<main><p>a<p>b <nav>n</nav></main><aside>z"),
             (104, "http://big.example/", "<article>" + "<p>word " * 30_000), (0, "https://soup.example/0", soup(0)), (None, "http://x.example/2", "<main><p>c")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS host", "2 AS wrapper", "'x' AS text").repartition(4)
    got = {}
    out = h.html_query(df).collect()
    assert len(out) == len(rows)
    for r in out:
        got[r.page_id] = r.text
    for i in range(12):
        body = " ".join(f"Body {i} para {k} & more,text—end" for k in range(1 + i % 4))
        assert got[i] == f"Head {i} {body}", i
    assert got[100] == "" and got[101] == "" and got[102] == "plain <text> only" and got[103] == "a b" and got[None] == "c"
    assert got[104] == " ".join(["word"] * 30_000)
    assert h.html_query(spark.createDataFrame([], SCHEMA)).collect() == []


def test_article_leaves_out_what_is_not_text(spark):
    page = ("<body><header><h1>Site</h1></header><div class=cookie-notice>We use</div><article class='post'><header><h1>Title</h1></header>"
            "<p>One <a href=#>link</a>.</p><div class='share-buttons'>tweet</div><aside>side</aside><figure><img><figcaption>Cap</figcaption></figure>"
            "<form>mail</form><p>Two</p><div class=comments><p>first!</p></div><style>x</style><noscript>js</noscript></article><div class=\"related\">more</div>")
    rows = [(1, "https://a.example/1", page), (2, "https://a.example/2", page.replace("One", "Uno"))]
    got = {r.page_id: r.text for r in h.html_query(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: "Title One link. Cap Two", 2: "Title Uno link. Cap Two"}


def test_wrapper_is_a_union_free_expression():
    a = h.page_wrapper(h.read_page("<ul><li>x</li></ul><p>same</p>"))
    b = h.page_wrapper(h.read_page("<ul><li>x</li><li>y</li></ul><h2>new</h2><p>same</p>"))
    assert h.expression(h.merge(a, b)) == '<#root><ul>(<li>#TEXT</li>)+</ul> (<h2>"new"</h2>)? <p>"same"</p></#root>'
    c = h.page_wrapper(h.read_page("<dl><dt>a<dd>1<dt>b<dd>2<dt>c<dd>3</dl>"))
    assert h.expression(c) == "<#root><dl>(<dt>#TEXT</dt> <dd>#TEXT</dd>)+</dl></#root>"
    assert h.expression(h.merge(a, a)) == h.expression(a)


@pytest.mark.parametrize("page", ["<", "<p", "</", "<!--", "<script>", "<a href='", "&#x110000;&bogus;", "<p>a</p></div></p>", "<br/><br><hr>", "<li><li></ul><td>"])
def test_broken_markup_does_not_fail(page):
    text = h.extract(page, h.main_paths(h.page_wrapper(h.read_page(page))))
    assert not re.search(r"\s\s", text)


def test_a_container_on_one_page_does_not_blank_the_others(spark):
    rows = [(1, "https://a.example/1", "<body><article><p>In article</p></article><p>out</p>"),
            (2, "https://a.example/2", "<body><div><p>Plain two</p></div>"), (3, "https://a.example/3", "<body><div><p>Plain three</p></div>"),
            (4, None, "<div class='post-list'><p>Listed</p></div>"), (5, "/relative", "<p>Bare text</p>"),
            (6, "https://b.example/1", "<html class='no-sidebar'><body class='has-sidebar search'><article class='post comments-open'><p>Kept</p></article>"),
            (7, "https://c.example/1", "<body><main class='with-sidebar'><article class='share'><p>Only one</p></article></main>"),
            (8, "https://c.example/2", "<body><article class='post'><p>The post</p></article><article class='comment'><p>A comment</p></article>")]
    got = {r.page_id: r.text for r in h.html_query(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: "In article", 2: "Plain two", 3: "Plain three", 4: "Listed", 5: "Bare text", 6: "Kept", 7: "Only one", 8: "The post"}


def test_unnamed_template_text_inside_the_article_goes_when_pages_agree(spark):
    def page(i, box):
        return (f"<body><article><h1>Head {i}</h1><p>One {i}</p><p>Two</p><div class=box7>{box}</div>"
                f"<div><ul><li><a href=/a>A {i}</a></li><li><a href=/b>B {i}</a></li></ul></div></article>")
    rows = [(i, f"https://same.example/{i}", page(i, "Get the app")) for i in range(4)]
    rows += [(10 + i, f"https://differ.example/{i}", page(i, f"Box {i}")) for i in range(4)]
    rows += [(20, "https://alone.example/", page(0, "Get the app"))]
    got = {r.page_id: r.text for r in h.html_query(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i in range(4):
        assert got[i] == f"Head {i} One {i} Two"
        assert got[10 + i] == f"Head {i} One {i} Two Box {i}"
    assert got[20] == "Head 0 One 0 Two Get the app A 0 B 0"


def test_a_mirrored_article_is_kept_whole(spark):
    same = "the whole article, word for word on every page of the host, far longer than the title"
    rows = [(i, f"https://mirror.example/{i}", f"<body><nav><a href=/>Home</a></nav><article><h1>Title {i}</h1><div><p>{same}</p></div><h2>End</h2></article>")
            for i in range(6)]
    rows += [(10 + i, f"https://own.example/{i}", f"<body><article><h1>Title {i}</h1><div><p>A long paragraph that only page {i} has, number {i * i}</p></div>"
              "<h2>Read more here</h2></article>") for i in range(6)]
    got = {r.page_id: r.text for r in h.html_query(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i] for i in range(6)] == [f"Title {i} {same} End" for i in range(6)]
    assert [got[10 + i] for i in range(6)] == [f"Title {i} A long paragraph that only page {i} has, number {i * i}" for i in range(6)]


def _timed(pages, seconds):
    """Texts of pages of one host; fails if they take much longer than pages of their size should."""
    import time
    start = time.time()
    w = None
    with h.deep():
        trees = [h.read_page(p) for p in pages]
        kinds = {h.page_kind(t) for t in trees}
        for t in trees:
            w = h.page_wrapper(t) if w is None else h.merge(w, h.page_wrapper(t))
        (kind,) = kinds
        w = h._loads(h._dumps({kind: [len(pages), w]}))[kind][1]
        rules = h.main_paths(w, kind, len(pages))
        out = [h.extract(t, rules) for t in trees]
    assert time.time() - start < seconds
    return out


def test_a_hundred_thousand_nested_tags():
    n = 100_000
    pages = [f"<article>{'<div>' * n}<p>deep {i}</p>{'</div>' * n}<p>end {i}</p></article>" for i in range(2)]
    assert _timed(pages, 60) == ["deep 0 end 0", "deep 1 end 1"]
    assert _timed(["<article>" + "<x>" * n + "</y>" * n + "<p>text"], 60) == ["text"]


def test_a_hundred_thousand_siblings():
    n = 100_000
    one = "<article>" + "".join(f"<div class='c{chr(97 + i % 7)}{chr(97 + i // 7 % 23)}{chr(97 + i // 161 % 26)}'>t{i}</div>" for i in range(n)) + "</article>"
    two = "<article>" + "".join(f"<div class='c{chr(97 + i % 7)}{chr(97 + i // 7 % 19)}{chr(97 + i // 133 % 26)}'>u{i}</div>" for i in range(n)) + "</article>"
    got = _timed([one, two], 120)
    assert got == [" ".join(f"t{i}" for i in range(n)), " ".join(f"u{i}" for i in range(n))]


def test_a_megabyte_of_unclosed_quotes():
    n = 300_000
    assert _timed(["<article><p>before</p>" + "<a " * n + '"'], 30) == ["before"]
    assert _timed(["<article><p>before</p>" + "<b x='\"' " * (n // 4) + "' \" <p>after"], 30) == ["before after"]
    assert _timed(["<article><p>one <i title=\"open>two</i></p><p>three</p>"], 5) == ["one two three"]


def test_long_lists_are_matched_like_short_ones(monkeypatch):
    import random
    rng = random.Random(3)
    for _ in range(60):
        x = [rng.choice("abcdefghijklmnop") * rng.choice([1, 2, 9]) for _ in range(rng.randrange(40))]
        y = [v for v in x if rng.random() < 0.8] + [rng.choice("xyz") for _ in range(3)]
        monkeypatch.setattr(h, "CELLS", rng.choice([0, 20, 400]))
        pairs = h._matches(x, y)
        assert all(x[i] == y[j] for i, j in pairs)
        assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))
        if h.CELLS == 400 and len(x) * len(y) <= 400:
            assert len(pairs) == h._table(x, y)[0][0]


def test_deep_pages_through_spark(spark):
    rows = [(i, "http://h/x", f"<article>{'<div>' * 3000}<p>deep {i}</p></article>") for i in range(3)]
    got = h.html_query(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(r.text for r in got) == ["deep 0", "deep 1", "deep 2"]
