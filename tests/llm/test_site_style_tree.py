"""Readers' comments, template lines and the tree itself against plain versions."""

import math
from collections import Counter, defaultdict

import pytest

from tidegate.llm import site_style

LONG = " ".join(f"reader{i} thinks otherwise" for i in range(40))
COMMENTS = f"<h2>Comments</h2><div class='comment'><span class='author'>Ann</span><p>{LONG}</p></div>" * 2


def texts(spark, pages):
    table = spark.createDataFrame([(i, "http://a.example/", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return [r.text for r in site_style.main_text(table).orderBy("row.page_id").collect()]


@pytest.mark.parametrize(
    "page",
    [
        "<main><h1>Head</h1><p>word{0} is text</p><div class=comments>{1}</div></main>",
        "<article><h1>Head</h1><p>word{0} is text</p><section id=comments>{1}</section></article>",
        "<main><article><h1>Head</h1><p>word{0} is text</p></article><section id=comments>{1}</section></main>",
        "<div class=post><h1>Head</h1><p>word{0} is text</p></div><div class=comments>{1}</div>",
        "<main><h1>Head</h1><p>word{0} is text</p><ol class='comment-list'><li><article>{1}</article></ol></main>",
        "<div class=post><h1>Head</h1><p>word{0} is text</p></div><div id='disqus_thread'><article>{1}</article></div>",
    ],
)
def test_comments_longer_than_the_text(spark, page):
    pages = [page.format(i, COMMENTS.replace("otherwise", f"otherwise{i}")) for i in range(30)]
    # The heading is the same everywhere, so outside of articles the tree takes it for template.
    want = ("Head " if "<article>" in page.split("{1}")[0] or "<main>" in page else "") + "word7 is text"
    assert texts(spark, pages)[7].removeprefix("Head ") == want.removeprefix("Head ")
    assert site_style.extract(pages[7], {}, {}) == "Head word7 is text"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        # A talk that is built like a thread, and one that is a part of the article.
        ("<article><p>a</p><section id=discussion><div><b class=user>X</b>b</div><div><b class=user>Y</b>c</div></section></article>", "a"),
        ("<article><p>a</p><section id=discussion><h2>Discussion</h2><p>b</p><p>c</p></section></article>", "a Discussion b c"),
        # Names that tell a page's state, code, and an opinion piece.
        ("<article class='post comments-open'><p>a</p></article>", "a"),
        ("<div class='has-comments'><p>a</p></div>", "a"),
        ("<article><pre>f(x) <span class=comment># x</span></pre></article>", "f(x) # x"),
        ("<article class='comment'><p>opinion</p></article>", "opinion"),
        ("<div class='comments-wrapper'><article><p>a</p></article></div>", "a"),
        # Nothing but comments beside an article stays empty.
        ("<article></article><section id=comments><p>b</p></section>", ""),
    ],
)
def test_names_of_comments(page, want):
    assert site_style.extract(page, {}, {}) == want


def test_a_line_of_all_pages_goes_from_main(spark):
    page = "<main><h1>Head {0}</h1><p>word{0} is text</p><p>Subscribe to <b>our letter</b> now</p><p>and word{0} more of it</p></main>"
    got = texts(spark, [page.format(i) for i in range(30)])
    assert got[7] == "Head 7 word7 is text and word7 more of it"
    # Too few pages to judge by.
    assert texts(spark, [page.format(i) for i in range(4)])[2] == "Head 2 word2 is text Subscribe to our letter now and word2 more of it"


def test_copies_and_near_copies_are_no_template(spark):
    near = "<article><h1>Title</h1><p>first part of a text</p><p>second part of it</p><p>no {0}</p></article>"
    got = texts(spark, [near.format(i) for i in range(30)])
    assert got[7] == "Title first part of a text second part of it no 7"
    got = texts(spark, [near.format(1)] * 20 + [f"<article><p>own text {i}</p></article>" for i in range(15)])
    assert got[0] == "Title first part of a text second part of it no 1"
    assert got[25] == "own text 5"


def test_the_tree_decides_without_article(spark):
    page = "<body><div class='x'>Welcome to our site</div><div class='y'><p>word{0} is text</p></div><div class='z'>Opening hours 9 to 5</div></body>"
    pages = [page.format(i) for i in range(30)]
    assert texts(spark, pages)[7] == "word7 is text"
    assert site_style.extract(pages[7], {}, {}) == "Welcome to our site word7 is text Opening hours 9 to 5"


def test_importances_equal_a_plain_count(spark):
    pages = [
        f"<body><div class='a'>{'same' if i % 3 else i}</div><div class='b'>{'<p>x</p>' * (i % 2)}<i>{i // 5}</i></div></body>"
        for i in range(24)
    ]
    table = spark.createDataFrame([("http://h.example/", p) for p in pages], "url string, html string")
    seen = defaultdict(Counter)
    for page in pages:
        for key, feature in site_style.features(site_style.parse(page)[0]).items():
            seen[key][feature] += 1
    want = {}
    for (path, kind), counts in seen.items():
        m = sum(counts.values())
        entropy = -sum(n / m * math.log(n / m) for n in counts.values()) / math.log(m) if m > 1 else 1.0
        want.setdefault(site_style._signed(path), [1.0, 1.0, 0])[kind] = entropy
        want[site_style._signed(path)][2] = max(m, want[site_style._signed(path)][2])
    got = {x.path: x for r in site_style.importances(table, "url", "html").collect() for x in r.tree}
    assert set(got) == {p for p, w in want.items() if w[2] >= site_style.MIN_PAGES}
    for path, x in got.items():
        assert x.style == pytest.approx(want[path][0], abs=1e-9) and x.content == pytest.approx(want[path][1], abs=1e-9)


def test_columns_with_clashing_names(spark):
    names = ["page_id", "url", "html", "row", "page", "host", "shape", "tree", "path", "same", "text"]
    table = spark.createDataFrame([(1, "http://a/", "<p>a</p>", 1, 2, 3, 4, 5, 6, 7, 8)], names)
    got = site_style.main_text(table).collect()
    assert [(r.row.page_id, r.row.tree, r.row.text, r.text) for r in got] == [(1, 5, 8, "a")]
