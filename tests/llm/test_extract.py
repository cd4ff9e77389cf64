import html
import itertools
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartflow.llm import extract
from cartflow.llm.common import table
from cartflow.llm.queries import op3_extract


@pytest.fixture(scope="module")
def trees(spark):
    return extract.train(table(spark, "/root/testdata/sf0.01", "pages"))


def _article(source):
    """The text of the article element, as the pages were made."""
    inner = re.search(r"<article>(.*?)(?:</article>|$)", source, re.S)[1]
    parts = [re.sub(r"<[^>]*>", "", p) for p in re.split(r"</?(?:p|h1)\b[^>]*>|<br>", inner)]
    parts = [re.sub(r"\s+", " ", html.unescape(p)).strip() for p in parts]
    return "\n".join(p for p in parts if p)


def test_pages_of_the_table(spark):
    sf = "/root/testdata/sf0.01"
    want = {r.page_id: _article(r.html) for r in table(spark, sf, "pages").collect()}
    got = op3_extract(spark, sf).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


MESSY = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body>
<header class="site-header"><a href="/">Home</a> <a href="/b">Blog</a></header>
<div class="cookie-notice">We use cookies, please accept.</div>
<nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>
<main><article class=post><h1>A &amp; B&nbsp;head</h1>
<p>The first paragraph of the article has some words, and <b>bold ones</b>, to say.
<p>The second   paragraph goes on at length: it is not short, it has commas &lt;and&gt; stops.
<script>if (a < b) { document.write("</p><p>no</p>"); }</script>
<blockquote><p>A quoted remark that belongs to the text of the article.</p></blockquote>
<aside class="related">Related: <a href=3>another story</a></aside>
<p>The last paragraph closes the article with a full sentence.</p></article>
<section id="comments"><h2>Comments</h2><div class="comment"><p>Great article, I liked it very much, thank you!</p></div></section></main>
<form action="/s"><label>Mail</label><input name=q><button>Subscribe</button></form>
<div class="sidebar widget"><p>Popular posts of the week</p></div>
<!-- comment <p>hidden</p> -->
<footer><p>&copy; 2024 Site</p></footer></body></html>"""


def test_boilerplate_of_many_kinds(trees):
    got = extract.extract_text(MESSY, trees).split("\n")
    assert got == [
        "A & B head",
        "The first paragraph of the article has some words, and bold ones, to say.",
        "The second paragraph goes on at length: it is not short, it has commas <and> stops.",
        "A quoted remark that belongs to the text of the article.",
        "The last paragraph closes the article with a full sentence.",
    ]


def test_no_text_below_a_dropped_node(spark, trees):
    for r in table(spark, "/root/testdata/sf0.01", "pages").limit(40).collect():
        page = extract.parse(r.html + MESSY)
        kept = extract.decode(page, trees.log_odds(extract.features(page)))
        assert all(kept[n.parent] for i, n in enumerate(page.nodes) if i and kept[i])


def test_decoding_is_the_best_consistent_choice():
    page = extract.parse("<div><p>a</p><div><p>b</p><p>c</p></div></div><p>d</p>")
    rng = np.random.default_rng(4)
    for _ in range(20):
        odds = rng.normal(0, 2, len(page.nodes))
        value = np.clip(odds, -4, 4) * (1 + np.log1p([n.own for n in page.nodes]))
        value[0] = 0
        best = max(
            sum(value[i] for i in chosen)
            for k in range(len(page.nodes) + 1)
            for chosen in itertools.combinations(range(1, len(page.nodes)), k)
            if all(page.nodes[i].parent in (0, *chosen) for i in chosen)
        )
        kept = extract.decode(page, odds)
        assert abs(value[kept].sum() - best) < 1e-9


def test_trees_learn_a_rule():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 6)).astype(np.float32)
    y = ((x[:, 1] > 0.5) ^ (x[:, 4] > 0.3)).astype(float)
    model = extract.boost(x[:3000], y[:3000])
    assert ((model.log_odds(x[3000:]) > 0) == y[3000:]).mean() > 0.95


def test_odd_pages(spark, trees):
    long = "<p>" + "word " * 50_000 + "</p>"
    rows = [
        (1, "u", None), (2, None, ""), (3, "u", "plain  text\nonly"), (4, "u", "<div><p>unclosed <b>bold"), (5, "u", "<<< >>> & &amp; &bogus;"),
        (6, "u", long), (7, "u", "<script>only()"), (8, "u", "<p a='\"x\">y</p>"), (None, "u", "<p>no id</p>"), (1, "u", None), (9, "u", "<div>" * 3000 + "deep"),
    ]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, role int")
    got = extract.extract(pages, trees).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r.text for r in got}
    assert by_id[1] == by_id[2] == by_id[7] == "" and by_id[3] == "plain text only"
    assert by_id[6] == "word " * 49_999 + "word"
    assert extract.train(pages) is None  # none of them says what main text is
    assert extract.train(pages.limit(0)) is None
    told = extract.train(pages.withColumn("html", F.concat(F.lit("<main><p>Words of the main text.</p></main><nav>x</nav>"), "html")))
    assert np.isfinite(told.log_odds(np.zeros((3, extract.FEATURES)))).all()
    assert extract.extract(pages.limit(0), None).count() == 0
    assert extract.extract_text("<nav>a</nav><p>Some words here.</p>", None) == "Some words here."


DEEP = {
    "unclosed, then ends of nothing": lambda n: "<div>" * n + "</b>" * n,
    "tags without an end": lambda n: "<a " * n,
    "quotes that swallow the ends": lambda n: '<a ">' * n,
    "two kinds of quotes": lambda n: "<a \"'>" * n,
    "closed in themselves": lambda n: "<svg/>" * n,
    "raw text without an end": lambda n: "<script>" + "</script " * n,
    "ends kept by a cell": lambda n: "<b><table><td>" + "<div>" * n + "</b>" * n,
    "broken comments": lambda n: "<!-" * n + "<!" * n,
    "items in nested lists": lambda n: "<ul>" * n + "<li>" * n,
    "many siblings": lambda n: "<b>" * n + "<p>x" * n,
}


@pytest.mark.parametrize("name", DEEP)
def test_odd_markup_takes_linear_time(trees, name):
    made = []
    for n in (10_000, 40_000):
        begun = time.perf_counter()
        extract.extract_text(DEEP[name](n), trees)
        made.append(time.perf_counter() - begun)
    assert made[1] < max(8 * made[0], 1.0) and made[1] < 8


def test_tags_ends_and_quotes():
    """What the scanner takes for one tag, and where elements end."""
    blocks = lambda source: [t for _, t in extract.parse(source).blocks]
    assert blocks('<p title="a > b">x</p>') == ["x"]
    assert blocks("<p title='a > b\">x</p>") == ['b">x']  # the quote does not close: the first > ends the tag
    assert blocks("a < b <p>c</p> 1<2") == ["a < b", "c", "1<2"]
    assert blocks("<table><tr><td>a</p>b<td>c</table>d") == ["ab", "c", "d"]
    assert blocks("<ul><li>a<ul><li>b</ul>c<li>d</ul>") == ["a", "b", "c", "d"]
    assert blocks("<div><b>a</div>b</b>c") == ["a", "bc"]
    assert blocks("<p>a<!-- <p>no</p> -->b<![CDATA[no]]>c</p><script>no</script") == ["abc"]


def test_share_of_like_siblings_counts_all():
    page = extract.parse("<div>" + "<p>a</p>" * 100 + "<ul></ul>" * 100 + "</div>")
    shares = {page.nodes[i].tag: extract.features(page)[i, 17] for i in range(2, len(page.nodes))}
    assert shares == {"p": 0.5, "ul": 0.5}


def test_decides_without_telling_tags(spark, trees):
    """Pages that the trees were not fitted on, all telling tags and tokens hidden: by
    characters, what the markup says and what density and siblings say agree."""
    pages = table(spark, "/root/testdata/sf0.1", "pages").orderBy("page_id").limit(600).collect()
    right = total = 0
    for r in pages[300:]:
        page = extract.parse(r.html)
        role = extract.plain_roles(page)
        kept = extract.decode(page, trees.log_odds(extract.features(page, plain=True)))
        for i, n in enumerate(page.nodes):
            if role[i] >= 0:
                total += n.own
                right += n.own * (kept[i] == role[i])
    print(f"characters decided as the hidden markup says: {right / total:.4f}")
    assert right / total > 0.9
