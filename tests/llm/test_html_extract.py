from html.parser import HTMLParser

import pytest

from labharm.llm import html_extract as H
from labharm.llm.catalog import op4_html_extract


class Article(HTMLParser):
    """What stands in the article element, by another parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag in H.BLOCKS:
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        if tag in H.BLOCKS:
            self.blocks.append("")

    def handle_data(self, data):
        self.blocks[-1] += data if self.inside else ""


def article(page):
    p = Article()
    p.feed(page)
    p.close()
    return "\n".join(t for t in (" ".join(b.split()) for b in p.blocks) if t)


def test_all_pages(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.page_id: r for r in op4_html_extract(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(rows) == 2500
    assert all(got[r.page_id].text == article(r.html or "") and got[r.page_id].n_chars == len(article(r.html or "")) for r in rows)


def brute_run(scores):
    best = max(((sum(scores[i:j]), -i, -j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0,))
    return (-best[1], -best[2]) if best[0] > 0 else (0, 0)


@pytest.mark.parametrize("scores", [[], [-1], [1], [1, -2, 3, -1, 2, -9, 4], [2, -1, 0.5], [-3, 5, 5, -20, 9]])
def test_best_run(scores):
    a, z = H.best_run(scores)
    assert sum(scores[a:z]) == sum(scores[slice(*brute_run(scores))])


BLANK = H.Weights(H.Counter(), H.Counter())


@pytest.mark.parametrize(
    "page,want",
    [
        (None, ""),
        ("", ""),
        ("<", "<"),
        ("<p>one &amp; two&nbsp;three&#33;<br>four\n five</p>", "one & two three! four five"),
        ("<body><nav><a>Home</a><a>News</a></nav><main><h1>Head</h1><p>Body text with words</p><ul><li>first item</li><li>second item</li></ul></main><aside>other</aside></body>", "Head\nBody text with words\nfirst item\nsecond item"),
        ("<div class='sidebar'><p>many words stand here beside it</p></div><div class='post'><p>The text that matters, at length.</p></div><div id=comments><p>First! I do not agree with this text at all.</p></div>", "The text that matters, at length."),
        ("<article><p>kept words here</p><script>if (a<b) x('</p>')</script><div class=ad>Buy this now</div><form>Your name <input></form><p>more kept words<!-- not this --></p><section class=\"comments\"><article class=\"comment\"><p>reader says a lot of things</p></article></section></article>", "kept words here\nmore kept words"),
        ("<p>unclosed <b>bold<p>next one", "unclosed bold\nnext one"),
        ("<p>hidden not</p><p style='display: none'>secret</p><p>a < b and c</p>", "hidden not\na < b and c"),
    ],
)
def test_shapes(page, want):
    assert H.extract(page, BLANK) == want


def test_edges(spark):
    schema = "page_id long, url string, html string, text int"
    pages = spark.createDataFrame([(1, None, None, 1), (1, None, None, 1), (None, "u", "<article><p>" + "word " * 100_000 + "</p></article>", 2)], schema)
    got = sorted((r.page_id or 0, len(r.text)) for r in H.texts(pages, H.fit(pages)).collect())
    assert got == [(0, 499_999), (1, 0), (1, 0)]
    empty = pages.limit(0)
    assert H.texts(empty, H.fit(empty)).collect() == []


@pytest.mark.parametrize(
    "page,want",
    [
        ("<p>before it <svg viewBox='0 0 1 1'/> after it</p><p>more text</p>", "before it after it\nmore text"),
        ("<p>formula <math><mi>x</mi><mo>+</mo><mn>1</mn></math> stands here</p>", "formula x+1 stands here"),
        ("<p>empty <math/> formula</p><p>more text</p>", "empty formula\nmore text"),
        ("<p>one two</p><object data=x /><p>three four</p>", "one two\nthree four"),
        ("<p>one two <button>Buy</p><p>three four five</p><div><button>Sell</button></div><p>six seven eight</p>", "one two\nthree four five\nsix seven eight"),
        ("<p>one two</p><audio src=x><p>three four</p>", "one two\nthree four"),
        ("<div><p>one two</p><video><p>no player</p></div><p>three four</p><video><p>none</p></video>", "one two\nthree four"),
        ("<p>one <svg><svg><text>label</text></svg><text>label</text></svg> two</p>", "one two"),
        ("<p>one two</p><script>x</script ><p>three</p><style>never closed <p>no</p>", "one two\nthree"),
    ],
)
def test_elements_left_out(page, want):
    assert H.extract(page, BLANK) == want


def page_with(article, box="", wrapper="", links=3):
    menu = "".join(f"<a href=x>to {i}</a>" for i in range(links))
    return f"<body><div class='zzmenu'>{menu}<p>go to some other pages of this site</p></div><div class='{wrapper}'><article><h1>Head</h1><p>{article}</p></article></div>{box}</body>"


def test_learned_names(spark):
    """Names that no list holds are learned from labelled pages, and listed ones unlearned."""
    rows = [(i, page_with(f"text {i} of the article with many words in it", "<div class='qqbox'><p>other things to look at today</p></div>", "header big")) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    trained = H.fit(pages)
    unlike = "<body><div class='zzmenu'><p>go to some other pages of this site</p></div><div class='header big'><p>The text of a page that marks no article.</p></div><div class=qqbox><p>other things to look at today</p></div></body>"
    assert H.extract(unlike, trained) == "The text of a page that marks no article."
    assert "other things" in H.extract(unlike, BLANK) and "marks no article" not in H.extract(unlike, BLANK)


def test_scan_leaves_out_links(spark):
    """A box of links that has no name stands outside the best run, as tags cost more where they were seen outside content."""
    links = "<div>" + "".join(f"<a href=x>page{i}</a>" for i in range(12)) + "</div>"
    rows = [(i, f"<body>{links}<article><p>text {i} of the article with many words in it</p></article>{links}</body>") for i in range(60)]
    trained = H.fit(spark.createDataFrame(rows, "page_id long, html string"))
    page = f"<body><section><p>Some text of a page, which is long enough.</p><p>And a second part.</p></section>{links}</body>"
    assert H.extract(page, trained) == "Some text of a page, which is long enough.\nAnd a second part."
    assert "page11" in H.extract(page, BLANK)
    found = H.parse(page)
    assert any(t[0] == "text" and t[1] == "page11" and trained.word(t[2]) > -5 for t in found)


def test_short_blocks_after_an_aside():
    """What stands after a long box that isn't content is kept, however short."""
    box = "<aside><p>" + "not this " * 100 + "</p></aside>"
    assert H.extract(f"<body><article><p>one two three four</p>{box}<p>five six</p></article></body>", BLANK) == "one two three four\nfive six"


@pytest.mark.parametrize("weights", ["blank", "trained"])
@pytest.mark.parametrize(
    "inner",
    [
        '<p title="a hidden gem">four five six</p>',
        '<div data-grid="share footer"><p>four five six</p></div>',
        '<h2 id="social-history">four five six</h2>',
        '<h2 id="comments">four five six</h2>',
        '<blockquote class="share-price">four five six</blockquote>',
        '<p data-note="x display:none y" data-hidden=1>four five six</p>',
        '<p class="a-hidden" title=hidden>four five six</p>',
        '<p hidden="until-found">four five six</p>',
    ],
)
def test_names_are_whole(inner, weights, request):
    w = request.getfixturevalue("given_weights") if weights == "trained" else BLANK
    assert H.extract(f"<body><nav><a>Home</a></nav><article><p>one two three</p>{inner}<p>seven</p></article></body>", w) == "one two three\nfour five six\nseven"


@pytest.fixture(scope="module")
def given_weights(spark):
    return H.fit(spark.read.parquet("/root/testdata/sf0.1/pages.parquet"))


@pytest.mark.parametrize("wrapper", ['<div class="has-sidebar">{}</div>', '<div class="header-less layout">{}</div>', "<form>{}</form>", "<form action=/x><div class='header'><fieldset>{}</fieldset></div></form>", "<div class=modal id=page>{}</div>"])
@pytest.mark.parametrize("weights", ["blank", "trained"])
def test_wrappers_say_nothing(wrapper, weights, request):
    w = request.getfixturevalue("given_weights") if weights == "trained" else BLANK
    body = "<nav><a>Home</a><a>News</a></nav><div><h1>Head</h1><p>Words of a page that marks no article.</p><aside>beside it</aside><p>And more of them.</p></div><footer>All rights reserved</footer>"
    assert H.extract(f"<html><head><title>T</title></head><body>{wrapper.format(body)}</body></html>", w) == "Head\nWords of a page that marks no article.\nAnd more of them."


def test_no_content_stays_none():
    assert H.extract("<body><nav><a>Home</a></nav><footer>many words in a footer and nothing else at all</footer></body>", BLANK) == ""
    assert H.extract("<body><div style='color:red; display:none'>secret words</div><div aria-hidden=true>secret</div><p hidden>secret</p></body>", BLANK) == ""


def test_pages_without_article_elements(spark, given_weights):
    """The given pages with their article elements turned into plain ones: what is extracted is still what stood in the article."""
    rows = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").limit(400).collect()
    plain = lambda h: h.replace("<article", "<section").replace("</article", "</section")
    same = sum(H.extract(plain(r.html or ""), given_weights) == article(r.html or "") for r in rows)
    assert same >= 0.98 * len(rows)
