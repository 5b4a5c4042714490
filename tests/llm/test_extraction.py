import html
import re
import time

import pytest

from perennial.llm import dom, extraction


@pytest.fixture(scope="module")
def words():
    return [f"{a}{b}" for a in ("ka", "lo", "mi", "tre", "fun", "sol") for b in ("na", "ri", "to", "ble", "sh", "end", ",", ".")]


@pytest.fixture(scope="module")
def model(words):
    return extraction.fit([extraction.read_labelled(p) for p in extraction.composed(words, 400, seed=1)])


def test_held_out_layouts(model, words):
    pages = [extraction.read_labelled(p) for p in extraction.composed(words, 200, seed=77)]
    right = total = 0
    for (tree, labels), share in zip(pages, model.marginals([t for t, _ in pages]), strict=True):
        for block, _ in tree.runs:
            right += (share[block] > 0.5) == (labels[block] > 0.5)
            total += 1
    assert right / total > 0.98


def article_text(page):
    inner = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    blocks = (re.sub(r"</?(?:b|br)>", " ", b) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(filter(None, (" ".join(html.unescape(b).split()) for b in blocks)))


def test_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    wanted = {r["page_id"]: article_text(r["html"]) for r in pages.collect()}
    out = extraction.extract(pages).collect()
    assert {r["page_id"]: r["text"] for r in out} == wanted
    assert all(r["n_chars"] == len(r["text"]) for r in out)


def test_parts_that_are_no_article(model):
    page = """<html><head><title>T</title><style>p{}</style></head><body>
    <header class="site-header"><a href="/">Home</a> <p>Slogan of the site.</p></header>
    <nav><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul></nav>
    <div id="cookie-notice"><p>We use cookies to make this site better for you.</p><button>OK</button></div>
    <aside class="sidebar"><h3>Popular</h3><p>Read these other stories now.</p></aside>
    <main><article><h1>Title &amp; more</h1><p>First   paragraph
    of the <a href=x>text</a>, with words&nbsp;in it.</p><script>var a = "<p>no</p>";</script>
    <ul><li>A point, made well.</li><li>Another point, made too.</li></ul>
    <div class="advert">Buy now, it is cheap.</div>
    <p>Second paragraph, it ends here.</p></article>
    <section class="comments"><h3>Comments</h3><div class="comment"><p>I liked this article very much, thanks for it.</p></div></section></main>
    <form><p>Your name, please.</p><input></form>
    <footer>&copy; 2020 Site. All rights reserved.</footer></body></html>"""
    assert model.text(page).split("\n") == [
        "Title & more",
        "First paragraph of the text, with words in it.",
        "A point, made well.",
        "Another point, made too.",
        "Second paragraph, it ends here.",
    ]


@pytest.mark.parametrize(
    "page, runs",
    [
        ("", []),
        ("plain &lt;text&gt; &#233;", ["plain <text> é"]),
        ("<p>a<b>b</p><p>c", ["ab", "c"]),
        ("<p><b>a.<br><p>b</p>", ["a.", "b"]),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", ["a", "b", "c"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]),
        ("<script>if (a < b) '<p>x</p>'</script>y", ["y"]),
        ("<!-- <p>x</p> -->y<!-- open", ["y"]),
        ("</p></div>a</b>b < c", ["ab < c"]),
        ('<p title="a > b">c</p>', ["c"]),
        ("<div>a<p>b</p>c</div>", ["a", "b", "c"]),
    ],
)
def test_reader(page, runs):
    assert [text for _, text in dom.read(page).runs] == runs


@pytest.mark.parametrize(
    "page, runs",
    [
        ("<div data-x=it's><p>Text of the article.</p><p>They don't...", ["Text of the article.", "They don't..."]),
        ('<p title=5"tall>First sentence', ["First sentence"]),
        ("<p>a</p><script src=/js/app/>var x=1;</script><p>b", ["a", "b"]),
        ('<p>a</p><script src="a.js"/>var x=1;</script><p>b', ["a", "b"]),
        ("<svg><style/><text>in a picture</text></svg>", ["in a picture"]),
        ('<a href="x>y" title=\'>\'>z</a> <!--> 1 <!-- > -- > --> 2 <!doctype html> <3 </3> 4', ["z 1 2 <3 4"]),
        ("<p>a <button>b</button> c</p>", ["a", "b", "c"]),
        ("<p>kept</p><p class='cut off", ["kept"]),
        ("<b>bold<div>in it</b> more</div>after", ["bold", "in it more", "after"]),
    ],
)
def test_reader_takes_tags_as_browsers_do(page, runs):
    assert [text for _, text in dom.read(page).runs] == runs


HOSTILE = {
    "quotes": lambda n: '<a "' * n,
    "nested blocks": lambda n: "<div>" * n,
    "inline over blocks": lambda n: "<b>" * n + "<div>" + "</b>" * n,
    "one open tag": lambda n: "<p>" + "<a y" * n + ' z=">"',
    "in a button": lambda n: "<p><button>" + "<div>" * n,
    "open comments": lambda n: "<!--" * n + "<!x" * n,
    "lists": lambda n: "<ul><li>" * n,
    "no tags": lambda n: "<" * n + "</template" * n + "<template>" * n,
}


@pytest.mark.parametrize("kind", HOSTILE)
def test_time_grows_with_the_page(kind):
    def least(n):
        page = HOSTILE[kind](n)
        times = []
        for _ in range(3):
            start = time.process_time()
            dom.read(page)
            times.append(time.process_time() - start)
        return min(times)

    # twice the page takes twice the time; 3.2 leaves room for the clock
    assert least(24_000) <= 3.2 * least(12_000) + 0.02


def test_marginals_are_those_of_all_labellings(model):
    """Sum-product against the sum over every labelling of a small tree."""
    import itertools

    import numpy as np

    tree = dom.read("<div><p>One two three.</p><ul><li><a href=x>x</a></li><li>Some words, here.</li></ul></div>")
    forest = extraction.Forest([tree])
    share, _ = forest.beliefs(model.weights, model.pairs)
    score, n = forest.x @ model.weights, len(tree.tags)
    total, ones = 0.0, np.zeros(n)
    for labels in itertools.product((0, 1), repeat=n):
        value = sum(score[i] * labels[i] for i in range(n))
        value += sum(model.pairs[forest.kinds[i], labels[tree.parents[i]], labels[i]] for i in range(1, n))
        total += np.exp(value)
        ones += np.exp(value) * np.array(labels)
    assert np.allclose(share, ones / total)


def test_nulls_empties_repeats_long_pages_and_clashing_names(spark, model):
    long = "<article>" + "<p>Some words of the text, as before.</p>" * 3000 + "</article>"
    rows = [(1, None, "x"), (1, None, "x"), (2, "", "y"), (3, "<" * 1000, "z"), (4, long, "w"), (5, "<div>" * 3000 + "deep", "v")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    out = extraction.extract(pages, model)
    assert out.columns == ["page_id", "html", "text", "n_chars"]
    got = {r["page_id"]: r for r in out.collect()}
    assert got[1]["text"] == "" and got[2]["n_chars"] == 0
    assert got[4]["text"].count("\n") == 2999
    assert extraction.extract(pages.limit(0)).count() == 0


_BODY = "<h1>Title of it</h1><p>First paragraph of the text, with some words in it, and more of them here.</p><p>Second paragraph, it ends here.</p>"
_TEXT = ["Title of it", "First paragraph of the text, with some words in it, and more of them here.", "Second paragraph, it ends here."]


@pytest.mark.parametrize(
    "attribute, shut",
    [
        ('class="overflow-hidden"', False),
        ('style="overflow:hidden"', False),
        ('aria-hidden="false"', False),
        ('data-title="The hidden valley"', False),
        ("data-x='display:none'", False),
        ('style="display: none; display:block"', False),
        ("hidden", True),
        ('id=x hidden=""', True),
        ('style="color:red; DISPLAY : none !important"', True),
        ("aria-hidden=true", True),
    ],
)
def test_only_hidden_blocks_are_shut(model, attribute, shut):
    assert model.text(f"<html><body><article {attribute}>{_BODY}</article></body></html>").split("\n") == ([""] if shut else _TEXT)


def test_page_in_one_form(model):
    start = '<html><body><form method="post" action="./page.aspx" id="aspnetForm"><input type="hidden" name="state" value="x">'
    around = '<nav><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul></nav><article>{}</article><footer>&copy; 2020 Site</footer>'
    assert model.text(start + around.format(_BODY) + "</form></body></html>").split("\n") == _TEXT
    assert model.text("<html><body><article>" + _BODY + "</article><form><p>Your name, please.</p><input></form></body></html>").split("\n") == _TEXT


@pytest.mark.parametrize(
    "page, runs",
    [
        ("<p>a <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> b</p>", ["a x=2 b"]),
        ("<p>a <svg><title>t</title><desc>d</desc><path d='m'/><text>s</text></svg> b</p>", ["a s b"]),
        ("<p>a</p><svg><path d='m'><p>b</p><div>c</div>", ["a", "b", "c"]),
        ("<p>a</p><canvas><p>b</p>", ["a", "b"]),
        ("<p>a</p><canvas>no canvas</canvas><p>b</p>", ["a", "b"]),
        ("<p>a</p><object data=x><param name=y><p>b</p>", ["a", "b"]),
        ("<p>a</p><template><p>b</p>", ["a", "b"]),
        ("<p>a</p><script>b", ["a"]),
    ],
)
def test_reader_skips_only_raw_text_to_the_end(page, runs):
    assert [text for _, text in dom.read(page).runs] == runs
