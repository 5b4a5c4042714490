"""HTML extraction by a tree-structured graphical model over the blocks of a page.

Every block is content or not. Its own features give a potential, and each
block and its parent share another one; sum-product messages up and down the
tree yield the marginals, of all pages of a batch at once. Both kinds of
potential are fitted to labelled pages: layouts composed by rule, and a bounded
sample of the table's own pages whose one article element tells the label.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennial.llm import arrow, dom

# Pages of the table the model is fitted to, those of the smallest hash; and composed ones.
SAMPLE_PAGES = 200
COMPOSED_PAGES = 500

# Names that sites give to the parts of a page.
NAMES: dict[str, str] = {
    "content": "article content contents main post entry story body text page prose read essay chapter blog maincontent "
    "bodytext articlebody longform paragraph",
    "navigation": "nav navbar navigation menu breadcrumb breadcrumbs crumbs pagination pager toc skip links sitemap tabs topbar",
    "header": "header masthead head logo brand hero toolbar top",
    "footer": "footer foot copyright legal colophon bottom imprint credits disclaimer",
    "sidebar": "sidebar side aside widget widgets rail related recommended recommendations popular trending more teaser "
    "archive archives tags tag categories complementary secondary",
    "notice": "cookie cookies consent gdpr notice alert banner popup modal overlay notification warning message privacy "
    "paywall announcement toast",
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted affiliate "
    "commercial adsense partner",
    "form": "form search login signup signin register subscribe subscription newsletter contact input feedback survey poll",
    "comments": "comment comments commentlist reply replies respond discussion disqus thread reviews review feedback "
    "reactions responses guestbook",
    "social": "share sharing social follow like facebook twitter author bio byline meta",
}
_GROUPS = {name: group for group, names in NAMES.items() for name in names.split()}
GROUPS = list(NAMES)
TAGS = (
    "#page #text html body p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd div section article main nav header footer aside table tbody thead tr "
    "td th blockquote pre figure figcaption address details summary center fieldset form"
).split()
_TAG = {tag: i for i, tag in enumerate(TAGS)}
# Kinds of blocks, each with its own potential between block and parent.
KINDS = ("container", "text", "heading", "item")
_KIND = {
    **dict.fromkeys(("#text", "p", "blockquote", "pre", "figcaption", "td", "th", "dd"), 1),
    **dict.fromkeys(("h1", "h2", "h3", "h4", "h5", "h6", "dt", "summary"), 2),
    **dict.fromkeys(("li", "tr"), 3),
}
N_FEATURES = len(TAGS) + 1 + len(GROUPS) + 13


def features(tree: dom.Tree) -> np.ndarray:
    """One row of features for each block."""
    n = len(tree.tags)
    x = np.zeros((n, N_FEATURES), np.float32)
    chars, words, runs, before = (np.zeros(n) for _ in range(4))
    seen = 0
    for block, text in tree.runs:
        if not runs[block]:
            before[block] = seen
        runs[block] += 1
        chars[block] += len(text)
        words[block] += text.count(" ") + 1
        seen += len(text)
        if "©" in text:
            x[block, -1] = 1
    links = np.array(tree.links, float)
    total_chars, total_links = chars.copy(), links.copy()
    for block in range(n - 1, 0, -1):
        total_chars[tree.parents[block]] += total_chars[block]
        total_links[tree.parents[block]] += total_links[block]
    base = len(TAGS) + 1
    for block, (tag, names) in enumerate(zip(tree.tags, tree.names, strict=True)):
        x[block, _TAG.get(tag, len(TAGS))] = 1
        for name in names:
            group = _GROUPS.get(name) or _GROUPS.get(name.rstrip("s"))
            if group:
                x[block, base + GROUPS.index(group)] = 1
    at = base + len(GROUPS)
    has = chars > 0
    x[:, at] = has
    x[:, at + 1] = np.log1p(chars) / 5
    x[:, at + 2] = has & (words <= 3)
    x[:, at + 3] = has & (words >= 12)
    x[:, at + 4] = np.minimum(links / np.maximum(chars, 1), 1)
    x[:, at + 5] = np.log1p(total_chars) / 8
    x[:, at + 6] = np.minimum(total_links / np.maximum(total_chars, 1), 1)
    x[:, at + 7] = total_chars / max(seen, 1)
    x[:, at + 8] = np.where(has, before / max(seen, 1), 0)
    x[:, at + 9] = 1
    x[:, at + 10] = total_chars == 0
    # a form around most of a page's text is the page's, not a form to fill in
    x[:, at + 11] = x[:, _TAG["form"]] * (2 * total_chars > seen)
    return x


class Forest:
    """The blocks of many pages as arrays, ready for messages by depth."""

    def __init__(self, trees: list[dom.Tree]):
        sizes = [len(t.tags) for t in trees]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.ends = offsets[1:-1]
        self.parents = np.concatenate([np.array(t.parents) + o for t, o in zip(trees, offsets[:-1], strict=True)])
        self.kinds = np.array([_KIND.get(tag, 0) for t in trees for tag in t.tags])
        self.shut = np.array([s for t in trees for s in t.shut])
        self.x = np.concatenate([features(t) for t in trees])
        depths = np.concatenate([np.array(t.depths) for t in trees])
        order = np.argsort(depths, kind="stable")
        levels = np.split(order, np.flatnonzero(np.diff(depths[order])) + 1)
        self.below_roots = levels[1:]

    def beliefs(self, weights: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum-product up and down all trees: marginals of blocks, and of (block's parent, block)."""
        score = self.x @ weights
        belief = np.stack([np.zeros_like(score), score], axis=1)
        belief[self.shut] = (0.0, -50.0)
        up, joint = np.zeros_like(belief), np.zeros((len(score), 2, 2))
        for nodes in reversed(self.below_roots):
            # to the parent: over the block's labels, with all that is below it
            joint[nodes] = pairs[self.kinds[nodes]] + belief[nodes][:, None, :]
            up[nodes] = np.logaddexp(joint[nodes, :, 0], joint[nodes, :, 1])
            np.add.at(belief, self.parents[nodes], up[nodes])
        for nodes in self.below_roots:
            # to the block: what its parent knows without it
            joint[nodes] += (belief[self.parents[nodes]] - up[nodes])[:, :, None]
            belief[nodes] = np.logaddexp(joint[nodes, 0, :], joint[nodes, 1, :])
        both = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        both /= both.sum(axis=(1, 2), keepdims=True)
        gap = np.clip(belief[:, 1] - belief[:, 0], -60, 60)
        return 1 / (1 + np.exp(-gap)), both


class Model:
    """Potentials of blocks (weights of features) and of pairs (tables by kind: parent's label, block's label)."""

    def __init__(self, weights: np.ndarray, pairs: np.ndarray):
        self.weights, self.pairs = weights, pairs

    def marginals(self, trees: list[dom.Tree]) -> list[np.ndarray]:
        """For each tree the probabilities that its blocks are content."""
        if not trees:
            return []
        forest = Forest(trees)
        return np.split(forest.beliefs(self.weights, self.pairs)[0], forest.ends)

    def text(self, page: str | None) -> str:
        return self.texts([page])[0]

    def texts(self, pages: list[str | None]) -> list[str]:
        """The main text of each page: its content runs in page order, joined by line breaks."""
        trees = [dom.read(p or "") for p in pages]
        return [
            "\n".join(text for block, text in tree.runs if share[block] > 0.5)
            for tree, share in zip(trees, self.marginals(trees), strict=True)
        ]


def labels_of(tree: dom.Tree, inside: np.ndarray) -> np.ndarray:
    """Labels of all blocks from those of the blocks with text: a container is content if it holds any.

    What is below a block that isn't content is therefore no content either,
    which the pair potentials learn.
    """
    labels = np.zeros(len(tree.tags))
    for block, _ in tree.runs:
        labels[block] = max(labels[block], inside[block])
    for block in range(len(tree.tags) - 1, 0, -1):
        labels[tree.parents[block]] = max(labels[tree.parents[block]], labels[block])
    return labels


def fit(labelled: list[tuple[dom.Tree, np.ndarray]], steps: int = 120, rate: float = 0.15, ridge: float = 1.0) -> Model:
    """Fit both potentials to the likelihood of all labels of a page given the page.

    The gradient is what was seen less what the messages expect; Adam steps.
    """
    forest = Forest([t for t, _ in labelled])
    y = np.concatenate([labels for _, labels in labelled]).astype(int)
    open_ = ~forest.shut
    inner = np.concatenate(forest.below_roots)
    inner = inner[open_[inner]]
    n_weights, shape = forest.x.shape[1], (len(KINDS), 2, 2)
    seen = np.zeros(shape)
    np.add.at(seen, (forest.kinds[inner], y[forest.parents[inner]], y[inner]), 1)
    values = np.zeros(n_weights + seen.size)
    first, second = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, steps + 1):
        share, both = forest.beliefs(values[:n_weights], values[n_weights:].reshape(shape))
        expected = np.zeros(shape)
        np.add.at(expected, forest.kinds[inner], both[inner])
        slope = np.concatenate([forest.x.T @ np.where(open_, y - share, 0), (seen - expected).ravel()]) - ridge * values
        first += 0.1 * (slope - first)
        second += 0.01 * (slope**2 - second)
        values += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model(values[:n_weights], values[n_weights:].reshape(shape))


# --- labelled pages ---------------------------------------------------------------------

_MARK = "\u2063"  # an invisible character that marks content while a labelled page is read


def read_labelled(page: str) -> tuple[dom.Tree, np.ndarray]:
    """Tree and labels of a page whose content runs carry the mark."""
    tree = dom.read(page)
    inside = np.zeros(len(tree.tags))
    for block, text in tree.runs:
        inside[block] = max(inside[block], _MARK in text)
    tree.runs = [(b, t.replace(_MARK, "").strip()) for b, t in tree.runs]
    return tree, labels_of(tree, inside)


def _sentence(rng: random.Random, words: list[str], low: int = 4, high: int = 16) -> str:
    text = " ".join(rng.choice(words) for _ in range(rng.randint(low, high))).rstrip(".,;:!?")
    return text[:1].upper() + text[1:] + rng.choice((".", ".", ".", "!", "?"))


def _named(rng: random.Random, group: str, tags: tuple[str, ...]) -> tuple[str, str]:
    """Opening and closing tag of an element named after a group."""
    tag = rng.choice(tags)
    name = rng.choice(NAMES[group].split())
    other = rng.choice(("", "", "site-", "page_", "main-", "js-", "c-", "the-"))
    end = rng.choice(("", "", "-wrap", "_box", "-list", "-area", "-block", "Section", "-1"))
    attribute = rng.choice(('class="{}"', 'id="{}"', 'class="{} clearfix"', "class='{}'", 'class="box {}" data-x="1"'))
    return f"<{tag} {attribute.format(other + name + end)}>", f"</{tag}>"


def _links(rng: random.Random, words: list[str], n: int) -> str:
    kind = rng.choice(("ul", "div", "p"))
    links = [f'<a href="/{i}">{" ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))}</a>' for i in range(n)]
    if kind == "ul":
        return "<ul>" + "".join(f"<li>{a}</li>" for a in links) + "</ul>"
    return f"<{kind}>" + rng.choice((" ", " | ", " &middot; ", "\n")).join(links) + f"</{kind}>"


def _boilerplate(rng: random.Random, words: list[str]) -> str:
    group = rng.choice([g for g in GROUPS if g != "content"])
    plain = {
        "navigation": ("nav", "div"), "header": ("header", "div"), "footer": ("footer", "div"), "sidebar": ("aside", "div", "section"),
        "notice": ("div", "section", "aside"), "advert": ("div", "aside"), "form": ("form", "div", "section"),
        "comments": ("section", "div"), "social": ("div",),
    }[group]
    start, end = _named(rng, group, plain)
    if plain[0] in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.4:
        start, end = f"<{plain[0]}>", f"</{plain[0]}>"
    say = lambda low=4, high=16: _sentence(rng, words, low, high)
    if group == "navigation":
        inner = _links(rng, words, rng.randint(2, 9))
    elif group == "header":
        inner = rng.choice((f"<h1>{say(1, 3)}</h1><p>{say(3, 8)}</p>", f"<div>{say(1, 4)}</div>", _links(rng, words, 3), f"<p>{say()}</p>"))
    elif group == "footer":
        inner = rng.choice((f"&copy; {rng.randint(2000, 2030)} {say(1, 4)} {say()}", f"<p>{say()} {say()}</p>", f"<p>&copy; {say(1, 5)}</p>" + _links(rng, words, 4), say()))
    elif group == "sidebar":
        inner = f"<h3>{say(1, 3)}</h3>" + rng.choice((_links(rng, words, rng.randint(3, 8)), f"<p>{say()} {say()}</p>", f"<ul><li>{say()}</li><li>{say()}</li></ul>"))
    elif group in ("notice", "advert"):
        inner = rng.choice((say(), f"<p>{say()} {say()}</p><button>OK</button>", f"<h4>{say(1, 4)}</h4><p>{say()}</p>", f'<a href="/x">{say()}</a>'))
    elif group == "form":
        inner = rng.choice((f"<p>{say()}</p><input type=text><button>{say(1, 2)}</button>", f"<label>{say(1, 3)}</label><input>", f"<h3>{say(1, 3)}</h3><p>{say()} {say()}</p>"))
    elif group == "comments":
        one = lambda: rng.choice(
            (
                f'<div class="comment"><p>{say()} {say()} {say()}</p></div>',
                f"<li><b>{say(1, 2)}</b><p>{say()} {say()}</p></li>",
                f'<article class="comment"><h4>{say(1, 3)}</h4><p>{say()} {say()}</p></article>',
                f"<p>{say()}</p>",
            )
        )
        inner = rng.choice(("", f"<h3>{say(1, 3)}</h3>")) + "".join(one() for _ in range(rng.randint(1, 6)))
    else:
        inner = rng.choice((_links(rng, words, 4), say(2, 6)))
    return start + inner + end


def _content(rng: random.Random, words: list[str]) -> str:
    say = lambda low=4, high=16: _sentence(rng, words, low, high) + _MARK
    blocks = []
    if rng.random() < 0.8:
        level = rng.choice(("h1", "h1", "h2"))
        blocks.append(f"<{level}>{say(2, 12)}</{level}>")
    for _ in range(rng.randint(1, 12)):
        blocks.append(
            rng.choice(
                (
                    lambda: f"<p>{' '.join(say() for _ in range(rng.randint(1, 6)))}</p>",
                    lambda: f"<p>{' '.join(say() for _ in range(rng.randint(1, 6)))}</p>",
                    lambda: f"<p>{' '.join(say() for _ in range(rng.randint(2, 4)))}",
                    lambda: f"<p>{say()} <a href='/y'>{rng.choice(words)}</a> <em>{rng.choice(words)}</em> {say()}</p>",
                    lambda: f"<p><b>{say(2, 12)}<br><p>{say()} {say()}</p>",
                    lambda: f"<h2>{say(1, 8)}</h2>",
                    lambda: f"<h3>{say(1, 8)}</h3><p>{say()}</p>",
                    lambda: "<ul>" + "".join(f"<li>{say(2, 10)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>",
                    lambda: "<ol>" + "".join(f"<li>{say(4, 16)}</li>" for _ in range(rng.randint(2, 4))) + "</ol>",
                    lambda: f"<blockquote><p>{say()}</p></blockquote>",
                    lambda: f"<blockquote>{say()}</blockquote>",
                    lambda: f"<pre>{say(3, 9)}</pre>",
                    lambda: f"<figure><img src=x><figcaption>{say(3, 9)}</figcaption></figure>",
                    lambda: f"<table><tr><td>{say(2, 5)}</td><td>{say(2, 5)}</td></tr></table>",
                    lambda: f"<div>{say()} {say()}</div>",
                    lambda: f"<p>{say(1, 3)}</p>",
                )
            )()
        )
    if rng.random() < 0.1:  # many short lines
        blocks += [f"<p>{say(1, 4)}</p>"] * rng.randint(20, 150)
    if rng.random() < 0.35:
        blocks.insert(rng.randint(1, len(blocks)), _boilerplate(rng, words))
    return "".join(blocks)


def _page_form(rng: random.Random) -> tuple[str, str]:
    """Opening and closing of one form around a whole page."""
    attributes = rng.choice(("", ' method="post" action="./"', ' id="aspnetForm" method="post"', ' name="form1" id="form1"'))
    inner = rng.choice((("", ""), ("<div>", "</div>"), ('<input type="hidden" name="state" value="x"><div class="container">', "</div>")))
    return f"<form{attributes}>{inner[0]}", f"{inner[1]}</form>"


def composed(words: list[str], n: int = COMPOSED_PAGES, seed: int = 1) -> list[str]:
    """Labelled pages of varied layouts, built by rule from the given words."""
    rng = random.Random(seed)
    pages = []
    for _ in range(n):
        main = _content(rng, words)
        for _ in range(rng.randint(1, 2)):
            start, end = rng.choice(
                (
                    ("<article>", "</article>"),
                    ("<article>", "</article>"),
                    ("<main>", "</main>"),
                    ("<div>", "</div>"),
                    ("<section>", "</section>"),
                    ('<main role="main">', "</main>"),
                    _named(rng, "content", ("div", "section", "article", "main", "td")),
                    _named(rng, "content", ("div", "section")),
                )
            )
            after = _boilerplate(rng, words) if rng.random() < 0.3 else ""
            main = start + main + after + end
        before = "".join(_boilerplate(rng, words) for _ in range(rng.randint(0, 4)))
        after = "".join(_boilerplate(rng, words) for _ in range(rng.randint(0, 4)))
        wrap = rng.choice((("", ""), ("", ""), ('<div class="container">', "</div>"), ('<div id="wrapper"><div class="row">', "</div></div>"), _page_form(rng)))
        pages.append(
            f"<!DOCTYPE html><html><head><title>{_sentence(rng, words)}</title><script>var a='<p>';</script></head><body>"
            f"{wrap[0]}{before}{main}{after}{wrap[1]}</body></html>"
        )
    return pages


def _from_table(page: str) -> tuple[dom.Tree, np.ndarray] | None:
    """A page whose one article element tells its content; None for other pages."""
    tree = dom.read(page)
    if tree.tags.count("article") != 1:
        return None
    inside = np.zeros(len(tree.tags))
    for block, tag in enumerate(tree.tags):
        inside[block] = tag == "article" or (block > 0 and inside[tree.parents[block]])
    return tree, labels_of(tree, inside)


def train(
    pages: DataFrame,
    html_col: str = "html",
    sample: int = SAMPLE_PAGES,
    n_composed: int = COMPOSED_PAGES,
    longest: int = 100_000,
    most_words: int = 5_000,
) -> Model:
    """Fit the model on a sample of at most ``sample`` pages and on composed layouts.

    Only pages of less than ``longest`` characters are fitted, and the layouts
    are composed of at most ``most_words`` words of theirs: both bound what the
    driver holds, neither what is extracted.

    The sample are the distinct pages of the smallest hashes, which any
    partitioning yields alike; hashes are compared first, and pages leave their
    task only when chosen. An empty table leaves the composed layouts.
    """
    rows = pages.select(F.col(html_col).alias("page"), F.xxhash64(html_col).alias("h")).where(
        F.col("page").isNotNull() & (F.char_length("page") < longest)
    )
    cut = rows.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    found = rows.where(F.col("h") <= F.lit(cut)).dropDuplicates(["h"]).collect() if cut is not None else []
    chosen = [r["page"] for r in sorted(found, key=lambda r: r["h"])]
    own = [labelled for page in chosen if (labelled := _from_table(page))]
    words = sorted({w for tree, _ in own for _, text in tree.runs for w in text.split() if len(w) < 20})[:most_words]
    words = words or "the of and to in is that for it was on are as with they at be this from have".split()
    return fit(own + [read_labelled(page) for page in composed(words, n_composed)])


def extract(pages: DataFrame, model: Model | None = None, html_col: str = "html", drop: tuple[str, ...] = ()) -> DataFrame:
    """Add ``text``, the main text of each page, and ``n_chars``, its code points.

    Null and empty pages have an empty text. Repeated rows are read alike.
    Very long pages are read whole. Columns named ``text`` or ``n_chars`` are
    replaced, those in ``drop`` left out, the others stay.
    """
    fitted = model or train(pages, html_col)

    def run(batch: pa.RecordBatch) -> list:
        found = fitted.texts(batch.column(batch.schema.get_field_index(html_col)).to_pylist())
        return [found, [len(t) for t in found]]

    return arrow.append(
        pages, run, [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())], drop
    )
