"""Main text of web pages with a tree-structured graphical model over the DOM.

Block elements are nodes with a hidden state, content or not. A node's observations are its tag, the words of
its class, id and role, how much text it holds itself and how much of that is in links; a transition table joins
each child to its parent. Sum-product messages go upward from the leaves and downward from the root, for all pages of a
batch at once and level by level, and give each node's marginal; the text of nodes at CUT or more is kept.

The tables are counted on labelled pages: the few below and, of the pages themselves, at most SAMPLE (the first by
a hash of their html) that mark their article, labelled by that mark. Pages without <article> or <main> are judged by
tables of their own, counted on the same pages with these elements taken out: what stood in them is
then content that lies openly in the page, and what is around it has to be told by what it looks like.

Defined results: null and empty html have an empty text; broken, cut off and very long pages are read as
far as they go; white space in a block becomes one space and blocks are joined by one; rows that repeat get
equal texts; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagauge.llm.common import first_by_hash, table
from stratagauge.llm.tokens import slices

SAMPLE, CUT = 512, 0.5
#: A labelled page of this module counts as so many sampled ones.
WEIGHT = 1000.0

# Kinds of HTML elements.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style template noscript head title iframe object svg canvas select textarea button option".split())
RAW = ("script", "style", "textarea", "title")
CLOSED_BY = {  # an open element on the left ends where one of the right begins
    "p": set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"},
}
#: All that may stand in a head; text and any other element end it.
IN_HEAD = set("base basefont bgsound link meta noframes noscript script style template title".split())
SECTIONS = set("article aside nav footer header section main div body form table ul ol".split())

# A quote opens a value only after an equals sign; anywhere else it is a character like others.
_VALUE = r"=\s*+(?:\"[^\"]*+(?:\"|$)|'[^']*+(?:'|$))"
_TOKEN = re.compile(rf"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([A-Za-z][^\s/>]*)((?:{_VALUE}|[^>])*+)(>|$)", re.S)
_NAME = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_LABEL = re.compile(r"\bdata-main\s*=\s*\"([01])\"")
_SPACES = re.compile(r"\s+")
# The end of a page may be cut inside a tag or a character reference.
_WORD = re.compile(r"[a-z]+")

#: Labelled pages: data-main switches the label for an element and what is in it.
PAGES = (
    """<body><header><h1>Site name</h1><nav><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul></nav></header>
    <main data-main="1"><h1>A long headline of the story</h1><p>First paragraph of the story with quite some words in it, and more of them.</p><p>Short one.</p>
    <aside class="sidebar" data-main="0"><h3>Related</h3><ul><li><a href=c>Another story</a></li></ul></aside><h2>Part two</h2><p>Second paragraph of the story, which also has a link to <a href=d>some place</a> in its many words.</p>
    <ul><li>An item of the story</li><li>Another item of the story</li></ul><blockquote><p>Somebody said so and it was written down.</p></blockquote></main>
    <div class="cookie-notice" data-main="0"><p>We use cookies to make this site better. Please accept them all.</p></div><footer><p>Imprint and rights</p></footer></body>""",
    """<body><div id="header"><a href=a>Logo</a></div><div id="menu"><a href=b>One</a> <a href=c>Two</a></div><div id="content" data-main="1"><h1>Title of the post</h1><p>Some text of the post that goes on for a while and has no links at all.</p>
    <div class="ad banner" data-main="0">Buy this fine product now, only today</div><p>More text of the post follows the advert here, again for a while.</p><table><tr><td>Cell</td><td>Number</td></tr></table><pre>code of the post</pre></div>
    <section id="comments" class="comments" data-main="0"><h2>Comments</h2><div class="comment"><p>I think that this post is quite wrong in many of its words, dear author.</p></div><form><p>Write a comment here</p><input></form></section><div id="footer">All rights and so on</div></body>""",
    """<body><nav class="breadcrumb"><a href=a>Start</a> <a href=b>Here</a></nav><article data-main="1"><header data-main="0"><p>By somebody on some day</p></header><h1>Headline</h1><p>The story begins with a paragraph that is long enough to read as one.</p>
    <div class="share social" data-main="0"><a href=a>Share</a> <a href=b>Tweet</a></div><figure><figcaption>What the picture shows to readers</figcaption></figure><section><h2>Next part</h2><p>And it ends with another paragraph of many words, as stories do.</p></section>
    <div class="newsletter promo" data-main="0"><p>Sign up for our letter and get the best of it every week.</p></div><footer data-main="0"><p>Filed under news</p></footer></article>
    <div class="comments reader" data-main="0"><ul><li>First reader: what a story, I have to say that it was long.</li><li>Second reader: no</li></ul></div><aside class="widget recommended"><p>You may also like these other stories of ours, we think.</p></aside></body>""",
    """<body><div class="alert notice warning"><p>This site will be closed for work on Sunday, please come back later on.</p></div><div class="wrapper"><div class="post entry" data-main="1"><h2>Entry</h2><p>Text of the entry that is as long as such entries are on such sites.</p>
    <div><p>Text of the entry in one more box, which belongs to it as well.</p></div><dl><dt>Term</dt><dd>What the term means</dd></dl><div class="advertisement sponsored" data-main="0"><p>Sponsored: this is what you need in your life right now, believe us.</p></div></div>
    <div class="sidebar"><div class="widget"><h3>Tags</h3><a href=a>one</a> <a href=b>two</a></div><form class="search"><input></form></div></div><div class="pagination pager"><a href=a>Older</a></div><div class="modal popup"><p>Subscribe to go on reading all of this.</p></div></body>""",
)


#: Pages without any frame: all is content but what is marked as none.
BARE_PAGES = (
    "<body>Nothing but text that stands in the page as it is, without any element around it.</body>",
    "<body><h1>Heading</h1><p>A paragraph of some length that stands openly in the page, as in old pages.</p><p>And short.</p></body>",
    """<body><div><h2>Heading</h2><div>Text in a box of its own which is long enough to be read as a paragraph of prose, and goes on.</div><div>Short.</div></div>
    <div data-main="0"><a href=a>One</a> <a href=b>Two</a></div><nav data-main="0"><ul><li><a href=c>Three</a></li></ul></nav><footer data-main="0"><p>Rights</p></footer></body>""",
)


@dataclass
class Node:
    """A block element: what can be seen of it, its own text in runs, its label (-1: none)."""

    parent: int
    tag: str
    names: tuple[str, ...]
    level: int
    label: int
    runs: list[int] = field(default_factory=list)
    chars: int = 0
    linked: int = 0
    article: bool = False


@dataclass
class _Seen:
    """A node of a sampled page as it comes back from a task: its parent and observations only."""

    parent: int
    observed: list[str]
    tag: str = ""


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Nodes of a page (parents first) and its text runs in page order with the node that owns each.

    A run ends where a block element or <br> begins or ends; inline elements do not end it.
    """
    nodes = [Node(-1, "html", (), 0, -1)]
    runs: list[tuple[int, str]] = []
    open_: list[tuple[str, int]] = [("html", 0)]  # open block and silent elements
    piece: list[str] = []
    links = silent = 0
    at, end = 0, len(page)

    def close_run() -> None:
        if piece:
            text = _SPACES.sub(" ", entities.unescape("".join(piece))).strip()
            if text:
                runs.append((open_[-1][1], text))
            piece.clear()

    def ended(tag: str | None) -> None:
        """Close the open elements that end where the element `tag` (None: text) begins."""
        nonlocal silent
        while len(open_) > 1 and (tag in CLOSED_BY.get(open_[-1][0], ()) or (open_[-1][0] == "head" and tag not in IN_HEAD)):
            silent -= open_.pop()[0] in SILENT

    def text(chunk: str) -> None:
        if chunk and not chunk.isspace():
            ended(None)
        if chunk and not silent:
            piece.append(chunk)
            if not chunk.isspace():
                node = nodes[open_[-1][1]]
                node.chars += len(chunk)
                node.linked += len(chunk) if links else 0

    while at < end:
        found = _TOKEN.search(page, at)
        if not found:
            text(page[at:])
            break
        text(page[at : found.start()])
        at = found.end()
        tag = found[2].lower() if found[2] else ""
        if not tag:
            continue
        if tag in INLINE:
            if not found[1]:
                ended(tag)
            if tag == "a":
                links = 0 if found[1] else 1
            continue
        close_run()
        if found[1]:
            for i in range(len(open_) - 1, 0, -1):
                if open_[i][0] == tag:
                    silent -= sum(t in SILENT for t, _ in open_[i:])
                    del open_[i:]
                    links = 0
                    break
                if open_[i][0] in SECTIONS and tag not in SECTIONS:
                    break  # a stray end tag does not end a section
            continue
        if tag in VOID or found[4] == "" or (found[3].endswith("/") and tag not in SECTIONS):
            continue
        ended(tag)
        if tag in RAW:
            stop = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        parent = open_[-1][1]
        if tag in SILENT or silent:
            silent += tag in SILENT
            open_.append((tag, parent))
            continue
        names = tuple(sorted({w for m in _NAME.finditer(found[3]) for w in _WORD.findall((m[1] or m[2] or m[3] or "").lower())}))
        label = _LABEL.search(found[3])
        up = nodes[parent]
        nodes.append(Node(parent, tag, names, up.level + 1, int(label[1]) if label else up.label, article=up.article or tag in ("article", "main")))
        open_.append((tag, len(nodes) - 1))
    close_run()
    return nodes, runs


def seen(node: Node) -> list[str]:
    """What is observed of a node."""
    if isinstance(node, _Seen):
        return node.observed
    size = "none" if not node.chars else "short" if node.chars < 30 else "middle" if node.chars < 120 else "long"
    link = "no" if node.linked * 5 < node.chars else "some" if node.linked * 2 < node.chars else "most"
    return [f"tag {node.tag}", f"size {size}", *([f"link {link}"] if node.chars else []), *(f"name {n}" for n in node.names)]


def forced(node: Node) -> int:
    """Label of a node of a page that marks its article: in it, outside, or not to tell (-1)."""
    if not node.article:
        return 0
    return -1 if node.names or node.tag in ("aside", "nav", "form", "header", "footer") else 1


def flattened(nodes: list, labels: list[int]) -> tuple[list, list[int]]:
    """A labelled page without its articles: their elements belong to what is around them, which so has content."""
    open_ = [n.parent < 0 or n.tag not in ("article", "main") for n in nodes]
    up, out, place = [], [], {}
    for i, node in enumerate(nodes):
        parent = node.parent
        while parent >= 0 and not open_[parent]:
            parent = nodes[parent].parent
        up.append(parent)
        if open_[i]:
            place[i] = len(out)
            out.append(_Seen(place.get(parent, -1), seen(node), node.tag))
    told = list(labels)
    for i, label in enumerate(labels):
        if label == 1:
            while (i := up[i]) >= 0:
                told[i] = 1
    return out, [told[i] for i in place]


@dataclass
class Model:
    """log P(observation | state), log P(state | parent's state), log P(state) of a root."""

    seen: dict[str, tuple[float, float]]
    step: np.ndarray
    root: np.ndarray


def count(pages: Iterator[tuple[list[Node], list[int], float]]) -> Model:
    """Relative frequencies with half a count added; a node labelled -1 counts nowhere."""
    step, root, states = np.full((2, 2), 0.5), np.full(2, 0.5), np.full(2, 1.0)
    names: dict[str, np.ndarray] = {}
    for nodes, labels, weight in pages:
        for node, y in zip(nodes, labels):
            if y < 0:
                continue
            states[y] += weight
            if node.parent < 0:
                root[y] += weight
            elif labels[node.parent] >= 0:
                step[labels[node.parent], y] += weight
            for s in seen(node):
                names.setdefault(s, np.full(2, 0.5))[y] += weight
    table_ = {s: tuple(np.log(n / states)) for s, n in names.items()}
    return Model(table_, np.log(step / step.sum(1, keepdims=True)), np.log(root / root.sum()))


def marginals(pages: list[list[Node]], model: Model) -> np.ndarray:
    """P(content) of all nodes of the pages, one after the other, by sum-product on their trees."""
    starts = np.cumsum([0, *map(len, pages)])
    level = np.array([n.level for p in pages for n in p])
    parent = np.array([n.parent + s if n.parent >= 0 else -1 for p, s in zip(pages, starts) for n in p])
    own = np.array([np.sum([model.seen[s] for s in seen(n) if s in model.seen] or [(0.0, 0.0)], axis=0) for p in pages for n in p]).reshape(-1, 2)
    above = lambda x: np.logaddexp(x[:, None, 0] + model.step[None, :, 0], x[:, None, 1] + model.step[None, :, 1])
    order = np.argsort(level, kind="stable")
    cuts = np.searchsorted(level[order], np.arange(level.max(initial=0) + 2))
    by_level = [order[lo:hi] for lo, hi in zip(cuts, cuts[1:])]
    below, message = own.copy(), np.zeros_like(own)
    for ids in by_level[:0:-1]:  # upward
        message[ids] = above(below[ids])
        np.add.at(below, parent[ids], message[ids])
    down = np.zeros_like(own)
    if len(by_level):
        down[by_level[0]] = model.root
    for ids in by_level[1:]:  # downward: all that the parent knows but for this child
        rest = down[parent[ids]] + below[parent[ids]] - message[ids]
        down[ids] = np.logaddexp(rest[:, None, 0] + model.step[0][None, :], rest[:, None, 1] + model.step[1][None, :])
    belief = down + below
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))


def train(spark: SparkSession, pages: DataFrame) -> tuple[Model, Model]:
    """Tables for pages that mark their article, and for all others.

    They are counted on the labelled pages above and a bounded sample of pages that mark their article.
    """
    marked = pages.where(F.lower("html").rlike("<(article|main)[ >]"))
    marked = marked.select(F.xxhash64("html").alias("h"), "html")
    hashes = marked.select("h").distinct()
    chosen = first_by_hash(hashes, "h", SAMPLE, hashes.count())
    some = marked.join(F.broadcast(chosen), "h").groupBy("h").agg(F.any_value("html").alias("html"))  # SAMPLE rows
    rows = some.select("html").mapInArrow(_sampled, "tags array<string>, parents array<int>, labels array<int>, seen array<array<string>>").collect()
    own = [(nodes := parse(p)[0], [max(0, n.label) for n in nodes], WEIGHT) for p in PAGES]
    told = [([_Seen(*n) for n in zip(r["parents"], r["seen"], r["tags"])], r["labels"], 1.0) for r in rows]
    flat = [(*flattened(nodes, labels), weight) for nodes, labels, weight in own + told]
    bare = [(nodes := parse(p)[0], [1 if n.label < 0 else n.label for n in nodes], WEIGHT) for p in BARE_PAGES]
    return count(own + told), count(flat + bare)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            pages = [parse(p)[0] for p in part["html"].to_pylist()]
            cols = ([[n.tag for n in p] for p in pages], [[n.parent for n in p] for p in pages], [[forced(n) for n in p] for p in pages], [[seen(n) for n in p] for p in pages])
            kinds = (pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["tags", "parents", "labels", "seen"])


def extract(htmls: list[str | None], models: tuple[Model, Model]) -> list[str]:
    """Main texts, by the tables for pages with an article or for those without."""
    parsed = [parse(p or "") for p in htmls]
    texts = [""] * len(parsed)
    marked = [any(n.article for n in nodes) for nodes, _ in parsed]
    for model, with_article in zip(models, (True, False)):
        own = [i for i, m in enumerate(marked) if m == with_article]
        belief = marginals([parsed[i][0] for i in own], model)
        starts = np.cumsum([0, *(len(parsed[i][0]) for i in own)])
        for i, s in zip(own, starts):
            texts[i] = " ".join(t for owner, t in parsed[i][1] if belief[s + owner] >= CUT)
    return texts


def _extractor(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = extract(part["html"].to_pylist(), sent.value)
                yield pa.RecordBatch.from_arrays([part["page_id"], part["url"], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def main_texts(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    pages = pages.select("page_id", "url", "html")
    sent = spark.sparkContext.broadcast(train(spark, pages))
    return pages.mapInArrow(_extractor(sent), "page_id long, url string, text string, n_chars long")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(spark, table(spark, sf_dir, "pages"))
